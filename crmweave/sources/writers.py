"""Writing layers, snapshots, logs and several stores at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crmweave.crm.staging import run_log_schema
from crmweave.functions.text import escaped, sanitize
from crmweave.operators.keyed import new_only


def write_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace an entity's Bronze dataset; text is cleaned of symbol characters.

    In CSV, line breaks in values are written as ``\\n`` and ``\\r`` and backslashes doubled, so each record is one line;
    ``read_csv(escaped=True)`` gives the values back.
    """
    clean = sanitize(df)
    writer = (escaped(clean) if fmt == "csv" else clean).write.mode("overwrite")
    if fmt == "csv":
        # Quotes are doubled, as other CSV readers expect, and blanks are kept.
        writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        writer.format(fmt).save(path)


def write_snapshot(
    df: DataFrame,
    path: str,
    taken_at: datetime,
    fmt: str = "parquet",
    observation: Observation | None = None,
) -> str | None:
    """Write a time-stamped snapshot and return its path; None, and nothing is left, when there are no rows.

    The plan runs once: the rows are counted while they are written.

    An observation receives the number of rows written, as ``n``.
    """
    target = f"{path}/snapshot_ts={taken_at:%Y%m%d_%H%M%S}"
    seen = observation or Observation()
    write_bronze(df.observe(seen, F.count(F.lit(1)).alias("n")), target, fmt)
    if seen.get["n"]:
        return target
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(target)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
    return None


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace-load a catalog table, its rows and its columns; with ``path``, one whose files lie there."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    """Replace-load a relational table; each task inserts its own rows in batches."""
    df.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, batchsize=str(batch_size), truncate="true", **options
    ).save()


def append_run_log(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append entries (operation, entity, legacy id, target id, status, error, ms, time)."""
    spark.createDataFrame(list(rows), run_log_schema()).coalesce(1).write.mode("append").parquet(path)


def log_run(
    spark: SparkSession, path: str, run_id: str, at: datetime, entries: Sequence[tuple[str, str, int, int, str, str | None, int | None]]
) -> None:
    """Store a run's entries: (operation, entity, rows read, rows written, status, error, milliseconds).

    A run is one folder below its day, written at once; a repeated run replaces its entries.
    """
    schema = "operation string, entity_type string, rows_read long, rows_written long, status string, error_message string, execution_time_ms long"
    folder = f"{path}/day={at:%Y-%m-%d}/run={run_id}"
    spark.createDataFrame(list(entries), schema).withColumn("logged_at", F.lit(at)).coalesce(1).write.mode("overwrite").parquet(folder)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all runs, with their day and run; a filter on either reads only its folders."""
    return spark.read.schema(
        "operation string, entity_type string, rows_read long, rows_written long, status string, error_message string, "
        "execution_time_ms long, logged_at timestamp, day date, run string"
    ).parquet(path)


def write_all(
    df: DataFrame,
    sinks: Sequence[Callable[[DataFrame], None]],
    first_store: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Give one result to several sinks in order, computing it once.

    Where the first store is given, only records it does not hold go to any sink.
    """
    fresh = df if first_store is None else new_only(df, first_store, keys)
    fresh = fresh.persist()
    try:
        for sink in sinks:
            sink(fresh)
    finally:
        fresh.unpersist()
    return fresh
