"""Small helpers that the operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from crmweave.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the same with underscores where the frame has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, in files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows go to Python in the jobs inside: for rows that hold whole blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


ROWS_A_BATCH = 1000  # texts that go to Python at once; 10,000, the default, fill tens of MB on both sides


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it; a cluster gets it by ``--py-files``.

    Rows go to them in batches of whole texts, so these are kept small.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (environment.get("PYTHONPATH"), root) if x)
    return spark
