"""Incremental extraction: only rows changed since the last run are read and stored, and deletions are noted.

Below a folder, each run adds ``rows/run=N`` and ``deleted/run=N`` and, last, ``marks/run=N`` with the run's high-water
mark: the latest change it has seen. A run counts once its mark is complete, so a run that was cut short is repeated
under its number and leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crmweave.operators.keyed import last_wins
from crmweave.operators.lookup import need_skew_splitting

RUN, GONE = "extract_run", "extract_gone"


@dataclass(frozen=True)
class Increment:
    run: int
    written: int
    deleted: int


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete runs: they are given without gaps."""
    done = []
    while _exists(spark, f"{path}/marks/run={len(done) + 1}/_SUCCESS"):
        done.append(len(done) + 1)
    return done


def _stored(spark: SparkSession, path: str, kind: str, runs: Sequence[int]) -> DataFrame | None:
    """Rows of some runs with their run number, for those that have any."""
    parts = [f"{path}/{kind}/run={n}" for n in runs]
    if not parts:
        return None
    return spark.read.option("basePath", f"{path}/{kind}").parquet(*parts).withColumnRenamed("run", RUN)


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], changed: str) -> DataFrame:
    """The rows as of the last complete run, with the run that stored each."""
    runs = _runs(spark, path)
    rows = _stored(spark, path, "rows", runs)
    if rows is None:
        raise ValueError(f"{path} holds no complete run")
    gone = _stored(spark, path, "deleted", runs).select(*keys, RUN, F.lit(True).alias(GONE))
    events = rows.withColumn(GONE, F.lit(False)).unionByName(gone, allowMissingColumns=True)
    return last_wins(events, keys, [RUN, changed]).where(f"not {GONE}").drop(GONE)


def extract_increment(source: DataFrame, path: str, keys: Sequence[str], changed: str, deletes: bool = True) -> Increment:
    """Store what is new or changed in ``source`` since the last run.

    ``changed`` is the time or number of a row's last change. Rows at the mark itself, and rows without a change, are
    compared with what is stored, as others of the same moment may have come since. A row that changed before the mark
    but arrives after it is not seen. With ``deletes`` the keys of the source are read too, and stored keys that it no
    longer has are noted as deleted; rows of one key count as one record, whose latest change holds.
    """
    spark = source.sparkSession
    need_skew_splitting(spark)
    keys = list(keys)
    runs = _runs(spark, path)
    run = len(runs) + 1
    mark = None
    fresh = source
    if runs:
        mark = spark.read.parquet(*(f"{path}/marks/run={n}" for n in runs)).agg(F.max("mark")).first()[0]
        later = F.col(changed).isNull()
        fresh = source.where(later if mark is None else (F.col(changed) >= F.lit(mark)) | later)
        now = current_rows(spark, path, keys, changed)
        known = now.where(later if mark is None else (F.col(changed) == F.lit(mark)) | later)
        known = known.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(changed).alias("__changed"))
        same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
        fresh = fresh.join(known, [*same, F.col(changed).eqNullSafe(F.col("__changed"))], "left_anti")
    seen, lost = Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    latest = last_wins(fresh, keys, [changed])
    latest.observe(seen, one, F.max(changed).alias("mark")).write.mode("overwrite").parquet(f"{path}/rows/run={run}")
    here = source.select(keys)
    if runs and deletes:
        gone = now.select(keys).join(here.distinct(), keys, "left_anti")
    else:
        gone = here.limit(0)
    gone.observe(lost, one).write.mode("overwrite").parquet(f"{path}/deleted/run={run}")
    kind = source.schema[changed].dataType.simpleString()
    written, newest = seen.get["n"], seen.get["mark"]
    marks = spark.createDataFrame([(run, newest if newest is not None else mark)], f"number int, mark {kind}")
    marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/run={run}")
    return Increment(run, written, lost.get["n"])
