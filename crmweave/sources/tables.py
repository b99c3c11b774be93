"""Keyed tables on plain parquet that can be upserted.

Parquet has no MERGE.  Rows lie in buckets by a hash of their key, and an upsert
reads and rewrites only the buckets its rows fall into, into a folder for the next
version: ``version=N/bucket=B``.  A version counts once its ``_SUCCESS`` marker is
there, which the job commit writes last, so a lost driver or executor leaves the
table as it was and the same upsert can simply run again.  One writer at a time is
assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.operators.keyed import Arrival, upsert

BUCKETS = 256
BUCKET = "bucket"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    folder, fs = _path(spark, path)
    if not fs.exists(folder):
        return {}
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return {int(n.removeprefix(prefix)): f"{path}/{n}" for n in names if n.startswith(prefix)}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    found = []
    for number, folder in _children(spark, path, "version=").items():
        marker, fs = _path(spark, f"{folder}/_SUCCESS")
        if fs.exists(marker):
            found.append(number)
    return sorted(found)


def _current_buckets(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder holding the newest complete state of each bucket."""
    current: dict[int, str] = {}
    for number in versions(spark, path):
        current |= _children(spark, f"{path}/version={number}", f"{BUCKET}=")
    return current


def _read(spark: SparkSession, folders: Sequence[str]) -> DataFrame | None:
    return spark.read.parquet(*folders) if folders else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as of its newest version, or None where nothing has been written yet."""
    return _read(spark, list(_current_buckets(spark, path).values()))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    arrival: Arrival | None = None,
    buckets: int = BUCKETS,
    touched: Sequence[int] | None = None,
    keep: int = 2,
) -> int:
    """Upsert into the table at ``path`` and return the number of the new version.

    ``touched`` names the buckets that incoming rows can fall into; without it every
    bucket is rewritten.  The number of buckets is fixed by the first upsert.
    """
    _fix_number(spark, path, buckets)
    current = _current_buckets(spark, path)
    folders = [f for b, f in current.items() if touched is None or b in set(touched)]
    stored = _read(spark, folders)
    if stored is None:
        stored = spark.createDataFrame([], incoming.schema)
    merged = upsert(stored, incoming, keys, update_columns, arrival)
    known = versions(spark, path)
    number = known[-1] + 1 if known else 1
    # Rebalancing by bucket gives each bucket few files, and splits a large one.
    (
        merged.withColumn(BUCKET, bucket_of(keys, buckets))
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{path}/version={number}")
    )
    drop_old(spark, path, keep)
    return number


def _fix_number(spark: SparkSession, path: str, buckets: int) -> None:
    """Note the number of buckets beside a new table; another number for an existing one is an error."""
    known = set(_children(spark, path, "buckets="))
    if known - {buckets}:
        raise ValueError(f"{path} has {min(known - {buckets})} buckets, not {buckets}")
    if not known:
        if versions(spark, path):
            raise ValueError(f"{path} does not say how many buckets it has")
        folder, fs = _path(spark, f"{path}/buckets={buckets}")
        fs.mkdirs(folder)


def touched_buckets(incoming: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets that rows of a frame fall into: at most ``buckets`` numbers."""
    return [r[0] for r in incoming.select(bucket_of(keys, buckets)).distinct().collect()]


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete bucket folders that the last ``keep`` versions no longer read."""
    known = versions(spark, path)
    if len(known) <= keep:
        return
    newest_kept = known[-keep]
    needed: dict[int, int] = {}
    for number in known:
        for bucket in _children(spark, f"{path}/version={number}", f"{BUCKET}="):
            if number <= newest_kept:
                needed[bucket] = number
    for number in known:
        if number >= newest_kept:
            continue
        for bucket, folder in _children(spark, f"{path}/version={number}", f"{BUCKET}=").items():
            if needed[bucket] != number:
                target, fs = _path(spark, folder)
                fs.delete(target, True)
