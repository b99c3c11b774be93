"""Tables landed for point lookups by legacy id.

The canonical key becomes a column of its own, so a lookup is an equality on stored values, which parquet can prune by:
rows are clustered by that key, so the ranges of files and row groups do not overlap, and a bloom filter on it rules out
row groups for ids that lie in their range without being there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.functions.keys import canonical_key

LOOKUP_KEY = "lookup_key"
KEYS_A_GROUP = 1_000_000  # distinct keys that a bloom filter of a row group is laid out for


def land_for_lookup(df: DataFrame, path: str, key: str, column: str = LOOKUP_KEY, keys_a_group: int = KEYS_A_GROUP) -> None:
    """Replace the table at ``path`` by these rows with their canonical key as ``column``; rows without one come first."""
    if column in df.columns:
        raise ValueError(f"the table has a column {column} already")
    # Rows of one key, or of none, are spread by their order of reading, so that a frequent key fills several files.
    keyed = df.withColumn(column, canonical_key(key)).withColumn("__read", F.monotonically_increasing_id())
    clustered = keyed.repartitionByRange(column, "__read").sortWithinPartitions(column).drop("__read")
    clustered.write.mode("overwrite").options(
        **{f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(keys_a_group)}
    ).parquet(path)


def canonical_text(legacy_id: object) -> str:
    """An id as ``canonical_key`` writes it."""
    return str(legacy_id).strip().removesuffix(".0")


def lookup_landed(spark: SparkSession, path: str, legacy_ids: Sequence[object], column: str = LOOKUP_KEY) -> DataFrame:
    """The rows of some legacy ids, written in any of the known ways. Only files that may hold them are read."""
    wanted = sorted({canonical_text(i) for i in legacy_ids})
    table = spark.read.parquet(path)
    if not wanted:
        return table.limit(0)
    return table.where(F.col(column) == wanted[0] if len(wanted) == 1 else F.col(column).isin(wanted))
