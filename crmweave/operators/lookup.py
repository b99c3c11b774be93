"""Equi joins of a large table with a lookup, safe against hot keys.

Adaptive execution sees the real shuffle sizes and splits the rows of a hot partition
over tasks, which needs settings that ``crmweave.session.configure`` applies.  A join
without them would let a hot key gather in one task, so it is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKEW_SETTINGS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
)


def need_skew_splitting(spark: SparkSession) -> None:
    """Raise where adaptive execution may not split skewed joins, also before a further operator."""
    if off := [name for name in SKEW_SETTINGS if spark.conf.get(name) != "true"]:
        raise ValueError(f"{', '.join(off)} must be true; crmweave.session.configure sets them")


def lookup_join(large: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equally named key columns; ``how`` is left, inner, left_semi or left_anti."""
    need_skew_splitting(large.sparkSession)
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(*keys).distinct()
    return large.join(lookup, keys, how)


def left_lookup(
    large: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]], columns: dict[str, Column | str]
) -> DataFrame:
    """Left join that adds ``columns`` (output name -> lookup column or expression).

    The condition is on the large side's own columns, so Spark knows how its rows lie
    and a further lookup by the same key needs no shuffle of them.
    """
    need_skew_splitting(large.sparkSession)
    keys = [f"__key{i}" for i in range(len(on))]
    right = lookup.select(
        *(F.col(k).alias(key) for key, (_, k) in zip(keys, on)),
        *((F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()),
    )
    joined = large.alias("__large").join(right.alias("__right"), [F.col(f"__large.{c}") == F.col(key) for key, (c, _) in zip(keys, on)], "left")
    return joined.select(*(F.col(f"__large.`{c}`") for c in large.columns), *(F.col(f"__right.`{name}`") for name in columns))


def with_group_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """Attach the size of its group to every row.

    A window would gather each group in one task.  Here the counts are combined
    before the shuffle and joined back, and a join can split a hot group.  Rows with
    a NULL key form one group, as in SQL.
    """
    need_skew_splitting(df.sparkSession)
    counts = df.groupBy(F.col(key).alias("__group")).agg(F.count("*").alias(name))
    return df.join(counts, F.col(key).eqNullSafe(F.col("__group")), "left").drop("__group")
