"""Column profiles whose state is stored per load and united, so that no load is read twice.

The state of a column in one load is its number of rows and of values, an HLL sketch of its values and the state of a
top-k sketch. States of any number of loads unite to the profile of all their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from crmweave.operators.quality import _missing

LOAD = "load"
HLL_BITS = 14  # 2**14 registers: a standard error of 0.8 %
TRACKED = 1024  # values that a top-k sketch keeps; counts are exact up to three quarters of as many distinct values
TOP = 10


def profile_state(df: DataFrame, load: str, columns: Sequence[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """One row per column: load, column_name, rows, filled, and the two sketches. One pass, combined in the map tasks.

    Values count as their text. NaN counts as missing, maps as their JSON.
    """
    aggregates, entries = [F.count("*").alias("rows")], []
    for i, name in enumerate(columns or df.columns):
        column = F.col(f"`{name}`")
        text = F.to_json(column) if isinstance(df.schema[name].dataType, MapType) else column.cast("string")
        value = F.when(~_missing(df, name), text)
        # The functions of top-k sketches take their column as SQL only.
        df = df.withColumn(f"__value{i}", value)
        aggregates += [
            F.count(f"__value{i}").alias(f"n{i}"), F.hll_sketch_agg(f"__value{i}", HLL_BITS).alias(f"h{i}"),
            F.expr(f"approx_top_k_accumulate(__value{i}, {tracked})").alias(f"t{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"), F.col(f"n{i}").alias("filled"), F.col(f"h{i}").alias("distinct_state"),
                F.col(f"t{i}").alias("top_state"),
            )
        )
    row = df.agg(*aggregates)
    return row.select(F.lit(load).alias(LOAD), "rows", F.inline(F.array(*entries)))


def store_profile(df: DataFrame, path: str, load: str, columns: Sequence[str] | None = None) -> None:
    """Put the state of a load beside those of the others; the same load again takes the place of its first state."""
    state = profile_state(df, load, columns).drop(LOAD)
    state.coalesce(1).write.mode("overwrite").parquet(f"{path}/{LOAD}={load}")


def united_profile(states: Sequence[DataFrame] | DataFrame, top: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """Per column over all loads: loads, rows, null_count, distinct_count (estimated) and top_values (value, count)."""
    if not isinstance(states, DataFrame):
        states = reduce(DataFrame.unionByName, states)
    united = states.groupBy("column_name").agg(
        F.countDistinct(LOAD).alias("loads"), F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("distinct_count"),
        F.expr(f"approx_top_k_combine(top_state, {tracked})").alias("top_state"),
    )
    values = F.expr(f"approx_top_k_estimate(top_state, {top})")
    return united.select(
        "column_name", "loads", "rows", (F.col("rows") - F.col("filled")).alias("null_count"), "distinct_count",
        # Missing values are no values, though the sketch may count them.
        F.transform(
            F.filter(values, lambda x: x["item"].isNotNull()), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("count"))
        ).alias("top_values"),
    )
