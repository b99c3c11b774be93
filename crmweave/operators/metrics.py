"""Aggregates over entities, deals, cases and staging tables.

All group aggregates combine in the map tasks, so that a hot key reaches its
reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column, share
from crmweave.functions.dates import SECONDS_PER_DAY, mean_days, newer_than, seconds_between


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def mean_days_by(df: DataFrame, key: str, opened: str, closed: str) -> DataFrame:
    """Rows per key and mean days from opening to closing; open rows do not count."""
    return df.groupBy(key).agg(
        F.count("*").alias("n"), mean_days(opened, closed).alias("avg_days_to_close")
    )


def closure_rate(
    cases: DataFrame,
    group: str,
    status: str,
    closed_status: str,
    names: DataFrame | None = None,
    names_key: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Cases, closed cases and closure rate per group, optionally with the group's name.

    Groups whose name is unknown are dropped, as by an inner join.  The aggregate is
    joined, not the cases: one row per group takes part in the join.
    """
    totals = cases.groupBy(group).agg(
        F.count("*").alias("total_cases"),
        F.count(F.when(F.col(status) == F.lit(closed_status), 1)).alias("closed_cases"),
    )
    rated = totals.withColumn("closure_rate", share(F.col("closed_cases"), F.col("total_cases")))
    if names is None:
        return rated
    return rated.join(names.select(F.col(names_key).alias(group), name), group)


def log_counts(log: DataFrame, as_of: datetime | str, **span: int) -> DataFrame:
    """Log rows of a recent time span by operation, entity type and status."""
    recent = log.where(newer_than("timestamp", as_of, **span))
    return count_by(recent, "operation", "entity_type", "status")


def totals(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Row count and exact decimal sums, on one row."""
    return df.agg(
        F.count("*").alias("n"), *(F.sum(as_column(c)).alias(name) for name, c in columns.items())
    )


def row_counts(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Per table: all rows, and rows whose key is present."""
    result = None
    for name, (df, key) in tables.items():
        row = df.agg(
            F.count("*").alias("n"), F.count(key if key else F.lit(1)).alias("n_with_key")
        ).select(F.lit(name).alias("table_name"), "n", "n_with_key")
        result = row if result is None else result.unionByName(row)
    return result


def table_presence(tables: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    """Row counts of the expected tables; a table that is not there is reported so."""
    result = None
    for name in expected:
        if name in tables:
            row = tables[name].agg(F.count("*").alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(True).alias("present"), "n"
            )
        else:
            spark = next(iter(tables.values())).sparkSession
            row = spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit(False).alias("present"),
                F.lit(None).cast("bigint").alias("n"),
            )
        result = row if result is None else result.unionByName(row)
    return result


def extract_stats(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per entity: rows extracted, distinct keys added, duplicates skipped; and the total."""
    parts = None
    for name, (df, key) in frames.items():
        # NULL is one key like any other, as in a keyed store.
        row = df.agg(
            F.count("*").alias("extracted"),
            (F.countDistinct(key) + F.max(F.col(key).isNull().cast("int"))).alias("added"),
        ).select(
            F.lit(name).alias("entity"), "extracted", F.coalesce("added", F.lit(0)).cast("bigint").alias("added")
        )
        parts = row if parts is None else parts.unionByName(row)
    rolled = parts.rollup("entity").agg(F.sum("extracted").alias("extracted"), F.sum("added").alias("added"))
    return rolled.select(
        F.coalesce("entity", F.lit("TOTAL")).alias("entity"),
        "extracted", "added",
        (F.col("extracted") - F.col("added")).alias("duplicates_skipped"),
    )


def resolution_by(cases: DataFrame, key: str, opened: str, closed: str) -> DataFrame:
    """Closed cases per key with mean, shortest and longest resolution in days."""
    done = cases.where(F.col(closed).isNotNull() & F.col(opened).isNotNull())
    seconds = seconds_between(opened, closed)

    def days(value: Column) -> Column:
        return F.round(value.cast("double") / SECONDS_PER_DAY, 6)

    return done.groupBy(key).agg(
        F.count("*").alias("closed_cases"),
        mean_days(opened, closed).alias("avg_days"),
        days(F.min(seconds)).alias("min_days"),
        days(F.max(seconds)).alias("max_days"),
    )


def status_by(cases: DataFrame, group: str, status: str, columns: Mapping[str, str]) -> DataFrame:
    """Status counts per group, one column per status (output name -> status)."""
    return cases.groupBy(group).agg(
        F.count("*").alias("total"),
        *(
            F.count(F.when(F.col(status) == F.lit(value), 1)).alias(name)
            for name, value in columns.items()
        ),
    )


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    counts = count_by(df, key)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("percent", share(F.col("n"), total))


def sla_share(
    cases: DataFrame, key: str, opened: str, closed: str, target_days: Mapping[str, int] | int
) -> DataFrame:
    """Closed cases per key and the percentage closed within the target time.

    The target is one number of days, or one per value of ``key``; values without a
    target are left out.
    """
    if isinstance(target_days, int):
        limit: Column = F.lit(target_days)
    else:
        limit = F.lit(None).cast("int")
        for value, days in target_days.items():
            limit = F.when(F.col(key) == F.lit(value), F.lit(days)).otherwise(limit)
    done = cases.where(F.col(closed).isNotNull() & F.col(opened).isNotNull() & limit.isNotNull())
    within = seconds_between(opened, closed) <= limit * SECONDS_PER_DAY
    return (
        done.groupBy(key)
        .agg(F.count("*").alias("closed_cases"), F.count(F.when(within, 1)).alias("within_target"))
        .withColumn("sla_percent", share(F.col("within_target"), F.col("closed_cases")))
    )
