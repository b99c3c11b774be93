"""Many-to-many phone and e-mail links folded onto one row per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crmweave.operators.lookup import left_lookup


def pick_primary(links: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first by ``order``.

    The rank filter lets Spark keep only the first row per key and task before the
    shuffle, so a key with very many links does not gather in one task.
    """
    orders = [order] if isinstance(order, str) else list(order)
    window = Window.partitionBy(*keys).orderBy(*(F.col(o).asc_nulls_last() for o in orders))
    return links.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def with_contact(
    entities: DataFrame,
    links: DataFrame,
    entity_key: str,
    link_key: str,
    link_type: tuple[str, str],
    link_id: str,
    columns: Mapping[str, str],
    fan_out: bool = False,
) -> DataFrame:
    """Left join the links of one type, keeping entities that have none.

    By default the lowest link id wins and the row count never changes;
    ``fan_out=True`` keeps every link of the type.
    """
    type_column, type_value = link_type
    right = links.where(F.col(type_column) == F.lit(type_value)).select(
        link_key, link_id, *(c for c in columns.values() if c not in (link_key, link_id))
    )
    if not fan_out:
        right = pick_primary(right, [link_key], link_id)
    return left_lookup(entities, right, [(entity_key, link_key)], dict(columns))


def pivot_links(
    links: DataFrame, key: str, type_column: str, value: str, columns: Mapping[str, str]
) -> DataFrame:
    """Link types as columns (output name -> type), the highest value of each."""
    return links.groupBy(key).agg(
        *(
            F.max(F.when(F.col(type_column) == F.lit(kind), F.col(value))).alias(name)
            for name, kind in columns.items()
        )
    )


def with_pivoted_links(
    entities: DataFrame,
    links: DataFrame,
    entity_key: str,
    link_key: str,
    type_column: str,
    value: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """All link types per entity, aggregated before the join rather than after it."""
    pivoted = pivot_links(links, link_key, type_column, value, columns)
    return left_lookup(entities, pivoted, [(entity_key, link_key)], {c: c for c in columns})


def best_value(links: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One value per key: the highest."""
    return links.groupBy(key).agg(F.max(value).alias(name))


def link_types(links: DataFrame, type_column: str) -> DataFrame:
    return links.groupBy(type_column).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and per column how many are filled and what percentage; one pass."""
    counts = df.agg(F.count("*").alias("rows"), *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns)))
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("filled"))
            for i, c in enumerate(columns)
        )
    )
    percent = F.round(
        F.lit(100) * F.col("e.filled").cast("decimal(20,0)")
        / F.nullif(F.col("rows").cast("decimal(20,0)"), F.lit(0)),
        2,
    )
    return counts.select("rows", F.explode(entries).alias("e")).select(
        "e.column_name", "rows", "e.filled", percent.alias("percent")
    )
