"""Keyed tables: existence, first or last record per key, partial upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column
from crmweave.operators.contact import pick_primary
from crmweave.operators.lookup import lookup_join

# What orders the records of one key: a column, an expression, or several columns.
Arrival = str | Column | Sequence[str]


def _checked(keys: Sequence[str]) -> list[str]:
    keys = list(keys)
    if not keys:
        raise ValueError("at least one key column is needed")
    return keys


def existing_only(df: DataFrame, store: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lookup_join(df, store, _checked(keys), "left_semi")


def new_only(df: DataFrame, store: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records whose key the store does not hold yet."""
    return lookup_join(df, store, _checked(keys), "left_anti")


def first_wins(df: DataFrame, keys: Sequence[str], arrival: str | Sequence[str]) -> DataFrame:
    return pick_primary(df, _checked(keys), arrival)


def last_wins(df: DataFrame, keys: Sequence[str], arrival: str | Sequence[str]) -> DataFrame:
    orders = [arrival] if isinstance(arrival, str) else list(arrival)
    window = Window.partitionBy(*_checked(keys)).orderBy(*(F.col(o).desc_nulls_last() for o in orders))
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def insert_absent(
    store: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str | Sequence[str]
) -> DataFrame:
    """Store plus the first record of every new key."""
    fresh = first_wins(incoming, keys, arrival)
    return store.unionByName(new_only(fresh, store, keys).select(*store.columns))


def overwrite(
    store: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str | Sequence[str]
) -> DataFrame:
    """Store with the last record of every incoming key put in its place."""
    latest = last_wins(incoming, keys, arrival)
    return new_only(store, latest, keys).unionByName(latest.select(*store.columns))


def nested_records(
    df: DataFrame,
    nested: Mapping[str, tuple[str, Sequence[str]]],
    keys: Sequence[str],
    arrival: str,
    table: str,
) -> dict[str, DataFrame]:
    """Tables for nested struct columns, and then for the records themselves.

    ``nested`` maps a table name to its struct column and key columns.  The order of
    the result is the order of storing: nested tables come first.
    """
    tables: dict[str, DataFrame] = {}
    for name, (column, nested_keys) in nested.items():
        rows = df.where(F.col(column).isNotNull()).select(F.col(arrival).alias("__at"), f"{column}.*")
        tables[name] = first_wins(rows, nested_keys, "__at").drop("__at")
    tables[table] = first_wins(df, keys, arrival)
    return tables


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    arrival: Arrival | None = None,
) -> DataFrame:
    """Merge incoming rows into a keyed table.

    A known key takes only ``update_columns`` from the incoming row and keeps its
    other values; a new key takes everything.  ``arrival`` orders several incoming
    rows of one key, applied as if one after the other: head values from the first,
    updated columns from the last.  Without it one of the incoming rows of a key, the same in
    every run, is taken whole.  Rows without a key are not stored.
    """
    keys = _checked(keys)
    for key in keys:
        incoming = incoming.where(F.col(key).isNotNull())
    incoming = one_of_each(incoming, keys) if arrival is None else fold(incoming, keys, update_columns, arrival)

    left = current.select(*(F.col(c).alias(f"cur_{c}") for c in current.columns), F.lit(True).alias("cur__"))
    right = incoming.select(*(F.col(c).alias(f"inc_{c}") for c in incoming.columns), F.lit(True).alias("inc__"))
    on = [F.col(f"cur_{k}") == F.col(f"inc_{k}") for k in keys]
    merged = left.join(right, on, "full_outer")

    def value(name: str) -> Column:
        cur, inc = F.col(f"cur_{name}"), F.col(f"inc_{name}")
        if name in keys:
            return F.coalesce(cur, inc)
        if name not in incoming.columns:
            return cur
        if name in update_columns:
            return F.when(F.col("inc__"), inc).otherwise(cur)
        return F.when(F.col("cur__"), cur).otherwise(inc)

    return merged.select(
        *(value(c).cast(current.schema[c].dataType).alias(c) for c in current.columns)
    )


def one_of_each(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row of each key, by a hash of content, so that it does not depend on their order.

    Rows move once and with two numbers added; of a key with very many rows, each task sends its first.
    """
    hashed = [f.name for f in incoming.schema.fields if "map<" not in f.dataType.simpleString()]
    maps = [F.to_json(c) for c in incoming.columns if c not in hashed]
    numbered = incoming.withColumns({"__content": F.xxhash64(*hashed, *maps), "__maps": F.xxhash64(F.lit(1), *maps)})
    window = Window.partitionBy(*keys).orderBy("__content", *(F.col(f"`{c}`") for c in hashed), "__maps")
    return numbered.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").select(*incoming.columns)


def fold(
    incoming: DataFrame, keys: list[str], update_columns: Sequence[str], arrival: Arrival
) -> DataFrame:
    """Several incoming rows per key reduced to the row that remains of them.

    One aggregate, combined in the map tasks: a key with very many rows reaches its
    reducer as one row per task.  Arrival must order the rows of a key completely.
    """
    order = as_column(arrival) if isinstance(arrival, (str, Column)) else F.struct(*arrival)
    updated = [c for c in incoming.columns if c in update_columns and c not in keys]
    kept = [c for c in incoming.columns if c not in update_columns and c not in keys]
    sides = []
    if kept:
        sides.append(F.min_by(F.struct(*kept), order).alias("first"))
    if updated:
        sides.append(F.max_by(F.struct(*updated), order).alias("last"))
    if not sides:
        return incoming.distinct()
    folded = incoming.groupBy(*keys).agg(*sides)
    return folded.select(
        *keys, *(f"first.{c}" for c in kept), *(f"last.{c}" for c in updated)
    ).select(*incoming.columns)
