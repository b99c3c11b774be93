"""Data-quality profiles and checks, each one pass over the columns it needs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType

from crmweave.functions.keys import canonical_key
from crmweave.functions.columns import share
from crmweave.functions.payload import legacy_column
from crmweave.specs import ObjectMap, Relationship

# Fixed value: column names that suggest contact data.
CONTACT_NAMES = "Phone|Email|Fax|Mobile"
# Tasks at most that the rows of one value go to when values are counted.
SPREAD = 32
# Types a text column may turn out to hold, most specific first, each with the shape
# a value must have: a plain number would otherwise pass for a year or be truncated.
CANDIDATE_TYPES = {
    "int": (r"^[+-]?\d+$", "bigint"),
    "decimal": (r"^[+-]?\d+(\.\d+)?$", "decimal(38,10)"),
    "datetime": (r"^\d{4}-\d{1,2}-\d{1,2}", "timestamp_ntz"),
}


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _long_form(row: DataFrame, entries: Sequence[Column], *keep: str) -> DataFrame:
    """Turn the one row of an aggregate into one row per entry."""
    return row.select(*keep, F.explode(F.array(*entries)).alias("e")).select("e.*", *keep)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and missing values per column."""
    names = list(columns or df.columns)
    row = df.agg(
        F.count("*").alias("rows"),
        *(F.count(F.when(_missing(df, c), 1)).alias(f"n{i}") for i, c in enumerate(names)),
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(names)
    ]
    return _long_form(row, entries, "rows")


def id_profile(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.count("*").alias("total"),
        F.count(key).alias("non_null"),
        (F.count("*") - F.count(key)).alias("nulls"),
        distinct(key).alias("unique_ids"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values of each column.

    Values are brought into one narrow (column, value) form. Several distinct aggregates at once would shuffle rows as
    wide as the table, once per column. Values move before they are reduced: a task that reads a large part of the table
    would hold all values of all its columns. A value that very many rows have is spread by a hash of its row.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    values = F.array(*(F.struct(F.lit(c).alias("column_name"), text.alias("value")) for c, text in zip(columns, texts, strict=True)))
    spread = F.pmod(F.xxhash64(*texts), F.lit(SPREAD)).cast("int").alias("spread")
    return (
        df.select(spread, F.inline(values))
        .where(F.col("value").isNotNull())
        .repartition("column_name", "value", "spread")
        .distinct()
        .select("column_name", "value")
        .repartition("column_name", "value")
        .distinct()
        .groupBy("column_name")
        .agg(F.count("*").alias("distinct_count"))
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = True
) -> DataFrame:
    """Name, type, nullability and position, with missing and distinct counts, min, max.

    Distinct counts come from sketches made in the one pass.  ``approximate=False``
    counts exactly, in a second pass that shuffles each column's distinct values.
    """
    names = list(columns or df.columns)
    aggregates = [F.count("*").alias("rows")]
    entries = []
    for i, name in enumerate(names):
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, MapType):  # maps have no order
            column = column.cast("string")
        aggregates += [
            F.count(F.when(_missing(df, name), 1)).alias(f"n{i}"),
            F.min(column).cast("string").alias(f"lo{i}"),
            F.max(column).cast("string").alias(f"hi{i}"),
        ]
        if approximate:
            aggregates.append(F.approx_count_distinct(column).alias(f"d{i}"))
        field = df.schema[name]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(field.nullable).alias("nullable"),
                F.lit(df.columns.index(name) + 1).alias("ordinal"),
                F.col(f"n{i}").alias("null_count"),
                *([F.col(f"d{i}").alias("distinct_count")] if approximate else []),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
            )
        )
    profile = _long_form(df.agg(*aggregates), entries, "rows")
    if approximate:
        return profile
    counted = profile.join(distinct_counts(df, names), "column_name", "left")
    return counted.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))


def find_columns(df: DataFrame, pattern: str = CONTACT_NAMES) -> DataFrame:
    """Columns whose name matches, and how well each is filled.

    The names are chosen first, so only matching columns are read.
    """
    names = [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]
    if not names:
        return null_profile(df, df.columns[:1]).where(F.lit(False)).select(
            "column_name", "rows", F.lit(0).alias("filled"), F.lit(None).cast("decimal(38,2)").alias("percent")
        )
    return null_profile(df, names).select(
        "column_name", "rows",
        (F.col("rows") - F.col("null_count")).alias("filled"),
        share(F.col("rows") - F.col("null_count"), F.col("rows")).alias("percent"),
    )


def check_relationships(tables: Mapping[str, DataFrame], links: Sequence[Relationship]) -> DataFrame:
    """Per foreign key: rows, missing keys, orphans and cardinality.

    Each child table is read once for all its keys, and each parent once for each of its
    key columns, whatever number of links lead to it; one join then answers for every
    link.  Children are counted per key before the join, so a parent with very many
    children costs one row.  Keys are compared in their canonical form, text or number.
    """
    known = [(n, link) for n, link in enumerate(links) if link.child in tables and link.parent in tables]
    if not known:
        raise ValueError("none of the links has both its tables")

    ends = list(dict.fromkeys((link.parent, link.key) for _, link in known))

    def children(table: str) -> DataFrame:
        entries = []
        for n, link in known:
            if link.child == table:
                entry = F.struct(
                    F.lit(n).alias("link"), F.lit(ends.index((link.parent, link.key))).alias("end"),
                    canonical_key(link.column).alias("key"),
                )
                entries.append(F.when(F.col(link.kind[0]) == F.lit(link.kind[1]), entry) if link.kind else entry)
        # Entries of another kind are NULL and dropped.
        return tables[table].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")

    counts = reduce(DataFrame.unionByName, map(children, dict.fromkeys(link.child for _, link in known)))
    counts = counts.groupBy("end", "key", "link").agg(F.count("*").alias("n"))
    parents = reduce(
        DataFrame.unionByName,
        (tables[t].select(F.lit(i).alias("end"), canonical_key(k).alias("key")) for i, (t, k) in enumerate(ends)),
    )
    parents = parents.distinct().withColumn("known", F.lit(True))
    present = F.col("key").isNotNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    found = counts.join(parents, ["end", "key"], "left").groupBy("link").agg(
        total(F.lit(True)).alias("rows"),
        total(~present).alias("null_keys"),
        total(present & F.col("known").isNull()).alias("orphans"),
        F.coalesce(F.max(F.when(present, F.col("n"))), F.lit(0)).alias("max_children"),
    )
    # A link without any child row is reported with zeros.
    described = [
        F.struct(
            F.lit(n).alias("link"), F.lit(link.child).alias("child"), F.lit(link.column).alias("child_column"),
            F.lit(link.parent).alias("parent"), F.lit(link.key).alias("parent_key"),
        )
        for n, link in known
    ]
    names = counts.sparkSession.range(1).select(F.inline(F.array(*described)))
    zero = F.lit(0)
    return names.join(found, "link", "left").select(
        "child", "child_column", "parent", "parent_key",
        *(F.coalesce(c, zero).alias(c) for c in ("rows", "null_keys", "orphans")),
        F.when(F.col("max_children") > 1, F.lit("many:1")).otherwise(F.lit("1:1")).alias("cardinality"),
    )


def check_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """Whether a column is usable as primary key: no NULL, no repetition."""
    return df.agg(
        F.count("*").alias("rows"), F.count(key).alias("non_null"), F.countDistinct(key).alias("unique_keys")
    ).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
        "rows", "non_null", "unique_keys",
        ((F.col("rows") == F.col("non_null")) & (F.col("rows") == F.col("unique_keys"))).alias("is_key"),
    )


def linkage_report(
    entities: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Per (entity, foreign key, looked-up column): rows, linked, resolved, orphaned.

    Works on denormalised entities: a key whose looked-up column is empty points at
    nothing.
    """
    result = None
    for entity in dict.fromkeys(e for e, _, _ in links):
        totals, entries = [F.count("*").alias("rows")], []
        for i, (key, looked_up) in enumerate((k, c) for e, k, c in links if e == entity):
            totals += [
                F.count(key).alias(f"k{i}"), F.count(looked_up).alias(f"r{i}"),
                F.count(F.when(F.col(key).isNotNull() & F.col(looked_up).isNull(), 1)).alias(f"o{i}"),
            ]
            entries.append(
                F.struct(
                    F.lit(entity).alias("entity"), F.lit(key).alias("key_column"), F.lit(looked_up).alias("looked_up"),
                    F.col("rows"), F.col(f"k{i}").alias("with_key"), F.col(f"r{i}").alias("resolved"),
                    F.col(f"o{i}").alias("orphans"),
                )
            )
        # One pass over an entity for all its links.
        part = entities[entity].agg(*totals).select(F.inline(F.array(*entries)))
        result = part if result is None else result.unionByName(part)
    return result


def fan_out(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a join, and their ratio."""
    rows_after = after.agg(F.count("*").alias("n")).scalar()
    return before.agg(F.count("*").alias("rows_before")).select(
        "rows_before", rows_after.alias("rows_after"),
    ).withColumn(
        "ratio",
        F.round(
            F.col("rows_after").cast("decimal(20,0)")
            / F.nullif(F.col("rows_before").cast("decimal(20,0)"), F.lit(0)), 4,
        ),
    ).withColumn("fans_out", F.col("rows_after") > F.col("rows_before"))


def compare_columns(actual: Sequence[str], expected: Sequence[str]) -> dict[str, object]:
    """Missing and extra column names against a specification."""
    missing = sorted(set(expected) - set(actual))
    return {
        "is_valid": not missing,
        "expected_count": len(set(expected)),
        "actual_count": len(set(actual)),
        "missing_columns": ",".join(missing),
        "extra_columns": ",".join(sorted(set(actual) - set(expected))),
    }


def validate_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``compare_columns`` and the row count, as one row."""
    found = compare_columns(df.columns, expected)
    return df.agg(F.count("*").alias("row_count")).select(
        *(F.lit(value).alias(name) for name, value in found.items()), "row_count"
    )


def required_fields(legacy: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Per required field: rows in which it is missing or blank."""
    fields = [f for f in mapping.fields if f.required]
    row = legacy.agg(
        F.count("*").alias("rows"),
        *(
            F.count(F.when(_blank(legacy, legacy_column(f, legacy.columns)), 1)).alias(f"n{i}")
            for i, f in enumerate(fields)
        ),
    )
    entries = [
        F.struct(
            F.lit(f.legacy).alias("legacy_column"), F.lit(f.target).alias("target_property"),
            F.col(f"n{i}").alias("missing"),
        )
        for i, f in enumerate(fields)
    ]
    return _long_form(row, entries, "rows")


def _blank(df: DataFrame, name: str | None) -> Column:
    if name is None:
        return F.lit(True)
    return _missing(df, name) | (F.trim(F.col(name).cast("string")) == "")


def suggest_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the share of values that parse as each type, and the type that fits all."""
    aggregates = []
    for i, name in enumerate(columns):
        text = F.col(name).cast("string")
        aggregates.append(F.count(text).alias(f"n{i}"))
        aggregates += [
            F.count(F.when(text.rlike(shape), text.try_cast(kind))).alias(f"{label}{i}")
            for label, (shape, kind) in CANDIDATE_TYPES.items()
        ]
    entries = []
    for i, name in enumerate(columns):
        filled = F.col(f"n{i}")
        suggestion = F.lit("string")
        for label in reversed(CANDIDATE_TYPES):
            fits = (F.col(f"{label}{i}") == filled) & (filled > 0)
            suggestion = F.when(fits, F.lit(label)).otherwise(suggestion)
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                filled.alias("filled"),
                *(
                    share(F.col(f"{label}{i}"), filled).alias(f"{label}_percent")
                    for label in CANDIDATE_TYPES
                ),
                suggestion.alias("suggested_type"),
            )
        )
    return _long_form(df.agg(*aggregates), entries)
