"""Keys and links that tables have, found in their data.

Links are inclusions: the values of one column occur among those of a column without repetitions. One pass over each
table makes a theta sketch (the smallest hashes) of every column. Pairs of sketches rule out most pairs of columns; only
what survives is counted, on distinct values. Keys are column sets without repetitions, searched by size: a set that
holds a key is no longer minimal, one whose columns have too few values together cannot be one. Most of the rest are
ruled out by a repetition found among a part of their values, taken by hash and so with all the rows of each value, for
many sets in one pass; what has none there is counted whole.

What sketches decide has a margin of several standard errors; what they let pass is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, StructField, StructType, TimestampNTZType,
    TimestampType,
)

from crmweave.functions.keys import canonical_key
from crmweave.session import checkpoint, shared_folder
from crmweave.specs import Relationship

ID_TYPES = (ByteType, ShortType, IntegerType, LongType, StringType)
KEY_TYPES = (*ID_TYPES, DecimalType, DateType, TimestampType, TimestampNTZType)
SKETCH = 12  # 2**12 hashes a column
MARGIN = 3  # standard errors
DISTINCT_ERROR = 0.02  # of a count by sketch
SETS_A_PASS = 150
PARTS = (256, 16)  # one in so many values of a set is looked at before it is counted whole


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def columns_of(df: DataFrame, types: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def column_sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """id, table_name, column_name, filled and the sketch of the canonical values of each column that may hold ids."""
    parts, number = [], 0
    for table, df in tables.items():
        names = columns_of(df, ID_TYPES)
        if not names:
            continue
        aggregates, entries = [], []
        for i, name in enumerate(names):
            key = canonical_key(quoted(name))
            aggregates += [F.count(key).alias(f"n{i}"), F.theta_sketch_agg(key, SKETCH).alias(f"s{i}")]
            entries.append(
                F.struct(
                    F.lit(number).alias("id"), F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                    F.col(f"n{i}").alias("filled"), F.col(f"s{i}").alias("sketch"),
                )
            )
            number += 1
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*entries))))
    if not parts:
        raise ValueError("no table has a column that may hold ids")
    return reduce(DataFrame.unionByName, parts).withColumn("distinct", F.theta_sketch_estimate("sketch"))


def likely_links(sketches: DataFrame, containment: float, least_distinct: int) -> DataFrame:
    """Pairs of columns (child, parent: ids) that the sketches do not rule out; as many rows as columns squared at most."""
    known = sketches.where(F.col("distinct") >= least_distinct)
    parents = known.where(F.col("distinct") >= (1 - MARGIN / 2 ** (SKETCH / 2)) * F.col("filled"))
    ids = parents.agg(F.array_agg("id").alias("parents")).scalar()
    children = known.select(F.col("id").alias("child"), F.col("sketch").alias("c"), F.col("distinct").alias("d"), F.explode(ids).alias("parent"))
    both = children.where("child <> parent").join(
        parents.select(F.col("id").alias("parent"), F.col("sketch").alias("p"), F.col("distinct").alias("e")), "parent"
    )
    # Hashes below the bound of both sketches are a sample of the child's values; it has s of them.
    bound = F.least(F.lit(1.0), F.lit(2.0**SKETCH) / F.greatest("d", "e"))
    s = F.col("d") * bound
    slack = F.when(bound < 1, MARGIN * F.sqrt(s) + 1).otherwise(F.lit(0.5))
    shared = F.theta_sketch_estimate(F.theta_intersection("c", "p"))
    return both.where(shared * bound >= containment * s - slack).select("child", "parent")


def discover_links(
    tables: Mapping[str, DataFrame], containment: float = 0.9, least_distinct: int = 2, declared: Sequence[Relationship] = ()
) -> DataFrame:
    """Links (child column, parent key): at least ``containment`` of the child's distinct values are in the parent.

    A parent key is a column whose values do not repeat. Per link: filled child rows, those among them that point at
    nothing (orphans), the share of the parent's values that are pointed at (coverage), and whether it is ``declared``.
    """
    sketches = checkpoint(column_sketches(tables))  # a row per column
    named = [(r["id"], r["table_name"], r["column_name"]) for r in sketches.select("id", "table_name", "column_name").collect()]
    pairs = [(r["child"], r["parent"]) for r in likely_links(sketches, containment, least_distinct).collect()]
    used = {i for pair in pairs for i in pair}
    spark = sketches.sparkSession
    parts = []
    for table, df in tables.items():
        entries = [
            F.struct(F.lit(i).alias("id"), canonical_key(quoted(name)).alias("key")) for i, t, name in named if t == table and i in used
        ]
        if entries:
            parts.append(df.select(F.inline(F.array(*entries))))
    described = {i: (t, c) for i, t, c in named}
    known = {(r.child, r.column, r.parent, r.key) for r in declared}
    rows = [(c, p, *described[c], *described[p], (*described[c], *described[p]) in known) for c, p in pairs]
    schema = "child_id int, parent_id int, child string, child_column string, parent string, parent_key string, declared boolean"
    links = spark.createDataFrame(rows, schema)  # columns of the tables squared at most
    if not parts:
        counted = spark.createDataFrame([], "id int, key string, n long")
    else:
        # Read in three ways below; the tables are read for it once.
        path = f"{shared_folder(spark)}/link-values-{uuid.uuid4().hex}"
        values = reduce(DataFrame.unionByName, parts).where("key is not null").groupBy("id", "key").agg(F.count("*").alias("n"))
        values.write.parquet(path)
        counted = spark.read.schema(values.schema).parquet(path)
    sizes = counted.groupBy("id").agg(F.count("*").alias("values"), F.max("n").alias("most"), F.sum("n").alias("filled"))
    unique = sizes.where("most = 1").select(F.col("id").alias("parent_id"), F.col("values").alias("parent_values"))
    filled = sizes.select(F.col("id").alias("child_id"), F.col("values").alias("child_values"), F.col("filled").alias("rows"))
    open_ = links.join(unique, "parent_id").join(filled, "child_id")
    # Values meet by the key alone, so that they move once and not once for every parent that a child may have.
    children = counted.where(F.col("id").isin(sorted({c for c, _ in pairs}))).select("key", F.col("id").alias("child_id"), "n")
    parents = counted.where(F.col("id").isin(sorted({p for _, p in pairs}))).select("key", F.col("id").alias("parent_id"))
    likely = F.broadcast(links.select("child_id", "parent_id"))
    met = children.join(parents, "key").join(likely, ["child_id", "parent_id"]).groupBy("child_id", "parent_id").agg(
        F.sum("n").alias("hit"), F.count("*").alias("shared")
    )
    found = open_.join(met, ["child_id", "parent_id"], "left").withColumns(
        {"shared": F.coalesce("shared", F.lit(0)), "orphans": F.col("rows") - F.coalesce("hit", F.lit(0))}
    )
    return found.where(
        (F.col("shared") >= containment * F.col("child_values")) & (F.col("child_values") >= least_distinct)
    ).select(
        "child", "child_column", "parent", "parent_key", "rows", "orphans",
        F.round(F.col("shared") / F.col("parent_values"), 6).alias("coverage"), "declared",
    )


def discover_keys(df: DataFrame, table: str, most: int = 3, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimal keys of at most ``most`` columns: sets without NULLs and repetitions, none of which holds a smaller one.

    Columns of floating or nested types are not tried unless named.
    """
    names = list(columns or columns_of(df, KEY_TYPES))
    first = df.agg(
        F.count("*").alias("rows"),
        *(F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(names)),
        *(_distinct([c]).alias(f"d{i}") for i, c in enumerate(names)),
    ).first()
    rows = first["rows"]
    distinct = {c: first[f"d{i}"] for i, c in enumerate(names) if first[f"n{i}"] == rows}
    enough = rows * (1 - 5 * DISTINCT_ERROR)
    keys: list[tuple[str, ...]] = []
    for size in range(1, most + 1) if rows else ():
        sets = [s for s in combinations(distinct, size) if not any(set(k) <= set(s) for k in keys)]
        sets = [s for s in sets if prod(distinct[c] * (1 + 5 * DISTINCT_ERROR) for c in s) >= rows]
        if size == 1:
            sets = [s for s in sets if distinct[s[0]] >= enough]
        for parts in PARTS:
            sets = _unrepeated(df, sets, parts)
        keys += [s for s in sets if _is_key(df, s)]
    schema = StructType([StructField("table_name", StringType()), StructField("key_columns", StringType()), StructField("rows", LongType())])
    return df.sparkSession.createDataFrame([(table, ",".join(k), rows) for k in keys], schema)


def _unrepeated(df: DataFrame, sets: list[tuple[str, ...]], parts: int) -> list[tuple[str, ...]]:
    """Sets of which no value repeats among one in ``parts`` of their values, all in one pass; columns without NULLs.

    The values are chosen by hash, so a chosen value comes with all its rows, and they are compared themselves: a set
    left out here is certainly no key.
    """
    kept = []
    for at in range(0, len(sets), SETS_A_PASS):
        some = sets[at : at + SETS_A_PASS]
        used = list(dict.fromkeys(c for s in some for c in s))
        chosen = [F.pmod(F.xxhash64(*(quoted(c) for c in s)), F.lit(parts)) == 0 for s in some]
        rows = df.where(reduce(or_, chosen)).select(
            F.explode(F.array(*(F.when(x, F.lit(i)) for i, x in enumerate(chosen)))).alias("__set"), *(quoted(c) for c in used)
        ).where("__set is not null")
        values = [
            F.when(F.col("__set").isin([i for i, s in enumerate(some) if c in s]), quoted(c)).alias(f"__v{j}") for j, c in enumerate(used)
        ]
        repeated = rows.groupBy("__set", *values).agg(F.count("*").alias("__n")).where("__n > 1").select("__set").distinct()
        bad = {r[0] for r in repeated.collect()}
        kept += [s for i, s in enumerate(some) if i not in bad]
    return kept


def _distinct(names: Sequence[str]) -> Column:
    """Number of distinct values of several columns together, by a sketch that is one field of the aggregate's buffer."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*(quoted(c) for c in names)), SKETCH))


def _is_key(df: DataFrame, names: Sequence[str]) -> bool:
    """Whether no values repeat, on the values themselves; columns without NULLs."""
    return df.groupBy(*(quoted(c) for c in names)).agg(F.count("*").alias("__n")).where("__n > 1").isEmpty()
