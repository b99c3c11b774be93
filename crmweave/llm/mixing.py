"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document belongs to). Tokens flow from patterns
to the quotas of the sources they belong to; the first use of a pattern's tokens costs 0, each further one more than the
one before, so the cost is convex and the cheapest flow repeats as little as it can. The flow runs on aggregated
patterns in the driver, whose number MAX_PATTERNS bounds; documents are then selected where they lie, in a seeded order.

Nulls: a null or empty membership is a pattern of its own, and a null source a source that comes last. A null text has
size 0 and is never taken. Repeated rows are rows of their own. Extra columns do not matter: results carry only the key
and the columns named in the docstrings. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from crmweave.llm.frames import free_name, stored

MAX_PATTERNS = 20_000
# Documents of a pattern are ordered by a seeded hash; the sums of its 2**12 parts (__b) are formed before any sorting.

WORDS = r"[^\x20\x09-\x0D]+"
NULL_LAST = (1, "")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(bare == "", F.lit(0)).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1).cast("long")


def by_code_point(source: str | None) -> tuple:
    return NULL_LAST if source is None else (0, source)


def targets(sizes: dict, weights: Sequence[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2) -> dict:
    """Target of each source: ``share`` of all sizes by weight, at most ``most`` times the source's size.

    What is above is dealt again among the sources still below, by weight, until none is above.
    """
    names = sorted(sizes, key=by_code_point)
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while open_ := [s for s in names if s not in fixed]:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / total for s in open_}
        fixed |= {s: Fraction(most * sizes[s]) for s in above}
        left = max(Fraction(0), left - sum(most * sizes[s] for s in above))
    return fixed


def cheapest_flow(patterns: dict[tuple, int], quotas: dict, most: int) -> dict[tuple, dict]:
    """Tokens that each pattern sends to each of its sources: the largest flow, at least cost.

    Successive shortest paths over source -> pattern -> quota -> sink. The r-th use of a pattern is an arc of its own
    of cost r - 1, so the r-th is filled only when cheaper ways are full.
    """
    pats, names = sorted(patterns, key=repr), sorted(quotas, key=by_code_point)
    start, sink = 0, 1 + len(pats) + len(names)
    at = {s: 1 + len(pats) + i for i, s in enumerate(names)}
    arcs: list[list] = []  # to, room, cost; the way back is the arc's number ^ 1
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(arcs))
        out[b].append(len(arcs) + 1)
        arcs.extend(([b, room, cost], [a, 0, -cost]))
        return len(arcs) - 2

    sent = {}
    for i, p in enumerate(pats):
        for use in range(most):
            arc(start, 1 + i, patterns[p], use)
        for s in p:
            sent[p, s] = arc(1 + i, at[s], most * patterns[p], 0)
    for s in names:
        arc(at[s], sink, quotas[s], 0)
    height = [0] * (sink + 1)
    while True:
        far, via = [float("inf")] * (sink + 1), [-1] * (sink + 1)
        far[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k in out[a]:
                b, room, cost = arcs[k]
                if room and (new := d + cost + height[a] - height[b]) < far[b]:
                    far[b], via[b] = new, k
                    heapq.heappush(heap, (new, b))
        if via[sink] < 0:
            break
        height = [h + (f if f < float("inf") else 0) for h, f in zip(height, far, strict=True)]
        path, b = [], sink
        while b != start:
            path.append(via[b])
            b = arcs[via[b] ^ 1][0]
        flow = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= flow
            arcs[k ^ 1][1] += flow
    return {p: {s: arcs[sent[p, s] ^ 1][1] for s in p} for p in pats}


def plan(
    docs: DataFrame, members: Column, size: Column, most: int, weights: Sequence[int], share: Fraction
) -> tuple[DataFrame, list[tuple]]:
    """One row per pattern: its size, the size and target of its first source, and the tokens it must give."""
    grouped = docs.groupBy(members.alias("pattern")).agg(F.sum(size).cast("long").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(grouped) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; merge rare sources first")
    patterns = {tuple(r["pattern"] or [None]): int(r["size"] or 0) for r in grouped}
    sizes: dict = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes, weights, share, most)
    flow = cheapest_flow(patterns, {s: round(x) for s, x in goal.items()}, most)
    rows = [(list(p), n, int(sizes[p[0]]), float(goal[p[0]]), int(sum(flow[p].values()))) for p, n in patterns.items()]
    schema = StructType(
        [StructField("pattern", ArrayType(StringType())), StructField("pattern_size", LongType())]
        + [StructField("source_size", LongType())]
    ).add("target", "double").add("give", "long")
    return docs.sparkSession.createDataFrame(rows, schema), rows


def prepared(docs: DataFrame, members: Column, key: str, text: str, seed: int) -> DataFrame:
    """The frame with __size, __k (its pattern as text), __p (the pattern), __h (its place in the seeded order), __b."""
    pattern = F.when(F.size(members) > 0, F.array_sort(F.array_distinct(members))).otherwise(F.array(F.lit(None).cast("string")))
    return docs.select(
        "*", word_count(F.col(text)).alias("__size"), pattern.alias("__p"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("__h"),
    ).withColumns({"__k": F.to_json("__p"), "__b": F.shiftrightunsigned("__h", 64 - 12).cast("int")})


def decided(rows: DataFrame, numbers: DataFrame, most: int, weights: Sequence[int], share: Fraction) -> DataFrame:
    """Prepared rows with source_size, target and __copies, how often the mix takes each. ``numbers``: the same rows,
    at least their __size, __p, __k, __h and __b; they are read twice.

    A pattern that must give g tokens gives every document g // size times whole; the rest goes to documents in the
    seeded order, to each while the sum stays within the rest. The first document beyond it is taken if that ends
    nearer to the rest. Only the part of the order in which the rest runs out is sorted.
    """
    given, _ = plan(numbers, F.col("__p"), F.col("__size"), most, weights, share)
    given = given.withColumn("__k", F.to_json("pattern")).drop("pattern")
    rest = F.expr("case when pattern_size > 0 then give % pattern_size else 0 end")
    whole = F.expr("case when pattern_size > 0 then div(give, pattern_size) else 0 end")
    given = given.select("__k", "source_size", "target", rest.alias("__rest"), whole.alias("__whole"))
    w = "partition by __k order by __b rows between unbounded preceding and 1 preceding"
    edge = (
        numbers.groupBy("__k", "__b").agg(F.sum("__size").alias("__s"))
        .withColumn("__before", F.expr(f"coalesce(sum(__s) over ({w}), 0)"))
        .join(F.broadcast(given.select("__k", "__rest")), "__k")
        .filter("__before <= __rest and __rest < __before + __s")
        .select("__k", F.col("__b").alias("__e"), "__before")
    )
    # One row a pattern, so both tables are within MAX_PATTERNS rows.
    rows = rows.join(F.broadcast(given), "__k").join(F.broadcast(edge), "__k", "left")
    order = ", ".join(f"`{c}`" for c in ["__h", *(c for c in rows.columns if not c.startswith("__"))])
    more = "__sum <= __rest or (__sum - __size <= __rest and __sum - __rest < __rest - (__sum - __size))"
    at_edge = rows.filter("__b = __e").withColumn(
        "__sum", F.expr(f"sum(__size) over (partition by __k order by {order} rows unbounded preceding)") + F.col("__before")
    ).withColumn("__more", F.expr(more)).drop("__sum")
    others = rows.filter("__e is null or __b <> __e").withColumn("__more", F.expr("__rest > 0 and (__e is null or __b < __e)"))
    both = at_edge.unionByName(others)
    return both.withColumn("__copies", F.expr("if(__size > 0, __whole + cast(__more as int), 0)"))


SHARE = Fraction(3, 2)
NUMBERS = ("__size", "__p", "__k", "__h", "__b")


def mix(
    docs: DataFrame, members: Column | None = None, key: str = "doc_id", text: str = "text", most: int = 2, seed: int = 0,
    weights: Sequence[int] = (3, 1, 2), share: Fraction = SHARE,
) -> DataFrame:
    """Key, size, source_size, target and taken for every row; ``members`` is an array of sources (default: ``source``)."""
    members = F.array(F.col("source")) if members is None else members
    # Numbers only; the texts are read once.
    rows = stored(prepared(docs, members, key, text, seed).select(key, *NUMBERS), "mix")
    return decided(rows, rows, most, weights, share).select(
        key, F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * F.col("__copies")).cast("long").alias("taken")
    )


def mixed_rows(
    docs: DataFrame, members: Column | None = None, key: str = "doc_id", text: str = "text", most: int = 2, seed: int = 0,
    weights: Sequence[int] = (3, 1, 2), share: Fraction = SHARE,
) -> DataFrame:
    """The rows of the mix, each as often as it is taken, without more columns."""
    members = F.array(F.col("source")) if members is None else members
    # Columns are renamed by position, so that none of theirs clashes with one of ours.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    place = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    named = docs.select("*", members.alias(free_name(docs, "members"))).toDF(*plain.columns, "__m")
    # Texts are counted once; what decides reads only the numbers stored beside them.
    made = prepared(named, F.col("__m"), f"c{docs.columns.index(key)}", f"c{docs.columns.index(text)}", seed)
    rows = stored(made.drop("__m"), "mix")
    taken = decided(rows, rows.select(*NUMBERS), most, weights, share)
    again = taken.withColumn("__n", F.explode(F.expr("array_repeat(0, cast(__copies as int))")))
    return again.select(*(column.alias(c) for c, column in place.items()))
