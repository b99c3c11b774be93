"""Totals over all subtrees of a forest by parallel tree contraction.

Rounds alternate. Compress takes every chain of nodes with one child out at once: each such node points at its child and
carries its own values, and pointers are doubled until they reach the node below the chain, in a number of joins that
grows with the logarithm of the chain. What the chain holds stays with that node as up_*, for the parent above. Rake then
takes all leaves off, whose totals are complete, and adds them to their parents. After a compress every inner node has two children or more, so a rake takes at least half of what is left, and
the rounds grow with the logarithm of the nodes, whatever the depth. At last the chains are expanded in reverse order:
the total of a node is what it carries and the total of the node it points at.

Every round is a stored table. Children are summed with partial sums before the shuffle, and no node's children are gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.frames import stored


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _compressed(live: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """The nodes without those of one child, and (id, target, values): what each of those is apart from its target."""
    ups = [f"up_{v}" for v in values]
    child = live.filter("parent is not null").select(
        F.col("parent").alias("id"), F.col("id").alias("target"), *(F.col(u).alias(f"child_{u}") for u in ups)
    )
    chained = live.filter("kids = 1").join(child, "id")
    links = stored(chained.select("id", "parent", "target", *((F.col(v) + F.col(f"child_up_{v}")).alias(v) for v in values), *ups), "links")
    if links.isEmpty():
        return live, None
    settled, moving = None, links.select("id", "target", *values)
    while True:
        ahead = _union(settled, moving).select(
            F.col("id").alias("target"), F.col("target").alias("next"), *(F.col(v).alias(f"next_{v}") for v in values)
        )
        step = stored(
            moving.join(ahead, "target", "left").select(
                "id", F.coalesce("next", "target").alias("target"),
                *((F.col(v) + F.coalesce(f"next_{v}", F.lit(0))).alias(v) for v in values), F.col("next").isNotNull().alias("moved"),
            ),
            "links",
        )
        settled, moving = _union(settled, step.filter("not moved").drop("moved")), step.filter("moved").drop("moved")
        if moving.isEmpty():
            break
    # What is below a chain hangs from what is above it, and brings along what the chain holds.
    tops = links.select("id", "parent", *ups).join(links.select(F.col("target").alias("id")), "id", "left_anti")
    bottoms = tops.join(settled, "id").select(
        F.col("target").alias("id"), F.col("parent").alias("above"), F.lit(True).alias("hung"),
        *((F.col(v) + F.col(f"up_{v}")).alias(f"chain_{v}") for v in values),
    )
    rest = live.filter("kids <> 1").join(bottoms, "id", "left").select(
        "id", F.expr("if(hung, above, parent)").alias("parent"), "kids", *values, *(F.coalesce(f"chain_{v}", f"up_{v}").alias(f"up_{v}") for v in values)
    )
    return stored(rest, "live"), settled


def _raked(live: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The nodes without the leaves, whose values their parents get, and the leaves."""
    leaves = live.filter("kids = 0")
    given = leaves.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("gone"), *(F.sum(F.col(v) + F.col(f"up_{v}")).alias(f"given_{v}") for v in values)
    )
    rest = live.filter("kids > 0").join(given, "id", "left").select(
        "id", "parent", (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
        *((F.col(v) + F.coalesce(f"given_{v}", F.lit(0))).alias(v) for v in values), *(f"up_{v}" for v in values),
    )
    return stored(rest, "live"), leaves.select("id", *values)


def subtree_totals(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, *values) for every node, each value summed over the node and all below it.

    ``nodes``: id (a long, once each), parent (an id, null for a root), values (longs). A forest without nodes gives none.
    """
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"))
    zero = F.lit(0).cast("long")
    live = stored(
        nodes.join(kids, "id", "left").select("id", "parent", F.coalesce("kids", zero).alias("kids"), *values, *(zero.alias(f"up_{v}") for v in values)),
        "live",
    )
    totals, chains = live.select("id", *values).limit(0), []
    while not live.isEmpty():
        live, links = _compressed(live, values)
        if links is not None:
            chains.append(links)
        live, leaves = _raked(live, values)
        totals = totals.unionByName(leaves)
    for links in reversed(chains):
        below = totals.select(F.col("id").alias("target"), *(F.col(v).alias(f"below_{v}") for v in values))
        whole = links.join(below, "target").select("id", *((F.col(v) + F.col(f"below_{v}")).alias(v) for v in values))
        totals = totals.unionByName(stored(whole, "totals"))
    return totals
