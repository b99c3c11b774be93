"""Connected components of a graph of links, as rounds of joins (large star, small star) over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.frames import stored


def _open(links: DataFrame) -> bool:
    """Whether the links (a < b) are more than stars: an id has two smaller ones, or a smaller and a larger one."""
    ends = links.select(F.col("b").alias("id"), F.col("a").alias("up"), F.lit(False).alias("down")).unionByName(
        links.select(F.col("a").alias("id"), F.lit(None).cast("long").alias("up"), F.lit(True).alias("down"))
    )
    seen = ends.groupBy("id").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.bool_or("down").alias("down"))
    return bool(seen.agg(F.bool_or(F.col("low").isNotNull() & (F.col("down") | (F.col("low") != F.col("high"))))).first()[0])


def _linked_to_least(pairs: DataFrame, keep: str) -> DataFrame:
    """Every neighbour v of u (where ``keep`` holds) linked to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u").filter(keep)


def stars(edges: DataFrame) -> DataFrame:
    """(id, component) for the ids in the links ``a``, ``b`` that are not the least id of their component, stored.

    The links are read several times, so they should be stored. In a large star every node links its larger neighbours
    to the least one it knows; in a small star it links its smaller ones and itself. The links shrink towards stars
    around least ids, in a number of rounds that grows with the logarithm of the longest path; links that are stars take
    none. Minima are combined before the shuffle, and no node's neighbours are gathered.
    """
    links, held = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), False
    while _open(links):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # No more rows than links, so only what follows is made distinct.
        down = _linked_to_least(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
        links, held = stored(small.filter("a <> b").distinct(), "links"), True
    return (links if held else stored(links.distinct(), "links")).select(F.col("b").alias("id"), F.col("a").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the links ``a``, ``b``; the component is its least id."""
    found = stars(stored(edges.select("a", "b"), "links"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
