"""Sharding by rendezvous hashing.

Every (key, shard) pair gets a pseudo-random number u in (0, 1) from the key and the shard's name alone; the row goes
to the shard with the least ``-ln(u) / weight``. A new shard wins some rows and changes no comparison between the old
ones, so only the rows that it wins move. A shard's share of the rows is its share of the weights.

Nulls: a null key is a key of its own (all such rows share one shard). A null text has no bytes. Repeated rows are kept
and get slots of their own. ``shard_rows`` returns its own columns only; ``placed_rows`` keeps all columns, and where one
is called shard or slot, the added one gets an underscore. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.frames import free_name

# Slots are counted in this many parts of each shard, so that no task numbers a whole shard.
SLOT_PARTS = 4096
# The hash gives 52 bits, which a double holds exactly.
HEX_DIGITS, SPAN = 13, float(1 << 52)


def shard_of(key: Column, weights: Sequence[float] | Mapping[int, float]) -> Column:
    """Shard (int) for a key. ``weights``: of shards 0 to n-1, or by shard number; all above 0."""
    pairs = sorted(weights.items() if isinstance(weights, Mapping) else enumerate(weights))
    if not pairs or min(w for _, w in pairs) <= 0:
        raise ValueError("weights must be given and be positive")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    even = len({w for _, w in pairs}) == 1

    def distance(shard: int, weight: float) -> Column:
        drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{shard}:"), text)), 1, HEX_DIGITS), 16, 10).cast("long")
        if even:  # -ln(u) falls as u grows, and the weights do not matter
            return -drawn
        return -F.log((drawn.cast("double") + 0.5) / SPAN) / F.lit(float(weight))

    tries = [F.struct(distance(s, w).alias("d"), F.lit(s).cast("int").alias("s")) for s, w in pairs]
    return (tries[0] if len(tries) == 1 else F.least(*tries))["s"]


def with_slots(df: DataFrame, shard: str, key: str, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is cut into hash parts of the key; their row counts, at most shards x SLOT_PARTS, give each part its first
    slot, and rows are numbered within their part by the key and then by all other columns, so that reruns agree.
    """
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(SLOT_PARTS)).cast("int")
    dealt = df.withColumn("__part", part)
    w = "partition by __shard order by __p rows between unbounded preceding and 1 preceding"
    first = (
        dealt.groupBy(F.col(shard).alias("__shard"), F.col("__part").alias("__p")).count()
        .withColumn("__first", F.expr(f"coalesce(sum(count) over ({w}), 0)"))
        .drop("count")
    )
    order = [key, *(c for c in df.columns if c not in (key, shard))]
    numbered = dealt.withColumn(
        "__row", F.expr(f"row_number() over (partition by `{shard}`, __part order by {', '.join(f'`{c}`' for c in order)})") - 1
    )
    return numbered.join(F.broadcast(first), (F.col(shard) == F.col("__shard")) & (F.col("__part") == F.col("__p"))).select(
        *df.columns, (F.col("__row") + F.col("__first")).cast("long").alias(slot)
    )


def shard_rows(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", weights: Sequence[float] | None = None
) -> DataFrame:
    """Key, size, checksum, shard, slot and the shard after one more shard of mean weight, for every row."""
    weights = list(weights or [1.0] * shards)
    grown = [*weights, sum(weights) / len(weights)]
    bytes_ = F.coalesce(F.col(text), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(key), (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    return with_slots(placed, "shard", key)


def placed_rows(docs: DataFrame, shards: int, key: str = "doc_id", weights: Sequence[float] | None = None) -> DataFrame:
    """All rows with their columns, and ``shard`` and ``slot`` (with underscores where a column has such a name)."""
    shard = free_name(docs, "shard")
    placed = docs.withColumn(shard, shard_of(F.col(key), list(weights or [1.0] * shards)))
    return with_slots(placed, shard, key, free_name(placed, "slot"))
