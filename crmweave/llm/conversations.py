"""Prefix trie of conversations, with totals of every subtree by tree contraction.

A node is a distinct sequence of first turns (role, text). Turns are sorted by ranges of (conversation, turn), so a long
conversation lies in several tasks; each task keeps running hashes of what it has of a conversation, and the few numbers
at the ends of tasks complete them. A sequence of turns is a polynomial over the turns' SHA-256 values, modulo
2**61 - 1 and at two drawn bases: two such numbers and the depth identify a node. A hash of a sequence follows from
those of its parts, so conversations that take over turns of another need no second sort.

Ties: turns of one number go by a hash of role and text. A null turn comes first, null roles and texts are empty, rows
without a conv_id belong to no conversation. Repeated rows are turns of their own. Extra columns are not read. A table
without a conversation has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.contraction import subtree_totals
from crmweave.llm.frames import stored
from crmweave.llm.text import PRIME

BASE_A, BASE_B = (int(x) for x in np.random.Generator(np.random.PCG64(20240313)).integers(1 << 60, PRIME, 2))
IDS_A_CHUNK = 4096
NO_IDS = hashlib.sha256(b"").hexdigest()
# pa, pb: hashes of the turns before; qa, qb: those with this turn.
SCANNED = "part int, conv_id long, pos long, tokens long, pa long, pb long, qa long, qb long"
NODE = ["depth", "qa", "qb"]


def values(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def longs(*names: str) -> pa.Schema:
    return pa.schema([pa.field(n, pa.int64()) for n in names])


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, tokens (code points of the text) and two numbers that stand for role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    return (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.length(text).cast("long").alias("tokens"), digest.alias("digest"))
        .select("conv_id", "turn", "tokens", number(1).alias("a"), number(16).alias("b"))
    )


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and running hashes of each turn, from the first of its conversation in this task."""
    part, schema = TaskContext.get().partitionId(), longs("conv_id", "pos", "tokens", "pa", "pb", "qa", "qb")
    schema = schema.insert(0, pa.field("part", pa.int32()))
    now, pos, ha, hb = None, 0, 0, 0
    for batch in batches:
        rows = []
        for conv, tokens, a, b in values(batch):
            if conv != now:
                now, pos, ha, hb = conv, 0, 0, 0
            qa, qb = (ha * BASE_A + a + 1) % PRIME, (hb * BASE_B + b + 1) % PRIME
            rows.append((part, conv, pos, tokens, ha, hb, qa, qb))
            pos, ha, hb = pos + 1, qa, qb
        yield as_batch(rows, schema)


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), tokens, pa, pb, qa, qb of every turn."""
    turns = stored(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    order = ["conv_id", "turn", "a", "b", "row"]
    in_order = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "tokens", "a", "b")
    local = stored(in_order.mapInArrow(_scanned, SCANNED), "scanned")
    # One row a task: what each leaves to the next.
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos", "qa", "qb")).alias("last")).orderBy("part").collect()
    carried, now, count, ca, cb = [], None, 0, 0, 0
    for r in ends:
        conv, pos, qa, qb = r["last"]
        if now == r["first"]:
            carried.append((r["part"], now, count, ca, cb))
        if now != conv:
            count, ca, cb = 0, 0, 0
        now, ca, cb = conv, (ca * pow(BASE_A, pos + 1, PRIME) + qa) % PRIME, (cb * pow(BASE_B, pos + 1, PRIME) + qb) % PRIME
        count += pos + 1
    names = ["conv_id", "pos", "tokens", "pa", "pb", "qa", "qb"]
    if not carried:
        return local.select(names)
    before = local.sparkSession.createDataFrame(carried, "part int, conv_id long, count long, ca long, cb long")
    both = local.join(F.broadcast(before), ["part", "conv_id"], "left")  # at most a row a task
    shifted = both.filter("count is not null").select(
        "conv_id", (F.col("pos") + F.col("count")).alias("pos"), "tokens", "pa", "pb", "qa", "qb", F.col("pos").alias("size"), "ca", "cb"
    )
    return both.filter("count is null").select(names).unionByName(after(shifted))


def after(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, pos, tokens, pa, pb, qa, qb, size, ca, cb) with ca, cb put before the size turns of pa, pb."""
    schema = longs("conv_id", "pos", "tokens", "pa", "pb", "qa", "qb")

    def over(batches):
        for batch in batches:
            made = []
            for conv, pos, tokens, pa_, pb, qa, qb, size, ca, cb in values(batch):
                if ca or cb:
                    xa, xb = ca * pow(BASE_A, size, PRIME), cb * pow(BASE_B, size, PRIME)
                    pa_, pb, qa, qb = (pa_ + xa) % PRIME, (pb + xb) % PRIME, (qa + xa * BASE_A) % PRIME, (qb + xb * BASE_B) % PRIME
                made.append((conv, pos, tokens, pa_, pb, qa, qb))
            yield as_batch(made, schema)

    names = ["conv_id", "pos", "tokens", "pa", "pb", "qa", "qb"]
    return rows.select(*names, "size", "ca", "cb").mapInArrow(over, ", ".join(f"{n} long" for n in names))


def rebuilt(turns: DataFrame, taken: Column, source: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one.

    ``turns`` as ``numbered`` gives them. Each conversation drops its first ``taken`` turns (``most`` at most) and begins
    with as many of conversation ``source`` instead, or with what that has. Both are expressions over conv_id. Returns the
    turns (conv_id, depth from 1, tokens, pa, pb, qa, qb) and the conversations (conv_id, depth, qa, qb of the whole).
    """
    sizes = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    convs = sizes.select("conv_id", "n", taken.alias("h"), source.alias("source"))
    start = stored(turns.filter(F.col("pos") < most), "starts")
    had = sizes.select(F.col("conv_id").alias("source"), F.col("n").alias("source_n"))
    at = lambda x: start.select(
        F.col("conv_id").alias(x), F.col("pos").alias("pos" if x == "conv_id" else f"pos_{x}"), F.col("qa").alias(f"a_{x}"), F.col("qb").alias(f"b_{x}")
    )
    convs = convs.join(had, "source", "left").withColumn("k", F.least("h", F.coalesce("source_n", F.lit(0).cast("long"))))
    convs = convs.join(at("source").withColumn("k", F.col("pos_source") + 1), ["source", "k"], "left")
    convs = convs.join(at("conv_id").withColumn("h", F.col("pos") + 1).drop("pos"), ["conv_id", "h"], "left")
    zero = F.lit(0).cast("long")
    convs = stored(
        convs.select(
            "conv_id", "source", "n", "h", "k", *(F.coalesce(c, zero).alias(c) for c in ("a_source", "b_source", "a_conv_id", "b_conv_id"))
        ),
        "starts",
    )
    first = convs.filter("k > 0").select("conv_id", "source", "k").join(start.withColumnRenamed("conv_id", "source"), "source").filter("pos < k").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "tokens", "pa", "pb", "qa", "qb"
    )
    # The hash of a later turn has those of the dropped ones in it; what differs is exchanged.
    lead = convs.select(
        "conv_id", "n", "h", "k", F.pmod(F.col("a_source") - F.col("a_conv_id"), F.lit(PRIME)).alias("ca"),
        F.pmod(F.col("b_source") - F.col("b_conv_id"), F.lit(PRIME)).alias("cb"),
    )
    own = turns.join(lead, "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("k") + F.col("pos") - F.col("h") + 1).alias("pos"), "tokens", "pa", "pb", "qa", "qb",
        (F.col("pos") - F.col("h")).alias("size"), "ca", "cb",
    )
    own = after(own).withColumnRenamed("pos", "depth")
    members = stored(first.unionByName(own), "members")
    whole = convs.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("depth"))
    deep = members.join(whole.filter("depth > 0"), ["conv_id", "depth"]).select("conv_id", *NODE)
    return members, deep.unionByName(whole.filter("depth = 0").select("conv_id", "depth", zero.alias("qa"), zero.alias("qb")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, in order, as text."""
    schema = longs(*NODE, "first").append(pa.field("ids", pa.string()))
    now, ids = None, []
    for batch in batches:
        rows = []
        for *node, conv in values(batch):
            if node != now or len(ids) == IDS_A_CHUNK:
                if ids:
                    rows.append((*now, ids[0], ",".join(map(str, ids))))
                now, ids = node, []
            ids.append(conv)
        yield as_batch(rows, schema)
    if ids:
        yield as_batch([(*now, ids[0], ",".join(map(str, ids)))], schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = longs(*NODE).append(pa.field("ends_sha256", pa.string()))
    now, state = None, None
    for batch in batches:
        rows = []
        for *node, _, ids in values(batch):
            if node != now:
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        yield as_batch(rows, schema)
    if now is not None:
        yield as_batch([(*now, state.hexdigest())], schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """Node and SHA-256 of the comma-joined ids that end there, in ascending order.

    Ids are sorted and joined by ranges, so those of one node are joined in several tasks; only the joined texts, some
    thousands of ids a row, are hashed in sequence.
    """
    order = [*NODE, "conv_id"]
    chunks = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, qa long, qb long, first long, ids string"
    )
    return stored(chunks, "ends").repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        _digests, "depth long, qa long, qb long, ends_sha256 string"
    )


def trie(members: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes of the conversations ``ends`` with the turns ``members`` (see ``rebuilt``).

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    grouped = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *(F.min(c).alias(c) for c in ("pa", "pb", "tokens"))
    )
    nodes = stored(grouped.withColumn("id", F.monotonically_increasing_id() + 1), "nodes")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("qa").alias("pa"), F.col("qb").alias("pb"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    top = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    least = top.first()["conv_id"]
    names = ["id", "parent", *NODE, "conv_id", "parent_conv_id", "n_convs", "saved"]
    saved = ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved")
    low = nodes.filter("depth > 1").join(above, ["depth", "pa", "pb"]).withColumn("saved", saved).select(names)
    high = nodes.filter("depth = 1").withColumns({"parent": zero, "parent_conv_id": F.lit(least).cast("long"), "saved": saved}).select(names)
    root = top.filter("n_convs > 0").select(
        zero.alias("id"), none.alias("parent"), *(zero.alias(c) for c in NODE), "conv_id", none.alias("parent_conv_id"), "n_convs", zero.alias("saved")
    )
    linked = stored(low.unionByName(high).unionByName(root), "linked")
    children = linked.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = stored(
        linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumn(
            "leaves", F.expr("if(n_children = 0, 1L, 0L)")
        ),
        "tree",
    )
    totals = subtree_totals(tree.select("id", "parent", "leaves", "saved"), ["leaves", "saved"])
    totals = totals.select("id", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    found = tree.drop("leaves", "saved").join(totals, "id").join(end_digests(ends), NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are (conv_id, turn, role, text)."""
    return trie(*rebuilt(numbered(turns_of(conversations)), F.lit(0).cast("long"), F.col("conv_id"), 0))


def shared_starts_trie(conversations: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """The trie of conversations that begin with turns of the one at the head of their ``every``.

    Conversation c takes h = crc32(c as decimal text) % (most + 1) first turns of conversation c - c % every; the
    remainder has the sign of c.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    return trie(*rebuilt(numbered(turns_of(conversations)), taken, F.col("conv_id") - F.col("conv_id") % every, most))
