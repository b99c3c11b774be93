"""Near-duplicate embeddings by a forest of random-projection trees.

Equal vectors become one class first. A bounded sample shows directions around which many vectors lie (hubs): vectors
within half the angle of the threshold of a hub are all linked with each other, so they are counted, not compared, and
whatever links with one of them lies within one and a half times that angle of the hub. Those are compared with the hub's
vectors, in blocks. All other vectors go down every tree of a forest (see ``forest``), whose splits a sample gives too;
leaves that are too large for the sample are split again, each on a sample of its own. Vectors are compared within
leaves, in double precision and in blocks. A pair that shares several leaves counts in the first of them.

A task gives for each vector of a block the number of its links and one vector it is linked with, never pairs, so a
dense group makes no more rows than its blocks have. Components are joined by union-find over such links.

What is found is exact: no link below the threshold. Links of hubs are complete. A pair of other vectors is missed if
every tree parts it; tests hold the recall against brute force. Up to LEAF vectors there is no split, so nothing is missed.

Vectors that are null, zero or hold null or non-finite entries, and those of a null key, are linked with nothing; the
component of a null key is null. Vectors of different lengths count as ending in zeros. Rows that repeat a key are rows
of their own, linked where their vectors are. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.components import components
from crmweave.llm.forest import DEPTH, fitted, routed
from crmweave.llm.frames import arrow_rows, stored
from crmweave.llm.vectors import longest, matrix, usable

LEAST = 0.95
TREES = 6
LEAF = 1024  # vectors that a leaf should have
BLOCK = 2048  # vectors that are compared at once, on either side
SAMPLE, SAMPLE_BYTES = 8192, 64 << 20  # classes that hubs and splits are fitted on, about
HUB_LEAST = 16  # of the sample that must lie around a hub
SLACK = 1e-9
TREE_BIT = 52
LINKS = "cid long, links long, root long"


def units(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors; their largest entry is taken out first, so no square leaves the range of doubles."""
    x = matrix(column, size)
    x = x / np.maximum(np.abs(x).max(axis=1, initial=0.0), np.finfo(float).tiny)[:, None]
    return x / np.maximum(np.linalg.norm(x, axis=1), np.finfo(float).tiny)[:, None]


def hubs_of(sample: np.ndarray, least: float) -> np.ndarray:
    """Directions within half an angle of which at least HUB_LEAST of the sample lie; each counts what others leave."""
    near = np.sqrt((1 + least) / 2)
    counts = np.concatenate([(sample[i : i + 256] @ sample.T >= near).sum(axis=1) for i in range(0, len(sample), 256)] or [np.zeros(0, int)])
    free, hubs = np.ones(len(sample), bool), []
    for i in np.argsort(-counts, kind="stable"):
        if counts[i] < HUB_LEAST:
            break
        around = free & (sample @ sample[i] >= near)
        if not free[i] or around.sum() < HUB_LEAST:
            continue
        middle = sample[around].mean(axis=0)
        middle /= np.linalg.norm(middle)
        around = free & (sample @ middle >= near)
        hubs.append(middle)
        free &= ~around
    return np.array(hubs).reshape(len(hubs), sample.shape[1])


def _first_places(classes: DataFrame, size: int, hubs: np.ndarray, trees: list[np.ndarray], least: float) -> DataFrame:
    """Each class with its hub or its leaves, and the hubs whose vectors it must be compared with."""
    half = np.arccos(least) / 2
    inside, reach = np.cos(half) + SLACK, np.cos(3 * half) - SLACK

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = units(batch.column(2), size)
            angle = x @ hubs.T if len(hubs) else np.full((len(x), 1), -2.0)
            hub = np.where(angle.max(axis=1) >= inside, angle.argmax(axis=1), -1)
            others = np.arange(angle.shape[1])
            # A pair of two hubs' vectors is compared once, at the earlier hub.
            row, of = np.nonzero((angle >= reach) & np.where(hub[:, None] >= 0, others < hub[:, None], True))
            near = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(x) + 1)), pa.int32()), pa.array(of, pa.int32()))
            free = np.flatnonzero(hub < 0)
            rows, leaves = [], []
            for t, bounds in enumerate(trees):
                r, node = routed(x[free], bounds, t, 0)
                rows.append(free[r])
                leaves.append((t << TREE_BIT) | node)
            row, leaf = np.concatenate(rows), np.concatenate(leaves)
            order = np.lexsort((leaf, row))
            at = pa.array(np.searchsorted(row[order], np.arange(len(x) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hub, pa.int32()), near, pa.ListArray.from_arrays(at, pa.array(leaf[order]))],
                names=["cid", "rows", "vector", "hub", "near", "leaves"],
            )

    kind = classes.schema["vector"].dataType.simpleString()
    schema = f"cid long, rows long, vector {kind}, hub int, near array<int>, leaves array<long>"
    return classes.select("cid", "rows", "vector").mapInArrow(over, schema)


def _split_again(placed: DataFrame, size: int, leaf: int) -> DataFrame:
    """The same with every leaf of more than four times the wanted size split, each on a sample of its own vectors."""
    entries = placed.select("cid", "vector", F.explode("leaves").alias("leaf"))
    large = stored(entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 4 * leaf), "leaves")
    if large.isEmpty():
        return placed
    inside = entries.join(large, "leaf")
    drawn = inside.filter(F.pmod(F.xxhash64("cid", "leaf"), F.col("size")) < 1024)
    samples = drawn.groupBy("leaf", "size").agg(F.collect_list("vector").alias("sample"))
    halves = lambda key: (key >> TREE_BIT, key & ((1 << TREE_BIT) - 1))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                key, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                bounds = fitted(units(batch.column(2)[i].values, size), *halves(key), leaf / n)
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([bounds.ravel()])], names=["leaf", "bounds"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                key, cid = batch.column(0)[i].as_py(), batch.column(1)[i].values
                bounds = np.array(batch.column(3)[i].as_py()).reshape(-1, 2)
                tree, path = halves(key)
                row, node = routed(units(batch.column(2)[i].values, size), bounds, tree, path)
                made = (tree << TREE_BIT) | (path << (DEPTH + 1)) | node
                yield pa.RecordBatch.from_arrays([cid.take(pa.array(row)), pa.array(made)], names=["cid", "leaf"])

    with arrow_rows(placed.sparkSession, 4):
        splits = stored(samples.mapInArrow(fit, "leaf long, bounds array<double>"), "splits")
        part = F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / BLOCK))
        blocks = inside.groupBy("leaf", part.alias("part")).agg(F.collect_list("cid").alias("cids"), F.collect_list("vector").alias("vectors"))
        moved = stored(blocks.join(splits, "leaf").select("leaf", "cids", "vectors", "bounds").mapInArrow(route, "cid long, leaf long"), "moved")
    kept = entries.select("cid", "leaf").join(large.select("leaf"), "leaf", "left_anti")
    # A class has some leaves a tree.
    leaves = kept.unionByName(moved).groupBy("cid").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    again = placed.drop("leaves").join(leaves, "cid", "left").withColumn("leaves", F.coalesce("leaves", F.array().cast("array<long>")))
    return stored(again.select(placed.columns), "placed")


def _sides(placed: DataFrame) -> DataFrame:
    """The vectors as often as they are compared: key (a leaf, or the ones' complement of a hub), x, y (blocks), side."""
    part = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    columns = ["cid", "rows", "vector", "leaves"]
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("other")

    entries = placed.select(*columns, F.explode("leaves").alias("key"))
    # Stored, so that its size is known before the vectors are moved: where it is small, they stay where they are.
    sizes = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", blocks("n").alias("n")), "sizes")
    met = entries.join(sizes, "key").withColumn("part", part("n")).select("*", others("n"))
    leaf = met.select(
        "key", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), F.expr("if(part <= other, 0, 1)").alias("side"), *columns
    )
    core = placed.filter("hub >= 0").select(*columns, "hub")
    near = placed.select(*columns, F.explode("near").alias("hub"))
    count = lambda df, n: df.groupBy("hub").agg(F.count(F.lit(1)).alias(n)).select("hub", blocks(n).alias(n))
    both = stored(count(core, "n").join(count(near, "m"), "hub"), "sizes")
    key = (-1 - F.col("hub")).cast("long").alias("key")
    one = core.join(both, "hub").withColumn("part", part("n")).select("*", others("m")).select(
        key, F.col("part").alias("x"), F.col("other").alias("y"), F.lit(0).alias("side"), *columns
    )
    two = near.join(both, "hub").withColumn("part", part("m")).select("*", others("n")).select(
        key, F.col("other").alias("x"), F.col("part").alias("y"), F.lit(1).alias("side"), *columns
    )
    return leaf.unionByName(one).unionByName(two)


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least of its component, by links a, b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def padded(leaves: pa.Array) -> np.ndarray:
    """Lists of leaves as rows, filled up with -1."""
    lengths = leaves.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lengths), int(lengths.max(initial=0))), -1)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = leaves.flatten().to_numpy(zero_copy_only=False)
    return out


def shares_earlier(left: np.ndarray, right: np.ndarray, key: int) -> np.ndarray:
    """Whether rows of two tables of leaves share one below ``key``."""
    out = np.zeros(len(left), bool)
    for i in range(left.shape[1]):
        here = left[:, i]
        some = np.flatnonzero((here >= 0) & (here < key) & ~out)
        out[some] = (right[some] == here[some, None]).any(axis=1)
    return out


def links_of(group: pa.Table, size: int, least: float) -> pa.RecordBatch | None:
    """Links within one pair of blocks: for each vector that has some their number and the first of its component here."""
    key, x, y = (group.column(c)[0].as_py() for c in ("key", "x", "y"))
    group = group.combine_chunks()
    column = lambda c: group.column(c).combine_chunks()
    side = column("side").to_numpy()
    cid, rows, vectors, leaves = column("cid").to_numpy(), column("rows").to_numpy(), units(column("vector"), size), padded(column("leaves"))
    alone = key >= 0 and x == y
    left = np.arange(len(side)) if alone else np.flatnonzero(side == 0)
    right = left if alone else np.flatnonzero(side == 1)
    found_a, found_b = [], []
    for i in range(0, len(left), 512):
        a, b = np.nonzero(vectors[left[i : i + 512]] @ vectors[right].T >= least)
        a, b = left[i + a], right[b]
        if alone:
            a, b = a[a < b], b[a < b]
        if key >= 0 and len(a):
            new = ~shares_earlier(leaves[a], leaves[b], key)
            a, b = a[new], b[new]
        found_a.append(a)
        found_b.append(b)
    a, b = np.concatenate(found_a or [left]), np.concatenate(found_b or [left])
    if not len(a):
        return None
    links = np.bincount(a, rows[b], len(side)) + np.bincount(b, rows[a], len(side))
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_pydict(
        {"cid": cid[some], "links": links[some].astype(np.int64), "root": cid[least_labels(len(side), a, b)[some]]}
    )


def _compared(sides: DataFrame, size: int, least: float) -> DataFrame:
    """(cid, links, root) of every pair of blocks. Pairs are sorted together and held one at a time."""
    names = ["key", "x", "y"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def closed() -> Iterator[pa.RecordBatch]:
            if held and (made := links_of(pa.Table.from_batches(held), size, least)) is not None:
                yield made

        for batch in batches:
            at = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            starts = np.flatnonzero(np.append(True, (at[1:] != at[:-1]).any(axis=1))) if len(at) else []
            for s, e in zip(starts, [*starts[1:], len(at)], strict=True):
                if now != (here := tuple(at[s])):
                    yield from closed()
                    now, held = here, []
                held.append(batch.slice(s, e - s))
        yield from closed()

    order = sides.repartition(*names).sortWithinPartitions(*names)
    return order.mapInArrow(over, LINKS)


def linked(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST, trees: int = TREES, leaf: int = LEAF,
) -> DataFrame:
    """key, n_links, component_id, kept for every row."""
    given = embeddings.select(
        F.col(key).cast("long").alias("key"),
        F.when(usable(vector) & F.exists(vector, lambda v: v != 0) & F.col(key).isNotNull(), F.col(vector)).alias("vector"),
    )
    whole = given.filter(F.col("vector").isNotNull())
    size = longest(whole, "vector")
    grouped = whole.groupBy("vector").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("rows"))
    classes = stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    drawn = min(SAMPLE, SAMPLE_BYTES // (8 * max(size, 1)))
    lot = F.pmod(F.xxhash64(F.lit(20240401), "vector"), F.lit(1 << 30))
    sample = classes.filter(lot < (1 << 30) * drawn / max(n, 1)).select("vector").toArrow()
    points = units(sample.column(0).combine_chunks(), size) if len(sample) else np.zeros((0, size))
    hubs = hubs_of(points, least)
    free = points[(points @ hubs.T).max(axis=1) < np.sqrt((1 + least) / 2)] if len(hubs) else points
    share = leaf / max(n * len(free) / max(len(points), 1), 1)
    placed = stored(_first_places(classes, size, hubs, [fitted(free, t, 0, share) for t in range(trees)], least), "placed")
    while (again := _split_again(placed, size, leaf)) is not placed:
        placed = again
    found = stored(_compared(_sides(placed), size, least), "found")
    core = placed.filter("hub >= 0").groupBy("hub").agg(F.min("cid").alias("root"), F.sum("rows").alias("all"))
    inside = placed.filter("hub >= 0").join(core, "hub").select("cid", (F.col("all") - F.col("rows")).alias("links"), "root")
    both = stored(found.unionByName(inside), "links")
    joined = components(both.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    of = classes.join(joined.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    of = stored(of.select("cid", "vector", "least", "rows", "component"), "of")
    names = of.groupBy("component").agg(F.min("least").alias("name"))
    links = both.groupBy("cid").agg(F.sum("links").alias("links"))
    answer = of.join(names, "component").join(links, "cid", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links"), "name"
    )
    return whole.join(answer, "vector").unionByName(
        given.filter(F.col("vector").isNull()).select("key", "vector", F.lit(0).cast("long").alias("links"), F.col("key").alias("name")),
        allowMissingColumns=True,
    ).select(
        F.col("key").alias(key), F.col("links").cast("long").alias("n_links"), F.col("name").alias("component_id"),
        F.coalesce(F.col("key") == F.col("name"), F.lit(True)).alias("kept"),
    )
