"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles, as 64-bit hashes. The top bits of a hash choose one of 128 buckets;
of the least hash in a bucket only the count of leading zeros (6 bits) and the next 10 bits are stored. Empty buckets
borrow from others in an order that the bucket alone decides, so equal sets have equal registers. Four registers make a
band, as one 64-bit number; 32 bands find a pair of similarity 0.8 but for a chance of 5e-8.

Steps: documents of equal sets become one class, before anything else. Representatives that share a band are candidates:
each is paired with the least of the ids that come first in its bands' groups, pairs of larger sets whose corrected
estimate is far below the threshold are dropped, and the rest is confirmed on full sets. Sets of fewer than ESTIMATED
shingles borrow most registers, so few shingles decide the estimate; their pairs are all confirmed. Confirmed links are joined to components. Then
the pairs with the other groups' first ids follow, where these are in other components. Groups that still hold several
components are then compared in full, in blocks of registers and only across components, and what they yield is
confirmed and joined as well; so no group is cut, and none is expanded into rows of pairs. Links within a component
would change nothing, so they are not looked for.

Nulls, empty texts and texts without words have no set and are linked with nothing. A null key is linked with nothing
and gets a null component. In ``linked``, rows that repeat a key count as one document of that id; all of them are
returned. ``without_near_copies`` judges every row on its own text. Ties between equal documents go to the least id. Extra columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from crmweave.llm.components import stars
from crmweave.llm.frames import arrow_rows, free_name, stored
from crmweave.llm.text import LOWER, NOT_SPACE, Piece, annotated, lists_of, mixed, pieces, runs_of, struct_of

REGISTERS, BAND_ROWS = 128, 4
BANDS = REGISTERS // BAND_ROWS
MANTISSA = 10
HASH_BITS = 57  # those below the seven that choose the bucket
BORROW_TRIES = 24
SLACK = 0.16  # four and a half standard errors of an estimate of 0.8 from 128 registers
ESTIMATED = 128  # shingles of both sets from which on an estimate may drop a pair
BLOCK, BLOCKS_A_BATCH = 32, 64

PROFILE = StructType(
    [StructField("n", LongType()), StructField("s1", LongType()), StructField("s2", LongType()), StructField("bands", ArrayType(LongType()))]
)
_DONORS = np.random.Generator(np.random.PCG64(97)).integers(0, REGISTERS, (BORROW_TRIES, REGISTERS))


def shingle_sets(piece: Piece, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their bounds."""
    words = piece.words(NOT_SPACE, LOWER)
    hashes, bounds = runs_of(words.hashes(), words.of, width)
    owner = np.repeat(np.arange(len(piece)), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(piece) + 1))


def borrowed(own: np.ndarray) -> np.ndarray:
    """Registers (sets x registers) with the empty ones, -1, filled from others of the set; those of an empty set stay."""
    full, filled, width = own >= 0, own.copy(), own.shape[1]
    for donors in _DONORS:
        open_ = np.flatnonzero((filled < 0).any(axis=1))
        if not len(open_):
            return filled
        donor = donors[:width] % width
        filled[open_] = np.where((filled[open_] < 0) & full[open_][:, donor], own[open_][:, donor], filled[open_])
    for i in np.flatnonzero((filled < 0).any(axis=1) & full.any(axis=1)):  # few values: the next register around that has one
        at = np.flatnonzero(full[i])
        nearest = at[np.searchsorted(at, np.arange(width)) % len(at)]
        filled[i] = np.where(filled[i] < 0, own[i, nearest], filled[i])
    return filled


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers (uint16) of each set, sets x REGISTERS; those of an empty set are 0 and not to be used."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bucket = (hashes >> np.uint64(HASH_BITS)).astype(np.int64)
    cell = owner * REGISTERS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # hashes ascend, so the first of a bucket is its least
    low = (hashes[first] & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64)
    bits = np.frexp(np.maximum(low, 1).astype(np.float64))[1]  # digits up to the leading one
    rest = np.where(bits > MANTISSA, low >> np.maximum(bits - 1 - MANTISSA, 0), low << np.maximum(MANTISSA + 1 - bits, 0))
    code = ((HASH_BITS - np.minimum(bits, HASH_BITS)).astype(np.int64) << MANTISSA) | (rest & ((1 << MANTISSA) - 1))
    out = np.full((len(bounds) - 1) * REGISTERS, -1, np.int64)
    out[cell[first]] = code
    return np.maximum(borrowed(out.reshape(-1, REGISTERS)), 0).astype(np.uint16)


def profiled(piece: Piece, width: int) -> pa.Array:
    hashes, bounds = shingle_sets(piece, width)
    n = np.diff(bounds)
    some = np.flatnonzero(n)
    s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    if len(some):
        s1[some] = np.add.reduceat(mixed(hashes), bounds[:-1][some])
        s2[some] = np.bitwise_xor.reduceat(mixed(hashes + np.uint64(1)), bounds[:-1][some])
    packed = np.ascontiguousarray(registers(hashes, bounds)[some]).view(np.int64)
    at = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])
    return struct_of(PROFILE, n=n.astype(np.int64), s1=s1.view(np.int64), s2=s2.view(np.int64), bands=lists_of(packed.ravel(), at))


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from registers (uint16, rows x REGISTERS), less the matches that different minima give by chance."""
    same = (a == b).mean(axis=-1)
    level = 2.0 ** -np.arange(HASH_BITS)
    at = lambda n: np.exp(-n[..., None] / REGISTERS * level / 2) - np.exp(-n[..., None] / REGISTERS * level)
    chance = (at(n_a) * at(n_b)).sum(axis=-1) / (1 << MANTISSA)
    return (same - chance) / (1 - chance)


def maybe_linked(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Pairs (registers and sizes) that the estimate does not rule out; it is not asked where a set is small."""
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    return (np.minimum(n_a, n_b) < ESTIMATED) | (estimates(a, b, n_a, n_b) >= least - SLACK)


def as_registers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat).view(np.uint16).reshape(len(column), -1)


def promising(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose estimate may still be a link."""
    side = lambda x: sketches.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bands").alias(f"bands_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "bands_a", "bands_b")

    def over(batches):
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            likely = maybe_linked(as_registers(batch.column(4)), as_registers(batch.column(5)), n_a, n_b, least)
            likely &= np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b)
            yield batch.select([0, 1]).filter(pa.array(likely))

    return both.mapInArrow(over, "a long, b long")


def zipped(docs: DataFrame) -> DataFrame:
    """(id, text) with the texts compressed: they are moved more often than they are read."""

    def over(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(press.compress, texts), pa.binary())], names=["id", "text"])

    return docs.mapInArrow(over, "id long, text binary")


def unzipped(texts: pa.Array) -> pa.Array:
    return pa.array(map(zstandard.ZstdDecompressor().decompress, texts.to_pylist()), pa.binary())


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets. ``texts``: id (once each), zipped text."""
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a"
    )

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for piece in pieces(unzipped(column)):
            hashes, bounds = shingle_sets(piece, width)
            out.extend(hashes[x:y] for x, y in zip(bounds, bounds[1:], strict=False))
        return out

    def over(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yes = []
                for x, y in zip(sets(part.column(2)), sets(part.column(3)), strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    yes.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
                yield part.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(over, "a long, b long")


def across(groups: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one band group that lie in different components.

    ``groups``: band, key, id, component, outer (not in the component of the group's first), n, bands, size, zipped text.
    Members are packed into blocks of about BLOCK; every block meets every block of outer members. Registers are
    compared first; where they leave pairs, the shingles of both blocks are joined at once. No rows of pairs are made. A
    pair that shares an earlier band is left to that band.
    """
    least = percent / 100
    packed = F.struct("id", "component", "n", "bands", "text")
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK))
    gathered = lambda df, name: df.groupBy("band", "key", block.alias(f"part_{name}")).agg(F.collect_list(packed).alias(name))
    met = gathered(groups, "x").join(gathered(groups.filter("outer"), "y"), ["band", "key"]).select("band", "x", "y")

    def opened(cell: pa.Array) -> tuple[np.ndarray, ...]:
        return (*(cell.field(k).to_numpy(zero_copy_only=False) for k in ("id", "component", "n")), as_registers(cell.field("bands")))

    def sets(texts: pa.Array, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of some of the texts, and which of them each is of."""
        hashes, owner, at = [], [], 0
        for piece in pieces(unzipped(texts.take(pa.array(some)))):
            own, bounds = shingle_sets(piece, width)
            hashes.append(own)
            owner.append(np.repeat(np.arange(len(piece)) + at, np.diff(bounds)))
            at += len(piece)
        return np.concatenate(hashes), np.concatenate(owner)

    def over(batches):
        for batch in batches:
            found: list[np.ndarray] = []
            for i in range(len(batch)):
                band, x, y = batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(2)[i].values
                (xs, xc, xn, xr), (ys, yc, yn, yr) = opened(x), opened(y)
                maybe = (xc[:, None] != yc[None, :]) & (np.minimum(xn[:, None], yn) >= least * np.maximum(xn[:, None], yn))
                if band:
                    earlier = xr[:, None, : band * BAND_ROWS] == yr[None, :, : band * BAND_ROWS]
                    maybe &= ~earlier.reshape(len(xs), len(ys), band, BAND_ROWS).all(axis=3).any(axis=2)
                a, b = np.nonzero(maybe)
                likely = maybe_linked(xr[a], yr[b], xn[a], yn[b], least)
                a, b = a[likely], b[likely]
                if not len(a):
                    continue
                (left, a), (right, b) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
                common = shared(*sets(x.field("text"), left), *sets(y.field("text"), right), len(left), len(right))[a, b]
                linked = (common > 0) & (100 * common >= percent * (xn[left[a]] + yn[right[b]] - common))
                a, b = left[a[linked]], right[b[linked]]
                # One link between two components joins them; more would change nothing.
                _, one = np.unique(np.stack([xc[a], yc[b]], axis=1), axis=0, return_index=True)
                found.append(np.sort(np.stack([xs[a[one]], ys[b[one]]], axis=1), axis=1))
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})

    return met.mapInArrow(over, "a long, b long").distinct()


def shared(xh: np.ndarray, xo: np.ndarray, yh: np.ndarray, yo: np.ndarray, nx: int, ny: int) -> np.ndarray:
    """Sizes of the intersections of nx sets with ny sets, given as values and the set that each is of."""
    order = np.argsort(xh, kind="stable")
    xh, xo = xh[order], xo[order]
    low, high = np.searchsorted(xh, yh, "left"), np.searchsorted(xh, yh, "right")
    many = high - low
    at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return np.bincount(xo[at] * ny + np.repeat(yo, many), minlength=nx * ny).reshape(nx, ny)


def _placed(df: DataFrame, joined: DataFrame, id_: str, name: str) -> DataFrame:
    """The frame with the component of its ids; an id without links is its own."""
    own = joined.select(F.col("id").alias(id_), F.col("component").alias(name))
    return df.join(own, id_, "left").withColumn(name, F.coalesce(name, id_))


def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components; a link between others would join nothing."""
    return _placed(_placed(pairs, joined, "a", "ca"), joined, "b", "cb").filter("ca <> cb").select("a", "b")


def extended(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components with what further links (a, b; stored) join; each id stands beside its component's least, so paths are short."""
    return stars(joined.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(links))


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; the key is an integer."""
    least = percent / 100
    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    made, p = annotated(given, "text", "profile", PROFILE, lambda piece: profiled(piece, width))
    profile = stored(made.select("id", f"{p}.*"), "profiles")
    usable = profile.filter("id is not null and n > 0")
    classes = stored(usable.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")), "classes")
    sketches = stored(
        usable.join(classes.select(F.col("rep").alias("id"), "s1", "s2", "n"), ["id", "s1", "s2", "n"])
        .dropDuplicates(["id"]).select("id", "n", "bands"),
        "sketches",
    )
    bands = sketches.select(F.posexplode("bands").alias("band", "key"), "id")
    groups = stored(
        bands.groupBy("band", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "groups"
    )
    members = stored(bands.join(groups, ["band", "key"]), "members")
    # Texts of the documents in question; the ids grow with the documents, so they are not to be broadcast.
    wanted = members.select("id").distinct()
    texts = stored(zipped(given).join(wanted.hint("merge"), "id").groupBy("id").agg(F.first("text").alias("text")), "texts")
    pairs = members.filter("id <> first").groupBy(F.col("id").alias("b"), F.col("first").alias("a")).count()
    # Each with the least of its firsts; the others only where that leaves two components.
    least_first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    joined = stars(stored(confirmed(promising(least_first, sketches, least), texts, width, percent), "confirmed"))
    rest_of_stars = apart(pairs.select("a", "b").join(least_first, ["a", "b"], "left_anti"), joined)
    if not (rest_of_stars := stored(promising(rest_of_stars, sketches, least), "stars")).isEmpty():
        joined = extended(joined, stored(confirmed(rest_of_stars, texts, width, percent), "confirmed"))
    # Groups with more than one component left: the rest of their pairs.
    placed = _placed(members, joined, "id", "component")
    firsts = _placed(groups, joined, "first", "main").select("band", "key", "main")
    open_ = placed.join(firsts, ["band", "key"]).withColumn("outer", F.expr("component <> main"))
    outer = open_.filter("outer").select("band", "key").distinct()
    rest = open_.join(outer, ["band", "key"]).join(sketches, "id").join(texts.hint("merge"), "id").select(
        "band", "key", "id", "component", "outer", "n", "bands", "size", "text"
    )
    with arrow_rows(docs.sparkSession, BLOCKS_A_BATCH):
        more = stored(across(rest, width, percent), "across")
    if not more.isEmpty():
        joined = extended(joined, more)
    found = (
        profile.join(classes.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"], "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id")))
    )
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies, without more columns: the one of the least key.

    Every row is judged on its own text, also where rows share a key; rows of a null key stay.
    """
    row = free_name(docs, "row")
    # Only rows of repeated keys need a number of their own, and are stored for that; it lies below all keys.
    least = docs.agg(F.min(key).cast("long")).first()[0] or 0
    repeated = stored(docs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "repeated")
    same = repeated.select(F.col(key).alias(free_name(docs, "same")))
    match = F.col(key) == F.col(same.columns[0])
    once = docs.join(same, match, "left_anti")
    odd = stored(docs.join(same, match, "left_semi").withColumn(row, F.lit(least - 1) - F.monotonically_increasing_id()), "odd")
    named = lambda df, id_: df.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = once.filter(F.col(key).isNotNull())
    groups = stored(linked(named(known, key).unionByName(named(odd, row)), width=width, percent=percent).select("doc_id", "component_id"), "groups")
    members = groups.join(odd.select(F.col(row).alias("doc_id"), F.col(key).alias("key")), "doc_id", "left").withColumn("key", F.coalesce("key", "doc_id"))
    several = members.groupBy("component_id").agg(
        F.min(F.struct("key", "doc_id"))["doc_id"].alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    dropped = stored(members.join(several, "component_id").filter("doc_id <> first").select(F.col("doc_id").alias(free_name(docs, "dropped"))), "dropped")
    gone = F.col(dropped.columns[0])
    # The dropped ids grow with the documents, so they are not to be broadcast.
    left = once.join(dropped.hint("merge"), F.col(key) == gone, "left_anti")
    return left.unionByName(odd.join(dropped.hint("merge"), F.col(row) == gone, "left_anti").drop(row))
