"""Token ids of documents in one ordered binary file set, range coded in independent blocks.

Format: Parquet files with a row for each block: part, block (both from 0, in document order), length in ids, the ids'
crc32, payload (see ``coder``), and an index of the documents whose ids lie in it: row number in the part, key, ids in
this block, ids that follow in later blocks. All blocks of a part but its last have BLOCK ids. Any block can be read
alone; a checksum that does not fit is an error. Spark's committer writes the files, so a lost task leaves none.

Tokenizing: the pre-tokenizer never joins what stands on both sides of a place where white space begins after a visible
character, so texts are cut there and each distinct piece is encoded once by the tokenizer, many new ones in a row as
one text; a worker keeps the last CACHE_WORDS pieces' ids. Cuts are made only after ASCII and two-byte characters, of which no white space is in question.

Nulls: a null text is empty and has the end id alone; null keys come first. Equal keys are ordered by a hash of the text;
each row has an entry of its own. Extra columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.llm.coder import BLOCK, IDS, decode, encode
from crmweave.llm.text import NOT_SPACE, Piece, pieces, span_hashes
from crmweave.session import shared_folder

END = 0
LANES = 4096  # full blocks that a task codes in step
CACHE_WORDS, SLOT_BITS, TRIES = 1_500_000, 22, 8
BATCH, JOINED = 20_000, 1_000  # new pieces encoded at once, and in one text

FILE = (
    "part int, block int, length int, crc32 long, payload binary, "
    "rows array<long>, keys array<long>, counts array<int>, after array<long>"
)
_ENCODERS: dict[str, Encoder] = {}


def within(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether bytes lie from ``low`` to ``high``; smaller ones wrap to larger."""
    return data - np.uint8(low) <= np.uint8(high - low)


def extended(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` after its first ``used`` entries; it has room to grow, so what it holds is seldom moved."""
    if used + len(more) > len(held):
        wider = np.empty(max(2 * len(held), used + len(more)), held.dtype)
        wider[:used] = held[:used]
        held = wider
    held[used : used + len(more)] = more
    return held


class Encoder:
    """Ids of distinct pieces of text, found by hash in a table of fixed size; emptied when it holds CACHE_WORDS."""

    def __init__(self, path: str):
        # A task has one core; the library would start threads on all of them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Bytes that each id stands for, if the vocabulary writes a byte as a character.
        self.width = np.zeros(IDS, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.width[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.width[i] = len(token.content.encode())
        self.clear()

    def clear(self) -> None:
        self.slot_hash = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_entry = np.full(1 << SLOT_BITS, -1, np.int32)
        self.begin, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
        self.known, self.held = 0, 0

    def found(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        mask, out = np.uint64((1 << SLOT_BITS) - 1), np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        for step in range(TRIES):
            at = ((hashes[left] + np.uint64(step)) & mask).astype(np.int64)
            entry = self.slot_entry[at]
            hit = (self.slot_hash[at] == hashes[left]) & (entry >= 0)
            out[left[hit]] = entry[hit]
            left = left[~hit & (entry >= 0)]
            if not len(left):
                break
        return out

    def store(self, hashes: np.ndarray) -> None:
        """Enter new hashes under the next entries. One that finds no free slot in TRIES steps is encoded again later."""
        mask, left = np.uint64((1 << SLOT_BITS) - 1), np.arange(len(hashes))
        for step in range(TRIES):
            at = ((hashes[left] + np.uint64(step)) & mask).astype(np.int64)
            free = self.slot_entry[at] < 0
            where, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.slot_hash[where], self.slot_entry[where] = hashes[won], (self.known + won).astype(np.int32)
            done = np.zeros(len(hashes), bool)
            done[won] = True
            left = left[~done[left]]
            if not len(left):
                break

    def learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Enter new pieces. Those that may stand one after the other as they do in a text are encoded together."""
        last = data[end - 1]
        fit = ~NOT_SPACE[data[start]] & (within(last, 0x21, 0x7E) | ((last >= 0x80) & within(data[end - 2], 0xC3, 0xDF)))
        begin, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for which, together in ((np.flatnonzero(fit), True), (np.flatnonzero(~fit), False)):
            for i in range(0, len(which), BATCH):
                some = which[i : i + BATCH]
                flat, sizes = (self.joined if together else self.apart)(data, start[some], end[some])
                begin[some], size[some] = self.held + np.cumsum(sizes) - sizes, sizes
                self.pool = extended(self.pool, self.held, flat)
                self.held += len(flat)
        self.store(hashes)
        self.begin, self.size = extended(self.begin, self.known, begin), extended(self.size, self.known, size)
        self.known += len(start)

    def apart(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, each encoded by itself, and their numbers."""
        texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for e in ids for x in e), np.uint16, int(size.sum())), size

    def joined(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that begin with white space and end in a safe character, encoded as texts of many.

        The bytes that each id stands for tell where a piece's ids end. Where an end falls into an id, as it may with a
        vocabulary whose ids do not stand for bytes, the pieces are encoded apart.
        """
        upto = np.concatenate([[0], np.cumsum(end - start)])
        raw = data[np.repeat(start - upto[:-1], end - start) + np.arange(upto[-1])].tobytes()
        cuts = [*upto[:-1:JOINED].tolist(), len(raw)]
        texts = [raw[a:b].decode("utf-8") for a, b in zip(cuts, cuts[1:], strict=False)]
        ids = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids)
        reached = np.cumsum(self.width[flat])
        at = np.searchsorted(reached, upto[1:])
        if not len(flat) or reached[-1] != upto[-1] or (reached[at] != upto[1:]).any():
            return self.apart(data, start, end)
        return flat, np.diff(np.concatenate([[0], at + 1]))

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a piece, each with the end id, and their numbers."""
        data = piece.data
        if self.known > CACHE_WORDS:
            self.clear()
        solid = (data != 0x20) & ~within(data, 0x09, 0x0D)
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            safe = within(data[:-1], 0x21, 0x7E)
            safe[1:] |= (data[1:-1] >= 0x80) & within(data[:-2], 0xC3, 0xDF)
            cut[1:-1] = ~solid[1:] & solid[:-1] & safe
        cut[piece.offsets] = True
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(data)) if len(start) else start
        hashes = span_hashes(data, start, end)
        entry = self.found(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            distinct, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            known, at = self.known, new[first]
            self.learn(distinct, data, start[at], end[at])
            entry[new] = (known + back).astype(np.int32)
        size = self.size.take(entry)
        of = np.searchsorted(start, piece.offsets)
        total = np.concatenate([[0], np.cumsum(size)])
        counts = np.diff(total[of])
        n = int(total[-1])
        source = np.repeat(self.begin.take(entry) - total[:-1], size) + np.arange(n)
        out = np.full(n + len(counts), END, np.uint16)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(counts + 1) - 1] = False
        out[inside] = self.pool.take(source)
        return out, counts + 1


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Writer:
    """Cuts a part's ids into blocks and codes them, LANES at a time."""

    def __init__(self, part: int):
        self.part, self.block, self.row = part, 0, 0
        self.ids: list[np.ndarray] = []
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.held = 0

    def add(self, ids: np.ndarray, keys: list, counts: np.ndarray) -> None:
        self.ids.append(ids)
        self.keys.extend(keys)
        self.counts.extend(counts.tolist())
        self.held += len(ids)

    def full(self) -> bool:
        return self.held >= LANES * BLOCK

    def write(self, last: bool) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint16)
        blocks = len(ids) // BLOCK
        wide = ids[: blocks * BLOCK].reshape(blocks, BLOCK)
        payloads = [p for i in range(0, blocks, LANES) for p in encode(wide[i : i + LANES])]
        parts = list(wide)
        rest = ids[blocks * BLOCK :]
        if last and len(rest):
            parts.append(rest)
            payloads.extend(encode(rest[None, :]))
        out, doc = [], 0
        used = 0  # ids of the current document in blocks before
        for part, payload in zip(parts, payloads, strict=True):
            room, rows, keys, counts, after = len(part), [], [], [], []
            while room:
                take = min(room, self.counts[doc] - used)
                rows.append(self.row + doc)
                keys.append(self.keys[doc])
                counts.append(take)
                after.append(self.counts[doc] - used - take)
                used, room = used + take, room - take
                if used == self.counts[doc]:
                    doc, used = doc + 1, 0
            crc = zlib.crc32(part.astype("<u4").tobytes())
            out.append((self.part, self.block, len(part), crc, payload, rows, keys, counts, after))
            self.block += 1
        if used:  # the rest of a document comes with the next blocks
            self.counts[doc] -= used
        self.row += doc
        del self.keys[:doc], self.counts[:doc]
        done = sum(map(len, parts))
        self.ids, self.held = [ids[done:].copy()], len(ids) - done
        names = [c.split()[0] for c in FILE.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), *(pa.list_(x) for x in (pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
        for i in range(0, len(out), 512):
            columns = zip(*out[i : i + 512], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def write(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, in ascending order of the key, to a folder that all executors reach."""
    given = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("hash")
    )
    # The bounds of ranges come from a sample in the driver: of keys and hashes, not of texts.
    dealt = given.repartitionByRange("key", "hash").sortWithinPartitions("key", "hash", "text")

    def coded(batches):
        model, writer = encoder(vocabulary), Writer(TaskContext.get().partitionId())
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for piece in pieces(batch.column(1)):
                ids, counts = model.encode(piece)
                writer.add(ids, keys[piece.first : piece.first + len(piece)], counts)
                if writer.full():
                    yield from writer.write(False)
        yield from writer.write(True)

    dealt.mapInArrow(coded, FILE).write.parquet(path)


def times_power(crc: int, n: int) -> int:
    """A crc32 as if n zero bytes followed what it was made of (a polynomial times x**(8 n), reduced)."""
    power, factor = 1 << 31, 1 << 23  # x**0 and x**8, bits in the order of the crc
    while n:
        if n & 1:
            power = product(power, factor)
        factor = product(factor, factor)
        n >>= 1
    return product(crc, power)


def product(a: int, b: int) -> int:
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


PIECES = "part int, row long, key long, at long, n long, crc long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files alone.

    A document whose ids lie in several blocks has a piece in each; a piece's crc is shifted by what follows it, so that
    the crc of the whole is their exclusive or.
    """
    files = spark.read.schema(FILE).parquet(path)

    def decoded(batches):
        for batch in rebatched(batches, LANES):
            yield read_blocks(batch)

    found = files.mapInArrow(decoded, PIECES)
    # One row a part: as many as the writer had partitions.
    parts = files.groupBy("part").agg(F.sum("length").alias("ids"))
    w = "order by part rows between unbounded preceding and 1 preceding"
    parts = parts.select("part", F.expr(f"coalesce(sum(ids) over ({w}), 0)").alias("before"))
    whole = found.groupBy("part", "row").agg(
        F.first("key").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")
    )
    return whole.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def rebatched(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows``, the last with what is left."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            whole = n - n % rows
            yield from table.slice(0, whole).to_batches(max_chunksize=rows)
            held, n = table.slice(whole).to_batches(), n - whole
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)


def read_blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    part, block, length, crc = (columns[c].to_pylist() for c in ("part", "block", "length", "crc32"))
    payloads = columns["payload"].to_pylist()
    ids: dict[int, np.ndarray] = {}
    for size in set(length):
        some = [i for i, n in enumerate(length) if n == size]
        ids.update(zip(some, decode([payloads[i] for i in some], size), strict=True))
    out = []
    index = zip(*(columns[c].to_pylist() for c in ("rows", "keys", "counts", "after")), strict=True)
    for i, (rows, keys, counts, after) in enumerate(index):
        raw = ids[i].astype("<u4").tobytes()
        if zlib.crc32(raw) != crc[i]:
            raise ValueError(f"block {block[i]} of part {part[i]} does not match its checksum")
        at = 0
        for row, key, n, more in zip(rows, keys, counts, after, strict=True):
            own = zlib.crc32(raw[4 * at : 4 * (at + n)])
            out.append((part[i], row, key, block[i] * BLOCK + at, n, times_power(own, 4 * more) if more else own))
            at += n
    kinds = (pa.int32(), *([pa.int64()] * 5))
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents to the shared folder and read back what the files say."""
    path = f"{shared_folder(docs.sparkSession)}/llm-tokens-{uuid.uuid4().hex}"
    write(docs, path, vocabulary, key, text)
    return read(docs.sparkSession, path)
