"""Words of whole Arrow text columns as numpy arrays: the part of the per-task work that several operators share.

A text is handled as its UTF-8 bytes. Every separator class used here consists of ASCII characters, so byte runs are
the code point runs. Batches are cut into pieces of about PIECE_BYTES, so memory does not follow the batch; a single
longer text is a piece of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

from crmweave.llm.frames import free_name

PIECE_BYTES = 1 << 20


def table_of(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


# [^\x20\x09-\x0D] and [^\x00-\x2F\x3A-\x60\x7B-\x7F], as bytes.
NOT_SPACE = table_of(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = table_of(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
SAME = np.arange(256, dtype=np.uint8)

ODD = np.uint64(0x9E3779B97F4A7C15)
SEED = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ODD and of its inverse modulo 2**64, at least n + 1 of them; the worker keeps the most it has needed."""
    if not _POWERS or len(_POWERS[0][0]) <= n:
        size = 1 << max(16, (n + 1).bit_length())
        up, down = np.full(size, ODD), np.full(size, np.uint64(pow(int(ODD), -1, 1 << 64)))
        up[0] = down[0] = np.uint64(1)
        _POWERS[:] = [(np.multiply.accumulate(up), np.multiply.accumulate(down))]
    return _POWERS[0]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial over bytes; a span's value is (sums[end] - sums[start]) * inverse power of its start."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return sums


def short_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of a few dozen bytes. Longer ones can be made to agree modulo 2**64: see ``span_hashes``."""
    _, down = powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


PRIME = (1 << 61) - 1
BASE = int(SEED.integers(1 << 60, PRIME))
BLOCK = 1 << 16  # bytes whose sums are made at once; the sums of twice as many stay below 2**64
_FIELD_POWERS: list[np.ndarray] = []


def reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit number modulo PRIME."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.minimum(x, x - np.uint64(PRIME))  # a number below PRIME wraps to a large one


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, from limbs of 31 bits; 2**61 counts as 1."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a_low, a_high, b_low, b_high = a & low, a >> half, b & low, b >> half
    middle = a_low * b_high + a_high * b_low
    carried = (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half)
    return reduced(np.uint64(2) * a_high * b_high + carried + a_low * b_low)


def field_powers() -> list[np.ndarray]:
    """Lower 32 and upper bits of the powers of BASE modulo PRIME, and the powers of its inverse, for two blocks."""
    if not _FIELD_POWERS:
        made = []
        for base in (BASE, pow(BASE, -1, PRIME)):
            row = np.ones(1, np.uint64)
            while len(row) < 2 * BLOCK:
                row = np.concatenate([row, times(row, np.uint64(pow(base, len(row), PRIME)))])
            made.append(row)
        _FIELD_POWERS[:] = [made[0] & np.uint64(0xFFFFFFFF), made[0] >> np.uint64(32), made[1]]
    return _FIELD_POWERS


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes, in ascending order of their starts: a polynomial modulo 2**61 - 1 at a drawn base, mixed.

    Texts that agree for another modulus, such as long words over two letters modulo 2**64, do not agree here but by
    chance. Sums run over both limbs of the powers apart, from the start of a block, so only the ends of spans are
    reduced, and memory follows the block. A span as long as a block is hashed by itself.
    """
    low, high, down = field_powers()
    size = end - start
    found = np.zeros(len(start), np.uint64)
    for i in np.flatnonzero(size >= BLOCK):
        found[i] = np.frombuffer(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), np.uint64)[0]
    short = np.flatnonzero(size < BLOCK)
    first, last = start[short], end[short]
    i = 0
    while i < len(short):
        base = first[i]
        j = int(np.searchsorted(first, base + BLOCK))
        a, b = first[i:j] - base, last[i:j] - base
        value = data[base : base + b.max()].astype(np.uint64) + np.uint64(1)
        sums_low, sums_high = np.zeros(len(value) + 1, np.uint64), np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value * low[: len(value)], out=sums_low[1:])
        np.cumsum(value * high[: len(value)], out=sums_high[1:])
        upper = times(reduced(sums_high[b] - sums_high[a]), np.uint64(1 << 32))
        whole = reduced(reduced(sums_low[b] - sums_low[a]) + upper)
        found[short[i:j]] = mixed(times(whole, down[a]) + ((b - a).astype(np.uint64) << np.uint64(40)))
        i = j
    return found


class Piece:
    """Some whole texts of a column: their bytes, and where each begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, keep: np.ndarray, fold: np.ndarray = SAME) -> Words:
        return Words(self, keep, fold)


class Words:
    """Words of a piece: ``start`` and ``end`` in its folded bytes; those of text i are ``of[i]:of[i + 1]``."""

    def __init__(self, piece: Piece, keep: np.ndarray, fold: np.ndarray):
        self.data = piece.data if fold is SAME else fold[piece.data]
        n = len(self.data)
        inside = keep[self.data]
        first = np.zeros(n + 1, bool)
        first[piece.offsets] = True  # a word ends with its text
        before = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
        opens = inside & (~before | first[:n])
        after = np.empty(n, bool)
        if n:
            after[-1], after[:-1] = False, inside[1:]
        closes = inside & (~after | first[1:])
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.of = np.searchsorted(self.start, piece.offsets)
        self.counts = np.diff(self.of)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def text_of(self) -> np.ndarray:
        """Index of each word's text in the piece."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def runs_of(hashes: np.ndarray, of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in sequence, and the bounds of each text's; a text of fewer words has one, over all."""
    counts = np.diff(of)
    out_counts = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(out_counts)])
    begins = np.repeat(of[:-1] - bounds[:-1], out_counts) + np.arange(bounds[-1])
    sums = np.zeros(len(hashes) + 1, np.uint64)
    up, down = powers(len(hashes))
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    size = np.minimum(np.repeat(counts, out_counts), width)
    spread = (sums[begins + size] - sums[begins]) * down[begins]
    return mixed(spread + size.astype(np.uint64)), bounds


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[Piece]:
    """A text or binary column as pieces; nulls are empty texts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if large else pa.binary()), b"")
    if not len(column):
        return
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield Piece(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


def annotated(df: DataFrame, text: str, wanted: str, kind: StructType, work: Callable[[Piece], pa.Array]) -> tuple[DataFrame, str]:
    """The frame with one more struct column, whose name clashes with none there; ``work`` makes it from pieces."""
    name = free_name(df, wanted)
    schema = StructType([*df.schema.fields]).add(name, kind)

    def over(batches):
        for batch in batches:
            made = [work(piece) for piece in pieces(batch.column(batch.schema.get_field_index(text)))]
            if made:
                column = pa.concat_arrays(made)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return df.mapInArrow(over, schema), name


def struct_of(kind: DataType, **columns) -> pa.Array:
    """A struct array with the fields of a Spark struct type, from arrays or numpy arrays."""
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    return pa.StructArray.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in arrow)], fields=list(arrow)
    )


def lists_of(values: np.ndarray | pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))
