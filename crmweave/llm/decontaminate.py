"""Benchmark decontamination by a generalised suffix automaton of normalised items.

Training texts stream through the automaton of all items; at each word it tells the longest match that ends there. A
word is hit if it lies in an occurrence of a window: WINDOW consecutive words of one item, or the whole of an item that
has fewer. Spans of hit words can be removed, or texts dropped, by limits on span length and on coverage.

Items are taken in blocks of at most BLOCK_WORDS words (or one item), each with an automaton of its own, which bounds
what a task holds; every block is run against every text, and the hits are united in the row itself.

Nulls: a null text or item has no words; a null item_id counts as an item and is left out of the ids' digest. Items without words match nothing.
Repeated items count each. Repeated texts are rows of their own. Extra columns pass through; the added column gets a
free name. Empty tables: without items nothing is hit; without texts there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from crmweave.llm.automaton import SuffixAutomaton, Vocabulary, known_runs
from crmweave.llm.text import ALNUM, LOWER, Piece, annotated, lists_of, pieces, struct_of

WINDOW = 10
BLOCK_WORDS = 500_000

HITS = StructType(
    [
        StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
        StructField("items_sha256", StringType()), StructField("from_", ArrayType(LongType())),
        StructField("to_", ArrayType(LongType())), StructField("items", ArrayType(StringType())),
    ]
)


def word_hashes_of(text: str | None) -> np.ndarray:
    return next(pieces(pa.array([text], pa.large_string()))).words(ALNUM, LOWER).hashes()


class Items:
    """A block of items: their automaton, and for each state the items whose windows end with its strings."""

    def __init__(self, rows: list[tuple[str | None, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.vocabulary = Vocabulary(np.concatenate([h for _, h in rows]) if rows else np.zeros(0, np.uint64))
        words = [self.vocabulary.ids(h).tolist() for _, h in rows]
        self.least = min((min(len(w), window) for w in words if w), default=1)
        made = self.automaton = SuffixAutomaton(words)
        inside: list[set] = [set() for _ in made.go]
        for (name, _), path in zip(rows, made.ends, strict=True):
            for state in path:
                inside[state].add(name)
        order = made.shorter_first().tolist()
        for state in reversed(order[1:]):  # items of longer strings also hold the shorter ones
            inside[made.link[state]] |= inside[state] if made.longest[state] >= window else set()
        # Of each state: what ends with its longest string of WINDOW words or, in short items, is the whole item.
        self.long: list[frozenset] = [frozenset()] * len(order)
        self.short: list[tuple] = [()] * len(order)
        whole: dict[int, list] = {}
        for (name, _), path in zip(rows, made.ends, strict=True):
            if 0 < len(path) < window:
                whole.setdefault(path[-1], []).append((len(path), name))
        for state in order[1:]:
            link = made.link[state]
            if made.longest[state] >= window:
                self.long[state] = self.long[link] if made.longest[link] >= window else frozenset(inside[state])
            self.short[state] = (*self.short[link], *whole.get(state, ()))

    def matches(self, ids: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Spans of the windows that occur (by their words' positions) and the items that have them."""
        spans, items, window = [], set(), self.window
        for i, (state, length) in enumerate(self.automaton.stream(ids), 1):
            if length >= window:
                if spans and spans[-1][1] >= i - window:
                    spans[-1] = (min(spans[-1][0], i - window), i)
                else:
                    spans.append((i - window, i))
                items |= self.long[state]
            for size, name in self.short[state]:
                if size <= length:
                    spans.append((i - size, i))
                    items.add(name)
        return spans, items


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(items: DataFrame, key: str, text: str, window: int, most: int) -> Iterator[Items]:
    """Items in blocks, streamed to the driver; only one block is there at a time, beside the automata made of them."""
    rows, words = [], 0
    for row in items.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).orderBy("k", "t").toLocalIterator():
        found = word_hashes_of(row["t"])
        if rows and words + len(found) > most:
            yield Items(rows, window)
            rows, words = [], 0
        rows.append((row["k"], found))
        words += len(found)
    yield Items(rows, window)


def hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, str]:
    """The frame with a struct column (its name is returned too): counts, ids and the spans of hit words."""
    name, before = "", []
    for block in blocks(benchmark, item_key, item_text, window, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(piece: Piece, shared=shared) -> pa.Array:
            return found_in(piece, shared.value)

        docs, name = annotated(docs, text, "hits", HITS, work)
        before.append(name)
    if len(before) == 1:
        return docs, name
    return merged(docs, before)


def found_in(piece: Piece, block: Items) -> pa.Array:
    words = piece.words(ALNUM, LOWER)
    ids = block.vocabulary.ids(words.hashes())
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    a, b = known_runs(ids, words.of, block.least)
    doc = np.searchsorted(words.of, a, "right") - 1
    for i, start, end in zip(doc.tolist(), a.tolist(), b.tolist(), strict=True):
        got, names = block.matches(ids[start:end].tolist())
        if got:
            shift = start - int(words.of[i])
            spans.setdefault(i, []).extend((x + shift, y + shift) for x, y in got)
            items.setdefault(i, set()).update(names)
    return packed(words.counts, spans, items)


def packed(n_words: np.ndarray, spans: dict[int, list], items: dict[int, set]) -> pa.Array:
    n = len(n_words)
    joined = {i: united(s) for i, s in spans.items()}
    names = {i: sorted(s, key=lambda x: (x is not None, x)) for i, s in items.items()}
    none = hashlib.sha256(b"").hexdigest()
    hit, n_items = np.zeros(n, np.int64), np.zeros(n, np.int64)
    digest, counts, name_counts = [none] * n, np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, s in joined.items():
        hit[i], counts[i] = sum(b - a for a, b in s), len(s)
        n_items[i], name_counts[i] = len(items[i]), len(names[i])
        digest[i] = hashlib.sha256(",".join(x for x in names[i] if x is not None).encode()).hexdigest()
    flat = np.array([x for i in sorted(joined) for x in joined[i]], np.int64).reshape(-1, 2)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    all_names = pa.array([x for i in sorted(names) for x in names[i]], pa.string())
    return struct_of(
        HITS, n_words=n_words.astype(np.int64), n_hit=hit, n_items=n_items, items_sha256=digest,
        from_=lists_of(flat[:, 0].copy(), bounds), to_=lists_of(flat[:, 1].copy(), bounds),
        items=lists_of(all_names, np.concatenate([[0], np.cumsum(name_counts)])),
    )


def merged(docs: DataFrame, names: list[str]) -> tuple[DataFrame, str]:
    """One struct of those that the blocks left, still row by row."""
    kept = [c for c in docs.columns if c not in names]
    schema = StructType([f for f in docs.schema.fields if f.name not in names]).add(names[0], HITS)

    def over(batches):
        for batch in batches:
            at = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
            spans = {i: [x for r in row for x in zip(r["from_"], r["to_"], strict=True)] for i, row in enumerate(zip(*at, strict=True))}
            items = {i: {x for r in row for x in r["items"]} for i, row in enumerate(zip(*at, strict=True))}
            made = packed(np.array([r["n_words"] for r in at[0]]), {i: s for i, s in spans.items() if s}, items)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*kept, names[0]])

    return docs.mapInArrow(over, schema), names[0]


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Key, n_words, n_hit, n_items, items_sha256, contaminated, and the spans, of every row."""
    found, h = hits(docs.select(key, options.get("text", "text")), benchmark, **options)
    return found.select(
        key, *(F.col(h)[c].alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256")),
        (F.col(h)["n_hit"] > 0).alias("contaminated"), F.col(h)["from_"].alias("span_from"), F.col(h)["to_"].alias("span_to"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, longest: int = 0, coverage: float = 0.0, **options) -> DataFrame:
    """The rows with no span of more than ``longest`` hit words and at most the share ``coverage`` of words hit."""
    found, h = hits(docs, benchmark, **options)
    worst = F.coalesce(F.array_max(F.zip_with(F.col(h)["to_"], F.col(h)["from_"], lambda b, a: b - a)), F.lit(0))
    clean = (worst <= longest) & (F.col(h)["n_hit"] <= coverage * F.col(h)["n_words"])
    return found.filter(clean).drop(h)


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows, their texts cut at the spans of hit words (each cut leaves one line break)."""
    found, h = hits(docs, benchmark, text=text, **options)
    schema = docs.schema

    def over(batches):
        for batch in batches:
            column, spans = batch.column(batch.schema.get_field_index(text)), batch.column(batch.schema.get_field_index(h)).to_pylist()
            texts = column.to_pylist()
            for piece in pieces(column):
                words = piece.words(ALNUM, LOWER)
                for i in range(len(piece)):
                    s = spans[piece.first + i]
                    if not s["from_"]:
                        continue
                    at, zero, parts = int(piece.offsets[i]), int(words.of[i]), []
                    for a, b in zip(s["from_"], s["to_"], strict=True):
                        parts.append(piece.data[at : words.start[zero + a]].tobytes())
                        at = int(words.end[zero + b - 1])
                    parts.append(piece.data[at : piece.offsets[i + 1]].tobytes())
                    texts[piece.first + i] = b"\n".join(parts).decode("utf-8")
            columns = [
                pa.array(texts, column.type) if c == text else batch.column(batch.schema.get_field_index(c)) for c in schema.names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(over, schema)
