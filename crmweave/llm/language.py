"""Language identification of mixed text: scripts narrow the candidates, then Viterbi over per-word scores.

Learning counts the byte trigrams of words (with their edges) by language, on the executors, over a sample of labelled
texts of about SAMPLE_ROWS rows a language, a bound on learning alone. What reaches the driver are BUCKETS counts a
language, whatever the corpus.

A word's score for a language is the log-likelihood of its trigrams. Languages that hardly ever use the script of a word
are no candidates for it; a word in a script that no language uses counts for none. The best path through a text, with
SWITCH paid for each change of language, labels its spans. Where every other language gains less than half of SWITCH on
any stretch against the best single one, the path stays on that one, and no step through the words is needed: k spans gain
less than k / 2 times SWITCH and pay k - 1 times.

The prediction is the language with the most words; ``und`` where the text is null or has no letter (or nothing was
learned). The score is the share of the words in that language times the certainty 1 - exp(-m), m being its mean lead
over the second language in nats per word. Ties go to the language that comes first by code point. Repeated rows are
rows of their own; extra columns pass through, the added column getting a free name; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from crmweave.llm.text import Piece, annotated, lists_of, pieces, struct_of, table_of

SAMPLE_ROWS = 3000
MAX_LANGUAGES = 500
BUCKETS = 1 << 16
SWITCH = 12.0
SHARE_OF_SCRIPT = 0.005  # of a language's words, for the script to count as one of its own
FAR_BELOW = -40.0
UNKNOWN = "und"

LETTER = table_of(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80)
LOWER_OR_SPACE = np.array(
    [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 0x20 for b in range(256)], dtype=np.uint8
)
# Script ranges by the lead byte of a code point, in the order of their first code points; ASCII letters are Latin.
SCRIPT_RANGES = (
    ("latin", 0xC3, 0xCA), ("greek", 0xCD, 0xCF), ("cyrillic", 0xD0, 0xD3), ("armenian, hebrew", 0xD4, 0xD7),
    ("arabic", 0xD8, 0xDD), ("indic, thai", 0xE0, 0xE0), ("georgian, ethiopic, khmer", 0xE1, 0xE1), ("kana", 0xE3, 0xE3),
    ("han", 0xE4, 0xE9), ("hangul", 0xEA, 0xED), ("beyond", 0xF0, 0xF4),
)
SCRIPT_OF = np.array([next((i for i, (_, a, b) in enumerate(SCRIPT_RANGES) if a <= x <= b), 0) for x in range(256)], np.uint8)

FOUND = StructType(
    [
        StructField("lang", StringType()), StructField("score", DoubleType()), StructField("from_", ArrayType(LongType())),
        StructField("to_", ArrayType(LongType())), StructField("langs", ArrayType(StringType())),
    ]
)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


class Trigrams:
    """Words of a piece with the bucket of the trigram around each of their bytes, and each word's script."""

    def __init__(self, piece: Piece):
        words = piece.words(LETTER)
        self.of, self.counts, self.start, self.end = words.of, words.counts, words.start, words.end
        folded = LOWER_OR_SPACE[piece.data]
        size = words.end - words.start
        self.first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(words.start - self.first[:-1], size) + np.arange(self.first[-1])
        middle = folded[at].astype(np.uint32)
        left, right = np.empty_like(middle), np.empty_like(middle)
        left[1:], right[:-1] = middle[:-1], middle[1:]
        left[self.first[:-1]] = right[self.first[1:] - 1] = 0x20
        code = ((left << np.uint32(16)) | (middle << np.uint32(8)) | right) * np.uint32(0x9E3779B1)
        self.bucket = (code >> np.uint32(16)).astype(np.int64)
        scripts = SCRIPT_OF[middle]
        self.script = np.maximum.reduceat(scripts, self.first[:-1]) if len(size) else np.zeros(0, np.uint8)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, log-probabilities less their mean over the languages
    uses: np.ndarray  # script x language

    def word_scores(self, t: Trigrams) -> np.ndarray:
        if not len(t.start):
            return np.zeros((0, len(self.languages)), np.float32)
        scores = np.stack([np.add.reduceat(self.weights[:, k][t.bucket], t.first[:-1]) for k in range(len(self.languages))], axis=1)
        uses = self.uses[t.script]
        if not self.uses.all():
            some = uses.any(axis=1)
            scores[~some] = 0
            scores[some] = np.where(uses[some], scores[some], FAR_BELOW)
        return scores


COUNTS = "lang string, kind int, bucket int, n long"


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> Model:
    """A model of all languages in ``lang``, from about ``rows`` texts of each, picked by a hash of the key."""
    usable = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, text, lang)
    sizes = {r[0]: r[1] for r in usable.groupBy(lang).count().orderBy(lang).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_RANGES), 0), bool))
    share = F.create_map(*(F.lit(x) for s in names for x in (s, min(1.0, rows / sizes[s]))))
    drawn = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = usable.filter(drawn < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    place = {s: i for i, s in enumerate(names)}

    def count(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for piece in pieces(batch.column(1)):
                t = Trigrams(piece)
                owner = langs[piece.first : piece.first + len(piece)]
                for s in set(owner):
                    mine = np.repeat(owner == s, t.counts)
                    some = t.bucket[np.repeat(mine, np.diff(t.first))]
                    grams[s] = grams.get(s, 0) + np.bincount(some, minlength=BUCKETS)
                    scripts[s] = scripts.get(s, 0) + np.bincount(t.script[mine], minlength=len(SCRIPT_RANGES))
        for kind, counted in ((0, grams), (1, scripts)):
            for s, n in counted.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [s] * len(at), "kind": pa.array([kind] * len(at), pa.int32()), "bucket": at.astype(np.int32), "n": n[at]}
                )

    got = sample.mapInArrow(count, COUNTS).groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    which = np.array([place[s] for s in got["lang"].to_pylist()], np.int64)
    kind, bucket, n = (got[c].to_numpy() for c in ("kind", "bucket", "n"))
    grams = np.zeros((BUCKETS, len(names)))
    scripts = np.zeros((len(SCRIPT_RANGES), len(names)))
    grams[bucket[kind == 0], which[kind == 0]] = n[kind == 0]
    scripts[bucket[kind == 1], which[kind == 1]] = n[kind == 1]
    logs = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * BUCKETS))
    uses = scripts >= SHARE_OF_SCRIPT * np.maximum(scripts.sum(axis=0), 1)
    return Model(names, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32), uses)


def single(scores: np.ndarray, of: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Texts whose best path is surely one language: nowhere does another gain SWITCH / 2 or more over the best single one.

    A path of k >= 2 spans gains less than k * SWITCH / 2 <= (k - 1) * SWITCH, so it loses, also where it avoids that language.
    """
    counts = np.diff(of)
    owner = np.repeat(np.arange(len(counts)), counts)
    ok = np.ones(len(counts), bool)
    if not len(owner):
        return ok
    chosen = scores[np.arange(len(scores)), best[owner]].astype(np.float64)
    for k in range(scores.shape[1]):
        gain = scores[:, k] - chosen
        run = np.cumsum(gain)
        # Falling steps between texts keep the running minimum within each text.
        down = owner * (2 * np.abs(gain).sum() + 1)
        low = np.minimum.accumulate(run - gain - down)
        most = np.maximum.reduceat(run - down - low, of[:-1][counts > 0])
        ok[counts > 0] &= most < SWITCH / 2
    return ok


def viterbi(scores: np.ndarray, of: np.ndarray, texts: np.ndarray) -> list[np.ndarray]:
    """Language of each word of the given texts, in step: the longest first, those that have ended drop out."""
    order = texts[np.argsort(-np.diff(of)[texts], kind="stable")]
    size = np.diff(of)[order]
    languages = scores.shape[1]
    back = [np.zeros((n, languages), np.int16) for n in size]
    total = np.zeros((len(order), languages))
    live = len(order)
    for step in range(int(size[0]) if len(size) else 0):
        while size[live - 1] <= step:
            live -= 1
        if step:
            top = total[:live].argmax(axis=1)
            moved = total[np.arange(live), top][:, None] - SWITCH
            stay = total[:live] >= moved
            total[:live] = np.where(stay, total[:live], moved)
            came = np.where(stay, np.arange(languages), top[:, None])
            for i in range(live):
                back[i][step] = came[i]
        total[:live] += scores[of[order[:live]] + step]
    paths: dict[int, np.ndarray] = {}
    for i, text in enumerate(order):
        path, at = np.zeros(size[i], np.int64), int(total[i].argmax())
        for step in range(size[i] - 1, -1, -1):
            path[step] = at
            at = int(back[i][step, at])
        paths[int(text)] = path
    return [paths[int(t)] for t in texts]


def has_letter(piece: Piece, i: int) -> bool:
    return any(c.isalpha() for c in piece.data[piece.offsets[i] : piece.offsets[i + 1]].tobytes().decode("utf-8", "replace"))


def labelled(piece: Piece, model: Model) -> pa.Array:
    n = len(piece)
    t = Trigrams(piece)
    scores = model.word_scores(t)
    lang, certain = [UNKNOWN] * n, np.zeros(n)
    spans: list[list] = [[] for _ in range(n)]
    some = np.flatnonzero(t.counts > 0)
    if model.languages and len(some):
        sums = np.zeros((n, len(model.languages)))
        sums[some] = np.add.reduceat(scores.astype(np.float64), t.of[:-1][some])
        best = sums.argmax(axis=1)
        alone = single(scores, t.of, best)
        ascii_letters = np.zeros(n, bool)
        low = (LOWER_OR_SPACE[piece.data] > 0x20) & (piece.data < 0x80)
        ascii_letters[np.flatnonzero(np.diff(piece.offsets))] = np.logical_or.reduceat(low, piece.offsets[:-1][np.diff(piece.offsets) > 0])
        mixed = some[~alone[some]]
        paths = dict(zip(mixed.tolist(), viterbi(scores, t.of, mixed), strict=True))
        for i in some.tolist():
            if not ascii_letters[i] and not has_letter(piece, i):
                continue
            path = paths.get(i)
            if path is None:
                k, share = int(best[i]), 1.0
                spans[i] = [(0, int(t.counts[i]), model.languages[k])]
            else:
                counted = np.bincount(path, minlength=len(model.languages))
                k = int(counted.argmax())
                share = counted[k] / len(path)
                cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
                spans[i] = [(a, b, model.languages[path[a]]) for a, b in zip(cuts, cuts[1:], strict=False)]
            own = sums[i, k] if path is None else float(scores[t.of[i] : t.of[i + 1], k][path == k].sum())
            rest = np.delete(sums[i], k) if path is None else np.delete(scores[t.of[i] : t.of[i + 1]][path == k].sum(axis=0), k)
            lead = (own - rest.max()) / max(1, t.counts[i] * share) if len(rest) else 9.0
            lang[i], certain[i] = model.languages[k], share * (1 - np.exp(-max(0.0, lead)))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
    flat = [x for s in spans for x in s]
    return struct_of(
        FOUND, lang=lang, score=certain, from_=lists_of(np.array([x[0] for x in flat], np.int64), bounds),
        to_=lists_of(np.array([x[1] for x in flat], np.int64), bounds), langs=lists_of(pa.array([x[2] for x in flat], pa.string()), bounds),
    )


def identify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """The frame with a struct column of language, score and spans (its name is returned too)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotated(docs, text, "language", FOUND, lambda piece: labelled(piece, shared.value))


def predictions(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Key, held_out, lang_pred, score and spans of every row, learned from the rows that are not held out."""
    model = learn(docs.filter(~held_out(F.col(key))), text, lang, key)
    found, c = identify(docs.select(key, text), model, text)
    return found.select(
        key, held_out(F.col(key)).alias("held_out"), F.col(c)["lang"].alias("lang_pred"), F.col(c)["score"].alias("score"),
        F.col(c)["from_"].alias("span_from"), F.col(c)["to_"].alias("span_to"), F.col(c)["langs"].alias("span_lang"),
    )


def in_known_language(docs: DataFrame, model: Model, least: float = 0.05, text: str = "text") -> DataFrame:
    """The rows, without more columns, whose language is found with at least the score ``least``."""
    found, c = identify(docs, model, text)
    return found.filter((F.col(c)["lang"] != UNKNOWN) & (F.col(c)["score"] >= least)).drop(c)
