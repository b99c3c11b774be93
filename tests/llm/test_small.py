"""Numpy parts against the plain way, without Spark."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import alnum, hits, two_letter_words, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crmweave.llm import coder, queries, repeats, text, tokens
from crmweave.llm.automaton import SuffixAutomaton
from crmweave.llm.decontaminate import Items, packed, word_hashes_of
from crmweave.llm.mixing import cheapest_flow, targets
from crmweave.llm.neardup import estimates, registers
from crmweave.llm.text import ALNUM, LOWER, NOT_SPACE, pieces, runs_of
from crmweave.llm.tokens import times_power

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té0- ", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_do_not_cross_texts(texts, most):
    for keep, fold, plain in ((NOT_SPACE, None, words), (ALNUM, LOWER, alnum)):
        got = []
        for piece in pieces(pa.array(texts, pa.string()), most):
            found = piece.words(keep) if fold is None else piece.words(keep, fold)
            spans = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
            got += [spans[a:b] for a, b in zip(found.of, found.of[1:])]
        assert got == [plain(t) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    a, b = (next(pieces(pa.array([t]))).words(NOT_SPACE).hashes() for t in ("x yy zzz yy", "q yy"))
    assert a[1] == a[3] == b[1] and len(set(a)) == 3


def test_runs_of_words():
    hashes, of = np.arange(1, 8, dtype=np.uint64), np.array([0, 0, 5, 7])
    found, bounds = runs_of(hashes, of, 3)
    assert bounds.tolist() == [0, 0, 3, 4]
    assert len(set(found.tolist())) == 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=4), st.lists(st.integers(-1, 3), max_size=25))
def test_matching_statistics(sequences, stream):
    inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    want = [max((n for n in range(1, k + 2) if tuple(stream[k + 1 - n : k + 1]) in inside), default=0) for k in range(len(stream))]
    assert [n for _, n in SuffixAutomaton(sequences).stream(stream)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=14), max_size=4), st.text(alphabet="abc ", max_size=40), st.integers(2, 5))
def test_hits_of_windows(items, text, window):
    named = list(enumerate(items))
    block = Items([(str(i), word_hashes_of(t)) for i, t in named], window)
    ids = block.vocabulary.ids(word_hashes_of(text)).tolist()
    spans, names = block.matches(ids)
    got = packed(np.array([len(ids)]), {0: spans} if spans else {}, {0: names} if names else {}).to_pylist()[0]
    assert (got["n_words"], got["n_hit"], got["n_items"], got["items_sha256"], got["n_hit"] > 0) == hits(text, named, window)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("ab\0"), st.sampled_from("ab\0")), max_size=12), min_size=1, max_size=5))
def test_merge_of_runs(parts):
    runs = []
    for part in parts:
        strings = sorted((x + "a" * 20 + y).encode().ljust(repeats.WIDTH, b"\0") for x, y in part)
        matrix = np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), repeats.WIDTH)
        runs.append((strings, repeats.shared_prefix(matrix).tolist() if strings else []))
    flat = [s for strings, _ in runs for s in strings]
    order, common = repeats.merged(runs)
    assert [flat[i] for i in order] == sorted(flat) and sorted(order) == list(range(len(flat)))
    for k in range(1, len(order)):
        a, b = flat[order[k - 1]], flat[order[k]]
        assert common[k] == next((i for i in range(len(a)) if a[i] != b[i]), len(a))


@pytest.mark.parametrize("blocks, length", [(1, 1), (3, 65), (2, 700), (4, 4096)])
@pytest.mark.parametrize("kind", ["one", "any", "skewed", "again"])
def test_coder_round_trip(blocks, length, kind):
    draw = np.random.default_rng(blocks * length)
    ids = {
        "one": np.zeros((blocks, length)), "any": draw.integers(0, coder.NONE, (blocks, length)),
        "skewed": np.minimum(draw.zipf(1.2, (blocks, length)), 50256), "again": np.tile(np.arange(length) % 7, (blocks, 1)),
    }[kind].astype(np.int64)
    payloads = coder.encode(ids)
    assert (coder.decode(payloads, length) == ids).all()
    if length == 4096 and kind in ("one", "again"):
        assert max(map(len, payloads)) < length / 4
    assert coder.encode(ids[:1])[0] == payloads[0]  # blocks do not depend on each other


def test_coder_tables_of_a_block_are_small_and_hold_its_ids():
    # Decoding reads them at random at every step, for many blocks in turn.
    assert 4 * (1 << coder.ONE_BITS) + 4 * (1 << coder.TWO_BITS) + 2 * coder.SLOTS <= 1 << 14
    for seen in coder.RENEW:
        for distinct in (1, seen // 2, seen):
            count = np.ones(distinct, np.int32)
            count[0] += seen - distinct
            assert coder.slots_of(count, np.full(distinct, distinct, np.int32), seen).sum() < coder.SLOTS


def test_crc_of_joined_pieces():
    import zlib

    a, b = b"some ids", b"and the rest of them"
    assert times_power(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_estimates_follow_similarity():
    draw = np.random.default_rng(5)
    base = np.unique(draw.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    for share in (0.0, 0.5, 0.8, 1.0):
        other = np.unique(np.concatenate([base[: int(len(base) * share)], draw.integers(0, 1 << 63, int(1000 * (1 - share)), dtype=np.uint64)]))
        truth = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        both = registers(np.concatenate([base, other]), np.array([0, len(base), len(base) + len(other)]))
        n = np.array([float(len(base))])
        assert abs(estimates(both[:1], both[1:], n, np.array([float(len(other))]))[0] - truth) < 0.17


def test_targets_are_capped_and_reshared():
    got = targets({"a": 10, "b": 100, None: 50, "c": 0})
    assert all(got[s] <= 2 * n for s, n in {"a": 10, "b": 100, None: 50, "c": 0}.items())
    assert float(sum(got.values())) == pytest.approx(240)
    assert got["a"] == 20 and got["c"] == 0 and list(targets({})) == []


def test_flow_is_largest_and_repeats_least():
    flow = cheapest_flow({("a",): 10, ("a", "b"): 10, ("b",): 0}, {"a": 18, "b": 2}, 2)
    assert {s: sum(f.get(s, 0) for f in flow.values()) for s in "ab"} == {"a": 18, "b": 2}
    assert sum(flow["a",].values()) <= 10 and sum(flow["a", "b"].values()) <= 10  # nothing is used twice
    assert sum(cheapest_flow({("a",): 10}, {"a": 100}, 2)["a",].values()) == 20


def test_repeats_in_random_bytes():
    random.seed(3)
    data = np.frombuffer("".join(random.choice("ab") for _ in range(400)).encode() * 2, np.uint8)
    at, _, lo, hi = repeats.anchors(data, np.array([0, 300, 800]))
    starts = sorted(s for a, b in zip(lo, hi) for s in range(a, b + 1))
    assert starts == [*range(251), *range(300, 751)]
    assert ((lo <= at) & (at <= hi + repeats.WIDTH)).all()
    assert (at - lo < repeats.STARTS).all() and (hi <= at).all()


def test_hashes_of_spans_follow_their_bytes():
    for steps in (10, 11, 12, 13, 17):  # the last is longer than a block
        words = [w.encode() for w in two_letter_words(steps)]
        data = np.frombuffer(b"xy" + words[0] + words[1] + words[0], np.uint8)
        n = 1 << steps
        at = np.array([2, 2 + n, 2 + 2 * n])
        first, second, again = text.span_hashes(data, at, at + n)
        assert first == again != second
    data = np.random.default_rng(1).integers(0, 4, 300_000).astype(np.uint8)
    start = np.sort(np.random.default_rng(2).integers(0, 290_000, 20_000))
    end = start + np.random.default_rng(3).integers(0, 9, 20_000)
    seen = {}
    for h, a, b in zip(text.span_hashes(data, start, end).tolist(), start, end, strict=True):
        assert seen.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen) > 5_000
    numbers = [1, 2, 5, text.PRIME - 1, text.PRIME - 7, 1 << 60]
    got = text.times(np.array(numbers, np.uint64)[:, None], np.array(numbers, np.uint64))
    assert got.tolist() == [[a * b % text.PRIME for b in numbers] for a in numbers]
    low, high, down = text.field_powers()
    for i in (0, 1, 77, 70_000):
        up = int(low[i]) + (int(high[i]) << 32)
        assert up == pow(text.BASE, i, text.PRIME) and up * int(down[i]) % text.PRIME == 1


def test_pieces_in_a_row_have_the_ids_of_whole_texts():
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", "　", " ", "\x1c", "a", "the", "don't", "é", "日本", "한", "12,3", "!?", "🙂", "<|endoftext|>", "-"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(1000)]
    model, went = tokens.Encoder(queries.vocabulary()), {"joined": 0, "apart": 0}

    def counted(name):
        made = getattr(tokens.Encoder, name)

        def call(data, start, end):
            went[name] += len(start)
            return made(model, data, start, end)

        return call

    model.joined, model.apart = counted("joined"), counted("apart")
    found = []
    for piece in text.pieces(pa.array(texts)):
        ids, counts = model.encode(piece)
        found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    whole = Tokenizer.from_file(queries.vocabulary()).encode_batch(texts, add_special_tokens=False)
    assert found == [[*e.ids, tokens.END] for e in whole]
    assert min(went.values()) > 100
    model.width[:] = 2  # as if ids did not stand for bytes: all go by themselves
    model.clear()
    ids, _ = model.encode(next(text.pieces(pa.array(texts))))
    assert ids.tolist() == [x for e in found for x in e]


@pytest.mark.parametrize("sizes", [[], [3], [5, 5], [1, 1, 1, 9, 4], [20]])
def test_rebatched(sizes):
    rows = iter(range(sum(sizes)))
    batches = [pa.record_batch({"x": [next(rows) for _ in range(n)]}) for n in sizes]
    out = [b.column(0).to_pylist() for b in tokens.rebatched(iter(batches), 4)]
    assert sum(out, []) == list(range(sum(sizes)))
    assert all(len(b) == 4 for b in out[:-1]) and all(out)
