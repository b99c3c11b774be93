"""Operators over odd rows, clashing columns and empty tables, and queries over the small tables against brute force."""

from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crmweave.llm import components as joining, decontaminate, language, licences, lines, mixing, neardup, queries, repeats, rules, shards, tokens
from crmweave.llm.components import components
from crmweave.llm.frames import stored
from crmweave.llm.text import PRIME, pieces as text_pieces, reduced

SMALL = "/root/testdata/sf0.001"


def texts(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


def together(odd, documents):
    """The small table's rows and the odd ones; ids of the latter are lowest."""
    return odd.withColumn("doc_id", F.col("doc_id") - 100).unionByName(documents)


@pytest.fixture(scope="module")
def both(odd, documents):
    return together(odd, documents).cache()


@pytest.fixture(scope="module")
def items(llm):
    return llm.read.parquet(f"{SMALL}/benchmark.parquet")


# 1 token files


def test_token_file(both):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(queries.vocabulary())
    got = sorted(tuple(r) for r in tokens.round_trip(both.filter("doc_id is null or doc_id <> 0"), queries.vocabulary()).collect() if r[0] is not None)
    rows = sorted((r for r in texts(both) if r[0] is not None and r[0] != 0), key=lambda r: r[0])
    at, want = None, []
    for i, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        at = got[0][1] if at is None else at
        want.append((i, at, len(ids), brute.zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        at += len(ids)
    assert got == want


def test_known_pieces_are_kept_without_being_moved_by_each_new_one():
    model = tokens.Encoder(queries.vocabulary())
    first, counts = model.encode(next(text_pieces(pa.array(["one two three " * 50 + "four", "", "five"]))))
    assert counts.sum() == len(first) and counts[1] == 1 and first[counts[0]] == tokens.END
    model.begin, model.size, model.pool = (np.resize(x, 1000) for x in (model.begin, model.size, model.pool))
    held = model.pool
    again, _ = model.encode(next(text_pieces(pa.array(["six five", None, "one"]))))
    assert model.pool is held
    alone = tokens.Encoder(queries.vocabulary()).encode(next(text_pieces(pa.array(["six five", None, "one"]))))[0]
    assert again.tolist() == alone.tolist()


def test_bytes_within_a_range_and_numbers_modulo_the_prime():
    data = np.arange(256, dtype=np.uint8)
    assert np.flatnonzero(tokens.within(data, 0xC3, 0xDF)).tolist() == list(range(0xC3, 0xE0))
    some = [0, 1, PRIME - 1, PRIME, PRIME + 1, 2 * PRIME, (1 << 64) - 1]
    assert reduced(np.array(some, np.uint64)).tolist() == [x % PRIME for x in some]


def test_token_file_of_nothing(none, clashing):
    assert tokens.round_trip(none, queries.vocabulary()).collect() == []
    assert tokens.round_trip(clashing, queries.vocabulary()).count() == clashing.count()


def test_a_damaged_block_is_an_error():
    import numpy as np
    import pyarrow as pa

    ids = np.arange(40)[None, :]
    names = ["part", "block", "length", "crc32", "payload", "rows", "keys", "counts", "after"]
    row = pa.RecordBatch.from_pydict(dict(zip(names, [[0], [0], [40], [1], tokens.encode(ids), [[0]], [[7]], [[40]], [[0]]])))
    with pytest.raises(ValueError, match="checksum"):
        tokens.read_blocks(row)


# 2 language


def test_language(both, documents):
    got = by_id(language.predictions(both), "held_out", "lang_pred", "score")
    rows = [r for r in documents.collect()]
    right = [got[r["doc_id"]][1] == r["lang"] for r in rows if got[r["doc_id"]][0]]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert {got[i - 100][1] for i in (1, 2, 3, 10)} == {"und"} and got[9 - 100][1] == "ru"
    assert all(0 <= s <= 1 and h == (brute.zlib.crc32(str(i).encode()) % 5 == 0) for i, (h, _, s) in got.items() if i is not None)


def test_language_spans_of_mixed_text(llm, documents):
    model = language.learn(documents)
    en, fr = (documents.filter(f"lang = '{x}' and length(text) > 2000").first()["text"][:900] for x in ("en", "fr"))
    mixed = llm.createDataFrame([(1, f"{en} {fr}")], "doc_id long, text string")
    found, c = language.identify(mixed, model)
    assert found.first()[c]["langs"] == ["en", "fr"]


def test_language_steps_and_short_cut_agree(documents):
    import numpy as np

    draw = np.random.default_rng(2)
    of = np.array([0, 0, 40, 45, 400])
    scores = draw.normal(0, 6, (400, 3)).astype(np.float32)
    best = np.array([0, *(int(scores[a:b].sum(axis=0).argmax()) for a, b in ((0, 40), (40, 45), (45, 400)))])
    for i in np.flatnonzero(language.single(scores, of, best)):
        if of[i + 1] > of[i]:
            assert (language.viterbi(scores, of, np.array([i]))[0] == best[i]).all()


def test_language_short_cut_leaves_paths_that_avoid_the_best_language():
    import numpy as np

    # 0 leads overall; 1 gains 10 over it in the first half and 2 in the second, so 1, 2 gain 20 for one switch.
    half = np.array([[0, 1, -3], [0, -3, 1]], np.float32)
    scores = np.repeat(half, 10, axis=0)
    of = np.array([0, 20])
    assert scores.sum(axis=0).argmax() == 0
    assert language.viterbi(scores, of, np.array([0]))[0].tolist() == [1] * 10 + [2] * 10
    assert not language.single(scores, of, np.array([0]))[0]


@pytest.mark.parametrize("wide", [0.5, 1, 2, 4])
def test_language_short_cut_is_exact_on_narrow_scores(wide):
    import numpy as np

    draw = np.random.default_rng(4)
    of = np.arange(0, 20_001, 20)
    level = draw.normal(0, wide, (1000, 4, 3)).repeat(5, axis=1).reshape(20_000, 3)
    scores = (level + draw.normal(0, wide / 4, (20_000, 3))).astype(np.float32)
    best = np.add.reduceat(scores.astype(np.float64), of[:-1]).argmax(axis=1)
    alone = np.flatnonzero(language.single(scores, of, best))
    for i, path in zip(alone, language.viterbi(scores, of, alone), strict=True):
        assert (path == best[i]).all()


def test_language_of_nothing(none, clashing, odd):
    assert language.predictions(none).collect() == []
    assert language.predictions(clashing).count() == clashing.count()
    kept = language.in_known_language(clashing, language.learn(odd))
    assert kept.columns == clashing.columns and 1 not in [r["doc_id"] for r in kept.collect()]


# 3 mixing


def test_mix(both):
    rows = mixing.mix(both).collect()
    size = {(r[0], len(brute.words(r[1]))) for r in texts(both)}
    assert {(r["doc_id"], r["size"]) for r in rows} == size and len(rows) == both.count()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(both.repartition(7)).collect()), key=repr)
    source = {r["doc_id"]: r["source"] for r in both.collect()}
    taken, whole, goal, most = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]] if r["doc_id"] is not None else "?"
        assert r["taken"] <= 2 * r["size"]
        if s == "?":
            continue
        taken[s], whole[s], goal[s], most[s] = taken[s] + r["taken"], r["source_size"], r["target"], max(most[s], r["size"])
    assert all(abs(taken[s] - goal[s]) <= most[s] + 70 for s in goal if s != "a")
    want = mixing.targets(whole)
    assert all(goal[s] == pytest.approx(float(want[s])) for s in goal)


def test_mixed_rows(both, none, clashing):
    times = defaultdict(int)
    for r in mixing.mixed_rows(both).collect():
        times[r["doc_id"], r["text"]] += 1
    asked = defaultdict(int)
    for r in mixing.mix(both).collect():
        asked[r["doc_id"]] += r["taken"] // r["size"] if r["size"] else 0
    got = defaultdict(int)
    for (i, _), n in times.items():
        got[i] += n
    assert dict(got) == {i: n for i, n in asked.items() if n}
    assert mixing.mixed_rows(clashing).columns == clashing.columns
    assert mixing.mix(none).collect() == [] and mixing.mixed_rows(none).collect() == []


def test_mix_of_overlapping_sources(llm):
    rows = [(i, "w " * 10, ["x"] if i % 2 else ["x", "y"]) for i in range(40)] + [(99, "w", [])]
    df = llm.createDataFrame(rows, "doc_id long, text string, of array<string>")
    got = mixing.mix(df, F.col("of"))
    # Sources have 601 words in all, of which 200 count twice; 150 % of them are more than all texts taken twice.
    assert got.agg(F.sum("taken")).first()[0] == 2 * 401


def test_too_many_patterns(llm, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    df = llm.createDataFrame([(i, "w", str(i)) for i in range(4)], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="patterns"):
        mixing.mix(df)


# 4 rules


def test_rules(both):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = by_id(rules.judged(both), *names, "kept", "failed_rule")
    for i, text in texts(both):
        if i is not None:
            assert got[i][:6] == brute.counts(text)
            assert got[i][6] == (got[i][7] is None)


def test_rules_order_changes_no_verdict(both):
    turned = rules.rules()[::-1]
    counted = rules.counted(both)
    verdict = counted.select("doc_id", *(F.coalesce(r.fails(F.col, F.coalesce("text", F.lit(""))), F.lit(True)).alias(r.name) for r in turned)).collect()
    kept = by_id(rules.judged(both, turned), "kept")
    assert all(kept[r[0]][0] == (not any(r[1:])) for r in verdict if r[0] is not None)


def test_rules_of_nothing(none, clashing):
    assert rules.judged(none).collect() == []
    assert rules.judged(clashing).count() == clashing.count()


def test_rules_keep_columns_of_their_names(odd):
    own = (*rules.COUNTS, "base_failed", "failed_rule", "kept", "__words", "__lines", "__windows", "__again")
    named = odd.select("*", *(F.lit(f"{c}!").alias(c) for c in own))
    got = rules.judged(named)
    assert got.columns == [*named.columns, *(f"{c}_" for c in (*rules.COUNTS, "base_failed", "failed_rule", "kept"))]
    assert all(r[c] == f"{c}!" for r in got.collect() for c in own)
    plain = rules.judged(odd).select("doc_id", "n_words", "n_repeat_words", "kept").collect()
    assert sorted(plain, key=repr) == sorted(got.select("doc_id", "n_words_", "n_repeat_words_", "kept_").collect(), key=repr)


def test_rules_behind_a_failed_one_are_not_evaluated(llm):
    trap = rules.Rule("trap", lambda c, body: F.raise_error(F.concat(F.lit("evaluated for "), body)).cast("boolean"))
    cascade = [*rules.rules()[:2], trap]
    few = llm.createDataFrame([(1, "too few"), (2, None), (3, "a b c d e " * 40)], "doc_id INT, text STRING")
    assert by_id(rules.cascade(few, cascade), "failed_rule") == {1: ("few_words",), 2: ("few_words",), 3: ("repeats",)}
    enough = llm.createDataFrame([(4, " ".join(f"w{i}" for i in range(20)))], "doc_id INT, text STRING")
    with pytest.raises(Exception, match="evaluated for w0"):
        rules.cascade(enough, cascade).collect()


def test_rules_read_the_text_inside_their_branches(documents):
    plan = rules.cascade(documents, rules.rules()).select("doc_id", "kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("P{Lu}+") == 1
    line = next(x for x in plan.splitlines() if "P{Lu}+" in x)
    assert line.index("CASE WHEN") < line.index("P{Lu}+") and "n_repeat_words" in line and "split(" not in line


def test_rules_come_by_rejections_per_cost(documents):
    slow = rules.Rule("slow", lambda c, body: F.aggregate(F.split(body, ""), F.lit(0), lambda a, x: a + F.length(x)) < 0)
    most = rules.Rule("most", lambda c, _: c("n_words") > 20)
    order = [r.name for r in rules.ordered(documents, [slow, *rules.rules(), most], share=1.0)]
    assert order[-1] == "slow" and order.index("most") < min(order.index("capitals"), order.index("shouts"))



# 5 lines


def test_fuzzy_lines(both):
    got = by_id(lines.deduplicated(both), "n_lines", "n_removed", "removed_lines")
    assert got == brute.fuzzy_lines(texts(both))


def test_fuzzy_lines_in_large_groups(llm):
    base = [f"part{i}" for i in range(60)]
    rows = [(k, " ".join([*base[: 10 + k % 50], f"own{k}", *base[10 + k % 50 :]])) for k in range(120)]
    rows += [(200 + k, " ".join(base[: 40 + k])) for k in range(20)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert by_id(lines.deduplicated(df), "n_lines", "n_removed", "removed_lines") == brute.fuzzy_lines(rows)


def test_fuzzy_lines_that_share_a_band_by_chance_are_no_candidates():
    draw = np.random.default_rng(5)

    def one_group(size, bits):
        ids, n = np.arange(1, len(size) + 1), len(size)
        blob = repeats.pack_sorted(np.full(n, 9, np.uint64), ids, size.astype(np.uint8), bits)
        return lines.grouped(pa.table({"bucket": pa.array([0], pa.int32()), "blob": pa.array([blob], pa.binary())}), 80).to_pydict()

    for n in (30, 300):  # below and above the groups that are paired step by step
        bits = draw.integers(0, 1 << 63, n, dtype=np.uint64)
        bits[n - 1] = bits[0] ^ np.uint64(5)
        found = one_group(np.full(n, 110), bits)
        # Bits drawn at random agree often enough for about one pair in 3,000.
        assert (1, n) in zip(found["a"], found["b"], strict=True) and len(found["kind"]) < n / 8 and 1 not in found["kind"]
        assert one_group(np.arange(n) % 2 * 6 + 110, np.full(n, 7, np.uint64))["kind"].count(0) < n * lines.MOST
        alike = one_group(np.full(n, 110), np.full(n, 7, np.uint64))
        assert alike["kind"].count(0) == sum(min(k, lines.MOST) for k in range(n))
        assert alike["kind"].count(1) == n and set(alike["a"][-n:]) == {9}


def test_a_bit_table_has_all_of_its_ids(llm):
    ids = np.random.default_rng(6).integers(-(1 << 63), 1 << 63, 3000)
    table = lines.bit_table(llm.createDataFrame([(int(i),) for i in ids[:1000]], "id long"), 1000)
    assert lines.in_table(table, ids[:1000]).all() and lines.in_table(table, ids[1000:]).mean() < 0.05


def test_fuzzy_lines_query_links_lines_that_differ_in_one_character(llm, tmp_path):
    filler = "this page was printed on the evening of day {} by the desk"
    assert 49 <= len(filler.format(1)) < 99
    rows = [(k, f"{filler.format(k)}\nown line number {k * 7919}") for k in range(1, 9)]
    llm.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(queries.QUERIES["op5_fuzzy_lines"](llm, str(tmp_path)), "n_lines", "n_removed", "removed_lines")
    assert got == brute.fuzzy_lines(rows, width=queries.LINE_SHINGLE)
    assert [k for k, (_, _, gone) in got.items() if 0 in gone] == [k for k in got if k != 1]


def test_fuzzy_lines_query_over_the_small_table(llm, documents):
    got = by_id(queries.QUERIES["op5_fuzzy_lines"](llm, SMALL), "n_lines", "n_removed", "removed_lines")
    assert got == brute.fuzzy_lines(texts(documents), width=queries.LINE_SHINGLE)


def test_fuzzy_lines_are_compared_as_sets_of_their_code_points():
    texts = ["short", "caf\u00e9 d\u00e9j\u00e0 vu " * 9, "caf\u00e9 d\u00e9j\u00e0 vu " * 12 + "end", "plain words without any end " * 3, "plain words without an end " * 3, "short"]
    texts += [t + " more" for t in texts] + ["\U0001f600 smile " * 6, "x" * 40, "x" * 90]
    sets = [{t[i : i + 5] for i in range(max(1, len(t) - 4))} for t in texts]
    want = np.array([[len(x & y) > 0 and 100 * len(x & y) >= 80 * len(x | y) for y in sets] for x in sets])
    hashes, bounds = lines.sets_of(pa.array([t.encode() for t in texts], pa.binary()), 5)
    a, b = np.indices(want.shape).reshape(2, -1)
    assert want.any(axis=1).all() and not want.all()
    assert (lines.common_of(hashes, bounds, a, b, 80).reshape(want.shape) == want).all()
    assert (lines.crossed(hashes, bounds, 6, 80) == want[:6, 6:]).all()
    # Bytes that are no UTF-8, beside a line that they do not touch.
    odd = pa.array([b"\xa9 stray byte in a line", b"left open \xc3", b"\xa9 stray byte in a line", texts[2].encode()], pa.binary())
    assert lines.common_of(*lines.sets_of(odd, 5), np.array([0, 0, 3]), np.array([2, 1, 3]), 80).tolist() == [True, False, True]
    wide = lines.sets_of(odd, 5)[0][-len(sets[2]) :]
    assert set(wide.tolist()) <= set(hashes[bounds[2] : bounds[3]].tolist())


def test_lines_that_share_several_groups_are_compared_in_one():
    kind = pa.struct([("keys", pa.list_(pa.int64()))])
    x, y = (pa.array([{"keys": k} for k in own], kind) for own in ([[-4, 7], [7], [9]], [[7, -4], [9, 7]]))
    assert not lines.met_before(x, y, -4).any()
    assert lines.met_before(x, y, 7).tolist() == [[True, False], [False, False], [False, False]]
    assert lines.met_before(x, y, 9).tolist() == [[True, True], [True, True], [False, False]]


def test_fuzzy_lines_with_null_and_repeated_ids(llm):
    line = "the same line stands in many of the documents here, now and then"
    rows = [(None, f"{line}\nown"), (None, line), (3, f"alone\n{line}!"), (3, f"other\n{line}!"), (4, f"{line}\n\n{line}"), (5, None)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert by_id(lines.deduplicated(df, width=5), "n_lines", "n_removed", "removed_lines") == brute.fuzzy_lines(rows, width=5)
    every = lines.occurrences(df, width=5).collect()
    assert sum(r["removed"] for r in every) == sum(n for _, n, _ in brute.fuzzy_lines(rows, width=5).values())
    assert sorted(r["line"] for r in every).count(-1) == len(rows)


def test_fuzzy_lines_of_nothing(none, clashing):
    assert lines.deduplicated(none).collect() == []
    kept = lines.without_lines(clashing)
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert text[8].startswith("ONE two\n") and text[7] == "" and text[1] is None


# 6 licences


def test_licences(both):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    got = by_id(licences.findings(both), *names, "labels", "score")
    for i, text in texts(both):
        if i is not None:
            assert got[i][:5] == brute.base_phrases(text, licences.BASE)
            assert set(got[i][4].split(",")) <= {*got[i][5].split(","), ""} and 0 <= got[i][6] <= 1


def test_licence_templates_are_found_with_changes(llm):
    text = licences.TEMPLATES[2][1]
    cut = text.replace("free of charge, to any", "free of charge, in all lands, to any").replace("publish, distribute, ", "")
    df = llm.createDataFrame([(1, f"x y {text}"), (2, f"{cut} z"), (3, text[:60]), (4, "the license of the software")], "doc_id long, text string")
    got = by_id(licences.findings(df), "labels", "score", "span_from", "span_to")
    assert got[1] == ("mit", 1.0, [2], [2 + len(brute.alnum(text))])
    assert got[2][0] == "mit" and 0.6 <= got[2][1] < 1
    assert got[3][0] == got[4][0] == ""


def test_each_place_of_a_notice_has_its_span(llm):
    text = licences.TEMPLATES[2][1]
    n, cut = len(brute.alnum(text)), text.replace("publish, distribute, ", "")
    m = len(brute.alnum(cut))
    far, back = f"{text} " + "own words " * 50 + cut, f"{text} {text} {text}"
    df = llm.createDataFrame([(1, far), (2, back), (3, f"{text[:90]} other {text}")], "doc_id long, text string")
    got = by_id(licences.findings(df), "labels", "score", "span_from", "span_to", "span_label")
    assert got[1] == ("mit", 1.0, [0, n + 100], [n, n + 100 + m], ["mit", "mit"])
    assert got[2] == ("mit", 1.0, [0, n, 2 * n], [n, 2 * n, 3 * n], ["mit"] * 3)
    assert len(got[3][2]) == 1 and got[3][1] == 1.0


def test_words_of_a_taken_chain_are_left_out():
    assert licences.without([(0, 3, 20), (30, 0, 5)], [(4, 8), (15, 18), (31, 40)]) == [(0, 3, 4), (8, 11, 7)]


def test_licences_of_nothing(none, clashing):
    assert licences.findings(none).collect() == []
    assert licences.findings(clashing).count() == clashing.count()


# 7 decontamination


def test_decontamination(both, items, llm):
    more = llm.createDataFrame([(900, "w3 W4, w5"), (901, None), (902, ""), (None, "w7 w8 w9"), (903, "déjà vu")], "item_id long, text string")
    all_items = items.select("item_id", "text").unionByName(more)
    named = [(r[0], r[1]) for r in all_items.collect()]
    got = by_id(decontaminate.contamination(both, all_items), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    in_blocks = by_id(decontaminate.contamination(both, all_items, block_words=700), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == in_blocks and sum(g[4] for g in got.values()) > 5
    for i, text in texts(both):
        if i is not None and len(text or "") < 20_000:
            want = brute.hits(text, named)
            digest = brute.hits(text, [n for n in named if n[0] is not None])[3]
            assert got[i] == (*want[:3], digest, want[4])


def test_contaminated_rows_and_spans_go(clashing, llm):
    items = llm.createDataFrame([(1, " ".join(f"W{i}" for i in range(20, 35)))], "item_id long, text string")
    clean = decontaminate.without_contaminated(clashing, items)
    assert clean.columns == clashing.columns
    assert {5, 6, 7, 8}.isdisjoint({r["doc_id"] for r in clean.collect()}) and clean.count() == clashing.count() - 6
    cut = decontaminate.without_spans(clashing, items)
    text = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == clashing.columns and text[5].startswith("w0 w1") and "w20" not in text[5] and "w19 \n w35" in text[5]
    assert text[1] is None and text[2] == ""


def test_decontamination_of_nothing(none, odd, items, llm):
    no_items = llm.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, items).collect() == []
    assert decontaminate.contamination(odd, no_items).filter("contaminated").count() == 0


# 8 repeats


def test_repeats(both):
    short = both.filter("text is null or length(text) < 50000")
    got = sorted((tuple(r) for r in repeats.cleaned(short).collect()), key=repr)
    assert got == sorted(brute.repeats(texts(short)), key=repr)


def test_repeats_of_a_hot_passage(llm):
    passage = " ".join(f"shared{i}" for i in range(30))
    rows = [(k, f"before{k} {passage} after{k} " + " ".join(f"own{k}x{i}" for i in range(k % 9))) for k in range(150)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in repeats.cleaned(df).collect())
    assert got == sorted(brute.repeats(rows))


def test_repeats_of_nothing(none, clashing):
    assert repeats.cleaned(none).collect() == []
    assert repeats.cleaned(clashing).count() == clashing.count()


# 9 near copies


def test_near_duplicates(both):
    got = by_id(neardup.linked(both), "n_shingles", "component_id", "kept")
    want = brute.near(texts(both))
    assert {i: g for i, g in got.items() if i is not None} == want


def test_near_duplicates_that_miss_the_first_of_their_group(llm):
    base = [f"s{i}" for i in range(100)]
    rows = []
    for k in range(60):  # a chain: each is near the next, few are near the first
        rows.append((k, " ".join([*base[k:], *(f"t{i}" for i in range(k))])))
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert by_id(neardup.linked(df), "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_duplicates_of_short_texts(llm):
    # Sets of 5 and 4 shingles, similarity 0.8 exactly: four of them decide the registers of the other.
    rows = [(2 * k + j, " ".join(f"k{k}w{i}" for i in range(8 - j))) for k in range(1500) for j in range(2)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert by_id(neardup.linked(df), "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_duplicates_of_short_texts_across_a_group(llm):
    import numpy as np
    import pyarrow as pa

    from crmweave.llm.text import pieces

    pairs = [[" ".join(f"k{k}w{i}" for i in range(8 - j)) for j in range(2)] for k in range(400)]
    for a, b in pairs:
        made = neardup.profiled(next(pieces(pa.array([a, b]))), 4)
        bands, n = neardup.as_registers(made.field("bands")), made.field("n").to_numpy()
        if neardup.estimates(bands[:1], bands[1:], n[:1].astype(float), n[1:].astype(float))[0] < 0.8 - neardup.SLACK:
            break
    else:
        raise AssertionError("no pair with a low estimate")
    band = int(np.flatnonzero((bands[0] == bands[1]).reshape(-1, neardup.BAND_ROWS).all(axis=1))[0])
    rows = [(band, 1, i, i, i == 2, int(n[i - 1]), made.field("bands")[i - 1].as_py(), 2, t) for i, t in ((1, a), (2, b))]
    df = llm.createDataFrame(rows, "band int, key long, id long, component long, outer boolean, n long, bands array<long>, size long, text string")
    packed = neardup.zipped(df.select("id", "text")).withColumnRenamed("text", "zip")
    groups = df.join(packed, "id").select("band", "key", "id", "component", "outer", "n", "bands", "size", F.col("zip").alias("text"))
    assert [tuple(r) for r in neardup.across(groups, 4, 80).collect()] == [(1, 2)]


def test_one_of_each_group_stays(clashing, none):
    left = neardup.without_near_copies(clashing)
    ids = [r["doc_id"] for r in left.collect()]
    assert left.columns == clashing.columns and sorted(i for i in ids if i is not None) == [-3, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13, 14, 8] or 7 not in ids
    assert ids.count(6) == 0 and ids.count(5) == 1 and ids.count(None) == 2
    assert neardup.linked(none).collect() == [] and neardup.without_near_copies(none).collect() == []


def test_unlike_texts_of_one_id_all_stay(llm):
    alike, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, alike), (1, other), (2, alike + " tail"), (3, other), (3, "short one"), (None, alike), (None, alike)]
    left = neardup.without_near_copies(llm.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, alike), (1, other), (3, "short one"), (None, alike), (None, alike)]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(want, key=repr)


def test_components(llm):
    links = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (70, 100), (5, 5)]
    got = {tuple(r) for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(31)} | {(i, 50) for i in (50, 70, 100)}
    assert components(llm.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("links, rounds", [([(0, 1), (1, 0), (0, 2), (0, 1), (50, 70), (5, 5), (None, 3)], 0), ([(0, 1), (1, 2), (50, 70)], 1)])
def test_links_that_are_stars_take_no_round(llm, monkeypatch, links, rounds):
    kept = []
    monkeypatch.setattr(joining, "stored", lambda df, what: kept.append(what) or stored(df, what))
    found = joining.stars(llm.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 0), (2, 0), (70, 50)]
    assert len(kept) == max(rounds, 1)


def test_further_links_join_components(llm):
    joined = joining.stars(llm.createDataFrame([(1, 2), (3, 4), (8, 9)], "a long, b long"))
    more = llm.createDataFrame([(2, 4), (4, 0), (10, 11)], "a long, b long")
    got = {tuple(r) for r in neardup.extended(joined, more).collect()}
    assert got == {(1, 0), (2, 0), (3, 0), (4, 0), (9, 8), (11, 10)}


# 10 shards


def test_shards(both):
    rows = shards.shard_rows(both, 16).collect()
    assert len(rows) == both.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows}
    assert got == {(i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in texts(both)}
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_shards_by_weight(llm):
    df = llm.range(6000).withColumnRenamed("id", "doc_id").select("doc_id", shards.shard_of(F.col("doc_id"), {3: 1.0, 8: 3.0}).alias("s"))
    n = {r[0]: r[1] for r in df.groupBy("s").count().collect()}
    assert 0.7 < n[8] / 6000 < 0.8 and n[3] + n[8] == 6000
    with pytest.raises(ValueError, match="weights"):
        shards.shard_of(F.col("doc_id"), [1.0, 0.0])


def test_placed_rows(clashing, none):
    placed = shards.placed_rows(clashing, 4)
    assert placed.columns == [*clashing.columns, "shard_", "slot_"] and placed.count() == clashing.count()
    assert shards.placed_rows(none, 4).collect() == []
