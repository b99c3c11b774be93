"""The pipeline over the small tables, each stage against the plain way, and the contract of the subpackage."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import brute
import corpus_pipeline
import pytest

import __spark_entry__ as contract
from crmweave.llm.frames import stored, table

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = table(llm, SMALL, "documents"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(llm, docs, SMALL), "stage")
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    names = list(stages)
    for name in names[1:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes
    assert stages[names[-1]].columns == [*stages["documents"].columns, "shard", "slot"]


def test_language_keeps_texts_with_words(stages):
    before, after = rows(stages["documents"]), rows(stages["language"])
    assert all(i in after for i, t in before.items() if len(brute.words(t)) > 20) and after.items() <= before.items()


def test_one_of_each_group_stays(stages):
    before, after = rows(stages["language"]), rows(stages["near copies"])
    want = brute.near(before.items(), width=5)
    assert set(after) == {i for i, (_, _, kept) in want.items() if kept}


def test_benchmark_passages_go(stages, llm):
    items = [(r["item_id"], r["text"]) for r in table(llm, SMALL, "benchmark").collect()]
    before, after = rows(stages["near copies"]), rows(stages["benchmark passages"])
    assert set(after) == {i for i, t in before.items() if not brute.hits(t, items)[4]} != set(before)


def test_mix_repeats_at_most_twice(stages):
    before = rows(stages["benchmark passages"])
    times = Counter(r["doc_id"] for r in stages["mix"].collect())
    assert set(times) <= set(before) and max(times.values()) <= 2 and len(times) > len(before) / 2


def test_shards_hold_the_mix(stages):
    got = stages["shards"].collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in stages["mix"].collect())
    of = {}
    for r in got:
        assert of.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((s, i) for s, n in Counter(r["shard"] for r in got).items() for i in range(n))


def test_queries_are_registered():
    names = contract.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert ("pipeline" in contract.oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)


def test_the_rest_does_not_import_this_part():
    rest = [p for p in (ROOT / "crmweave").rglob("*.py") if "llm" not in p.parts]
    assert rest and not [p for p in rest if "crmweave.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
    code = "import sys; sys.modules['crmweave.llm'] = None\nimport importlib.util as u\nfind = u.find_spec\n" \
        "import importlib\nu.find_spec = lambda m, *a: None if 'llm' in m or 'pipeline' in m else find(m, *a)\n" \
        "import __spark_entry__ as e\nq = e.queries()\nassert len(q) > 100 and not [n for n in q if n.startswith('op')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, check=False).returncode == 0
