"""The conversation trie and tree contraction against the plain way."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crmweave.llm import conversations, queries
from crmweave.llm.contraction import subtree_totals

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def of_each(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in turns.items()}


def with_shared_starts(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]  # the remainder has the sign of c, as in SQL
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(node))
        out.append((
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    rows = [
        (None, 0, "user", "of nobody"), (0, None, None, None), (0, 0, "user", "hi"), (0, 1, "assistant", "hello \U0001F600"),
        (1, 5, "user", "x"), (1, 2, None, ""), (2, 0, "", ""), (2, 0, "", ""), (3, 0, "a", "b:c"), (4, 0, "a:b", "c"), (7, 1, "user", None),
        (250, 0, "user", "no head"), (250, 1, "user", "w" * 50_000), (-5, 0, "user", "below"), (-5, 1, "user", "nought"), (-100, 0, "user", "below"),
    ]
    rows += [(300 + i, t, "user", f"turn {t}") for i in range(12) for t in range(3 + i % 3)]
    rows += [(400, t, "user", "again" if t % 7 else f"t{t}") for t in range(300)] + [(401, t, "user", "again" if t % 7 else f"t{t}") for t in range(250)]
    return rows


def test_trie_of_odd_conversations(llm, odd_rows):
    df = llm.createDataFrame(odd_rows, SCHEMA).withColumns({x: F.lit("!") for x in ("pos", "depth", "id", "part", "n", "a", "digest")})
    convs = of_each(odd_rows)
    assert got(conversations.prefix_trie(df.repartition(3))) == plain_trie(convs)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = llm.conf.get(name)
    llm.conf.set(name, "false")  # so that the long conversations lie in several tasks
    try:
        assert got(conversations.shared_starts_trie(df)) == plain_trie(with_shared_starts(convs))
    finally:
        llm.conf.set(name, before)


def test_no_conversation_has_no_node(llm):
    none = llm.createDataFrame([], SCHEMA)
    assert conversations.shared_starts_trie(none).collect() == []
    assert conversations.prefix_trie(llm.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []


def test_query_over_the_small_table(llm):
    rows = [tuple(r) for r in llm.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op13_conversation_trie"](llm, SMALL)) == plain_trie(with_shared_starts(of_each(rows)))


@pytest.mark.parametrize("kind", ["path", "star", "random", "forest"])
def test_totals_of_subtrees(llm, kind):
    draw = random.Random(kind)
    parent = {
        "path": lambda i: i - 1 if i else None, "star": lambda i: 0 if i else None,
        "random": lambda i: draw.randrange(max(0, i - 3), i) if i else None,
        "forest": lambda i: None if i % 10 == 0 else draw.randrange(i - i % 10, i),
    }[kind]
    rows = [(i, parent(i), draw.randrange(9), 1) for i in range(60)]
    want = {i: [x, y] for i, _, x, y in rows}
    for i, p, _, _ in reversed(rows):
        if p is not None:
            want[p] = [a + b for a, b in zip(want[p], want[i], strict=True)]
    df = llm.createDataFrame(rows, "id long, parent long, x long, y long")
    assert {r["id"]: [r["x"], r["y"]] for r in subtree_totals(df, ["x", "y"]).collect()} == want
