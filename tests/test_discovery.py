"""Keys and links found in data: odd tables."""

import pytest

from crmweave.operators import discovery
from crmweave.operators.discovery import discover_keys, discover_links
from crmweave.specs import Relationship


def test_links_on_odd_tables(spark):
    parent = spark.createDataFrame([(i, f"n{i % 3}", None) for i in range(1, 41)], "id long, name string, nothing string")
    child = spark.createDataFrame(
        [(i, f" {1 + i % 40}.0", 1 + i % 38, 7, str(i)) for i in range(200)] + [(900, None, None, 7, "x")],
        "own int, ref string, late long, constant long, `a.b` string",
    )
    found = {tuple(r)[:4]: tuple(r)[4:] for r in discover_links({"p": parent, "c": child}, declared=[Relationship("c", "ref", "p", "id")]).collect()}
    assert found["c", "ref", "p", "id"] == (200, 0, 1.0, True)
    assert found["c", "late", "p", "id"] == (200, 0, 0.95, False)
    assert ("p", "id", "c", "own") in found and ("c", "a.b", "c", "own") in found and not any(k[1] == "constant" or k[3] == "ref" for k in found)
    assert ("p", "nothing", "p", "id") not in found and ("c", "own", "p", "id") not in found
    loose = {tuple(r)[:4] for r in discover_links({"p": parent, "c": child}, containment=0.15).collect()}
    assert ("c", "own", "p", "id") in loose
    assert discover_links({"p": parent.limit(0), "c": child.limit(0)}).collect() == []
    with pytest.raises(ValueError):
        discover_links({"x": spark.createDataFrame([(1.5,)], "v double")})


def test_large_columns_are_sampled(spark):
    """More values than a sketch holds: true links stay, unlike columns go."""
    parent = spark.range(60_000).selectExpr("id * 3 as id", "id % 7 as other")
    child = spark.range(90_000).selectExpr("pmod(xxhash64(id), 60000) * 3 as ref", "id * 3 + 1 as alien", "id % 50 * 3 as few")
    found = {tuple(r)[:4] for r in discover_links({"p": parent, "c": child}).collect()}
    assert ("c", "ref", "p", "id") in found and ("c", "few", "p", "id") in found and not any("alien" in k[1] for k in found)


def test_minimal_keys(spark):
    rows = [(i, i // 5, i % 5, "x", None if i == 3 else i, i // 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a long, b long, same string, gap long, half long")
    assert {r["key_columns"] for r in discover_keys(df, "t", columns=df.columns).collect()} == {"id", "a,b", "b,half"}
    assert discover_keys(df.drop("id"), "t", most=1).collect() == []
    assert {r["key_columns"] for r in discover_keys(df.select("a", "b"), "t").collect()} == {"a,b"}
    assert discover_keys(df.limit(0), "t").collect() == [] and discover_keys(df.unionByName(df), "t").collect() == []


def test_repetitions_in_a_part_rule_sets_out_before_they_are_counted(spark, monkeypatch):
    """Nearly unique sets pass any sketch; only what no part refutes is counted whole."""
    counted = []
    whole = discovery._is_key
    monkeypatch.setattr(discovery, "_is_key", lambda df, names: counted.append(names) or whole(df, names))
    df = spark.range(40_000).selectExpr("id", "id div 2 as half", "pmod(xxhash64(id), 50) as any")
    assert {r["key_columns"] for r in discover_keys(df, "t", most=2).collect()} == {"id"}
    assert counted == [("id",)]
    twice = spark.createDataFrame([(i if i else 1, i // 4, "x") for i in range(300)], "a long, b long, c string")
    assert discover_keys(twice, "t").collect() == []  # the one repetition, of (1, 0, x), is in no part looked at first


def test_links_read_the_tables_once_for_their_values(spark):
    """Values are stored with their counts; what meets whom is worked out from them."""
    parents = {f"p{k}": spark.range(k, 300 + k).withColumnRenamed("id", "key") for k in range(3)}
    found = discover_links({**parents, "c": spark.range(900).selectExpr("5 + id % 290 as ref", "cast(5 + id % 290 as string) || '.0' as text")})
    assert "Range" not in found._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r)[:4]: tuple(r)[4:6] for r in found.collect()}
    assert all(got["c", column, p, "key"] == (900, 0) for column in ("ref", "text") for p in parents)
    assert got["p0", "key", "p2", "key"] == (300, 2) and got["p2", "key", "p0", "key"] == (300, 2)
