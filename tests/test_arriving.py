"""Joins over several links, and profiles of parts."""

import pytest

from crmweave.operators.autojoin import auto_join, shortest_paths
from crmweave.operators.profiles import profile_state, store_profile, united_profile
from crmweave.specs import Relationship

LINKS = [
    Relationship("a", "b1", "b", "id"), Relationship("a", "b2", "b", "id"), Relationship("b", "c", "c", "id"),
    Relationship("c", "a", "a", "id"), Relationship("a", "x", "d", "id", kind=("k", 1)),
    Relationship("a", "x", "e", "id", kind=("k", 2)), Relationship("d", "c", "c", "id"), Relationship("d", "boss", "d", "id"),
]


@pytest.fixture
def linked(spark):
    return {
        "a": spark.createDataFrame([(1, 1, 2, 7, 1), (2, 2, None, 7, 2), (3, 9, 1, None, None)], "id INT, b1 INT, b2 INT, x INT, k INT"),
        "b": spark.createDataFrame([(1, 5, "b-one"), (2, None, "b-two")], "id INT, c INT, name STRING"),
        "c": spark.createDataFrame([(5, 1, "c-five"), (6, 2, "c-six")], "id INT, a INT, name STRING"),
        "d": spark.createDataFrame([(7, 6, 8, "d-seven"), (8, 5, None, "d-eight")], "id INT, c INT, boss INT, name STRING"),
        "e": spark.createDataFrame([(7, "e-seven")], "id INT, name STRING"),
    }


def test_named_ways_share_joins_and_keep_rows(linked, rows):
    ways = {"first": ("b1",), "second": ("b2",), "far": ("b1", "c"), "boss": ("x", "boss"), "kind_d": (("x",), "d")}
    got = auto_join(linked, "a", ["id", "first.name", "second.name", "far.name", "e.name", "kind_d.name", "boss.name"], LINKS, ways)
    assert got.columns == ["id", "first_name", "second_name", "far_name", "e_name", "kind_d_name", "boss_name"]
    assert rows(got) == [
        (1, "b-one", "b-two", "c-five", None, "d-seven", "d-eight"), (2, "b-two", None, None, "e-seven", None, None),
        (3, None, "b-one", None, None, None, None),
    ]


def test_shortest_way_and_cycles(linked, rows):
    assert [r.column for r in shortest_paths("b", "a", LINKS)[0]] == ["c", "a"]
    assert rows(auto_join(linked, "b", ["id", "a.k"], LINKS)) == [(1, 1), (2, None)]
    assert shortest_paths("e", "a", LINKS) == []


def test_ambiguous_ways_are_refused(linked):
    with pytest.raises(ValueError, match="several ways"):
        auto_join(linked, "a", ["b.name"], LINKS)
    with pytest.raises(ValueError, match="several ways"):
        auto_join(linked, "a", ["c.name"], LINKS)
    with pytest.raises(ValueError, match="no relationship"):
        auto_join(linked, "e", ["a.id"], LINKS)
    with pytest.raises(ValueError, match="0 ways"):
        auto_join(linked, "a", ["far.name"], LINKS, {"far": ("nowhere",)})
    with pytest.raises(ValueError, match="2 ways"):
        auto_join(linked, "a", ["far.name"], LINKS, {"far": ("x",)})


def test_united_profile_is_that_of_all_rows(spark, tmp_path, rows):
    df = spark.range(6000).selectExpr("id", "IF(id % 3 = 0, NULL, id % 5) AS few", "IF(id % 2 = 0, double('nan'), id) AS odd")
    path = str(tmp_path / "states")
    store_profile(df.where("id < 10"), path, "one")
    for load, part in (("one", df.where("id < 2000")), ("two", df.where("id >= 2000")), ("none", df.where("false"))):
        store_profile(part, path, load)
    got = {r["column_name"]: r for r in united_profile(spark.read.parquet(path)).collect()}
    assert {c: (r["loads"], r["rows"], r["null_count"]) for c, r in got.items()} == {
        "id": (3, 6000, 0), "few": (3, 6000, 2000), "odd": (3, 6000, 3000),
    }
    once = {r["column_name"]: r for r in united_profile([profile_state(df, "all")]).collect()}
    for c, n in (("id", 6000), ("few", 5), ("odd", 3000)):
        assert abs(got[c]["distinct_count"] - n) <= 0.03 * n
        assert abs(got[c]["distinct_count"] - once[c]["distinct_count"]) <= 0.03 * n
    assert sorted((t["value"], t["count"]) for t in got["few"]["top_values"]) == [(str(i), 800) for i in range(5)]
