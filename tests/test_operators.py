"""Operators on small frames, against plain Python where there is something to compute."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crmweave.crm.legacy import ENTITIES, RELATIONSHIPS
from crmweave.crm.target import object_map, target_entity
from crmweave.functions.keys import canonical_key
from crmweave.operators import contact, keyed, lookup, metrics, project, quality, reconcile, search
from crmweave.operators.autojoin import auto_join
from crmweave.plans.processed import processed_view
from crmweave.specs import Relationship


@pytest.fixture
def skewed(spark):
    """9,000 rows: a third under one key, a third without a key, exact copies throughout."""
    return spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 50 END AS k", "id % 11 AS v"
    )


@pytest.fixture
def dim(spark):
    return spark.range(40).selectExpr("id AS k", "concat('n', id) AS name")


@pytest.mark.parametrize("setting", lookup.SKEW_SETTINGS)
def test_joins_need_skew_splitting(spark, skewed, dim, setting):
    previous = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        for join in (
            lambda: lookup.lookup_join(skewed, dim, ["k"]), lambda: lookup.with_group_count(skewed, "k", "n"),
            lambda: lookup.left_lookup(skewed, dim, [("k", "k")], {"name": "name"}),
        ):
            with pytest.raises(ValueError, match=setting):
                join()
    finally:
        spark.conf.set(setting, previous)


def test_one_key_needs_one_shuffle(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(100).selectExpr("id AS k", "id AS v")
        one, two = (spark.range(50).selectExpr("id AS k", f"id AS {c}") for c in ("a", "b"))
        both = lookup.left_lookup(lookup.left_lookup(base, one, [("k", "k")], {"a": "a"}), two, [("k", "k")], {"b": "b"})
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3  # the base once, each lookup once
        counted = lookup.with_group_count(base, "k", "n")._jdf.queryExecution().executedPlan().toString()
        assert counted.count("Exchange hashpartitioning") <= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_adaptive_execution_splits_a_hot_key(spark, dim):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        large = spark.range(0, 300_000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS v")
        counted = lookup.lookup_join(large, dim, ["k"]).groupBy("k").agg(
            F.count("*").alias("n"), F.max("v").alias("v")
        )
        assert {r["n"] for r in counted.collect() if r["k"] == 7} == {100_001}
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in previous.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_group_count_includes_the_null_group(skewed):
    counted = lookup.with_group_count(skewed, "k", "n")
    want = Counter(r["k"] for r in skewed.collect())
    got = counted.collect()
    assert len(got) == 9000
    assert all(r["n"] == want[r["k"]] for r in got)


# ---------------------------------------------------------------------- contacts

LINKS = [(1, 30, "Business", "c"), (1, 10, "Business", "z"), (1, 20, "Mobile", "m"), (2, 5, "Fax", "f")]


@pytest.fixture
def links(spark):
    return spark.createDataFrame(LINKS, "owner INT, id INT, kind STRING, number STRING")


@pytest.fixture
def owners(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "owner_id INT")


def test_primary_contact_keeps_the_row_count(owners, links, rows):
    got = contact.with_contact(
        owners, links, "owner_id", "owner", ("kind", "Business"), "id", {"phone": "number", "phone_id": "id"}
    )
    assert rows(got) == [(1, "z", 10), (2, None, None), (3, None, None)]


def test_fan_out_keeps_every_link(owners, links, rows):
    got = contact.with_contact(
        owners, links, "owner_id", "owner", ("kind", "Business"), "id", {"phone": "number"}, fan_out=True
    )
    assert rows(got) == [(1, "c"), (1, "z"), (2, None), (3, None)]


def test_primary_is_limited_before_the_shuffle(links):
    plan = contact.pick_primary(links, ["owner"], "id")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_pivot_and_coverage(owners, links, rows):
    got = contact.with_pivoted_links(
        owners, links, "owner_id", "owner", "kind", "number", {"b": "Business", "m": "Mobile"}
    )
    assert rows(got) == [(1, "z", "m"), (2, None, None), (3, None, None)]
    assert rows(contact.coverage(got, ["b"]).selectExpr("column_name", "rows", "filled", "double(percent)")) == [
        ("b", 3, 1, 33.33)
    ]


# ---------------------------------------------------------------------- projection

@pytest.fixture
def crm(spark):
    company = spark.createDataFrame(
        [(1, "Acme", 100, "Active"), (2, "Beta", None, "Old")],
        "Comp_CompanyId INT, Comp_Name STRING, Comp_PrimaryAddressId INT, Comp_Status STRING",
    ).withColumn("Comp_WebSite", F.lit("w"))
    address = spark.createDataFrame(
        [(100, "Oslo", 1, None), (101, "Bergen", 1, None)],
        "Addr_AddressId INT, Addr_City STRING, Addr_CompanyId INT, Addr_PersonId INT",
    )
    person = spark.createDataFrame(
        [(9, 1, "Ann", None), (8, 77, "Bo", "Li")],
        "Pers_PersonId INT, Pers_CompanyId INT, Pers_FirstName STRING, Pers_LastName STRING",
    )
    case = spark.createDataFrame(
        [(1, 1, 9, "Open"), (2, 2, None, "Closed"), (3, None, 8, "Open")],
        "Case_CaseId INT, Case_PrimaryCompanyId INT, Case_PrimaryPersonId INT, Case_Status STRING",
    )
    email = spark.createDataFrame(
        [(9, 2, 13, "b@x.de"), (9, 1, 13, "a@x.de"), (9, 0, 5, "no@x.de")],
        "ELink_RecordID INT, Emai_EmailId INT, ELink_EntityID INT, Emai_EmailAddress STRING",
    )
    return {"company": company, "address": address, "person": person, "case": case, "email_link": email}


def test_entity_projection_types_missing_columns(crm):
    df = project.project_entity(crm, ENTITIES["Company"])
    assert dict(df.dtypes)["Comp_CreatedDate"] == "timestamp_ntz"
    assert [c for c in df.columns if c.startswith("Comp_")] == list(ENTITIES["Company"].base)
    assert {r["Comp_CompanyId"]: r["Address_City"] for r in df.collect()} == {1: "Oslo", 2: None}
    with pytest.raises(ValueError):
        project.project_entity(crm, ENTITIES["Company"], missing="error")


@pytest.mark.parametrize("condition", ["AND Case_Status = 'Open'", "where Case_Status = 'Open'", "Case_Status = 'Open'"])
def test_filter_with_a_leading_keyword(crm, rows, condition):
    assert rows(project.project_entity(crm, ENTITIES["Case"], condition), "Case_CaseId") == [(1,), (3,)]


def test_filter_on_a_looked_up_column(crm, rows):
    got = project.project_entity(crm, ENTITIES["Case"], "Company_Name = 'Acme'", missing="skip")
    assert rows(got, "Case_CaseId", "Person_EmailAddress") == [(1, "a@x.de")]


def test_case_mail_does_not_fan_out_unless_asked(crm):
    assert project.project_entity(crm, ENTITIES["Case"]).count() == 3
    assert project.project_entity(crm, ENTITIES["Case"], fan_out=True).count() == 4


def test_limit_none_is_all_and_zero_is_none(crm, rows):
    spec = ENTITIES["Case"]
    assert project.project_entity(crm, spec, limit=None).count() == 3
    assert project.project_entity(crm, spec, limit=0).count() == 0
    assert rows(project.project_entity(crm, spec, limit=2), "Case_CaseId") == [(1,), (2,)]


def test_column_names_ignore_case_and_know_aliases(spark):
    tables = {
        "case": spark.sql("SELECT 1L AS case_caseid, TIMESTAMP_NTZ '2024-01-01' AS Case_Opened, 1L AS Case_PrimaryCompanyId, NULL AS Case_PrimaryPersonId"),
        "company": spark.sql("SELECT 1L AS COMP_COMPANYID, 'Acme' AS comp_name"),
        "person": spark.sql("SELECT 1L AS Pers_PersonId"),
    }
    row = processed_view(tables, "cases").first()
    assert (row["Case_CaseId"], row["Case_OpenedDate"], row["Company_Name"]) == (1, datetime(2024, 1, 1), "Acme")


def test_auto_join_needs_a_relationship(crm, rows):
    got = auto_join(crm, "case", ["Case_CaseId", "company.Comp_Name"], RELATIONSHIPS)
    assert rows(got) == [(1, "Acme"), (2, "Beta"), (3, None)]
    with pytest.raises(ValueError):
        auto_join(crm, "case", ["email_link.Emai_EmailId"], RELATIONSHIPS)


def test_order_of_nulls_is_stated(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id INT, t INT")
    assert [r["id"] for r in project.ordered(df, ["-t"]).collect()] == [1, 3, 2]
    assert [r["id"] for r in project.ordered(df, ["-t"], nulls_first_desc=False).collect()] == [3, 2, 1]


def test_sample_records(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id INT, v STRING")
    assert [r["record"] for r in project.sample_records(df, "id", 2).collect()] == [
        '{"id":1,"v":"a"}', '{"id":2,"v":"b"}',
    ]


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS Case_CaseId", "'Open' AS Case_Status", "'x' AS Unused").write.parquet(str(tmp_path / "c"))
    tables = {"case": spark.read.parquet(str(tmp_path / "c")), "company": None}
    spec = ENTITIES["Case"].__class__(name="c", source="case", key="Case_CaseId", ddl="Case_CaseId BIGINT")
    plan = project.project_entity(tables, spec, "Case_Status = 'Open'")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "IsNotNull(Case_CaseId)" in pushed and "EqualTo(Case_Status,Open)" in pushed
    assert "Unused" not in plan


# ---------------------------------------------------------------------- search

@pytest.fixture
def contacts(spark):
    return spark.createDataFrame(
        [(1, "Ann", "Lee", "ACME Nord", "a@x.de", "11"), (2, "Ann", "Ray", "Beta", "b@x.de", "12.0"),
         (3, "Cy", "Lee", "Acme", "c@x.de", None)],
        "hs_object_id INT, firstname STRING, lastname STRING, company STRING, email STRING, legacy_contact_id STRING",
    )


@pytest.mark.parametrize(
    "parameters,ids",
    [({}, [1, 2]), ({"company": "acme"}, [1]), ({"company": ""}, [1, 2]),
     ({"firstname": "ann", "lastname": "ray"}, [2]), ({"lastname": "lee"}, [1]),
     ({"email": "b@x.de", "company": "nord"}, [1, 2]), ({"legacy_contact_id": 12}, [2])],
)
def test_search_drops_absent_parameters(contacts, parameters, ids):
    assert [r["hs_object_id"] for r in search.search(contacts, "contacts", **parameters).collect()] == ids


def test_search_rejects_unknown_parameters(contacts):
    with pytest.raises(ValueError):
        search.search(contacts, "contacts", shoe_size=4)


# ---------------------------------------------------------------------- reconciliation

@pytest.fixture
def sides(spark):
    legacy = spark.createDataFrame(
        [("1.0", "Acme", "a.de"), ("2", "Beta", None), ("3", "Gamma", "g.de"), ("x", "Bad", None)],
        "Comp_CompanyId STRING, Comp_Name STRING, Comp_WebSite STRING",
    )
    target = spark.createDataFrame(
        [(100, "Acme ", "a.de", "1"), (90, "Beta", "b.de", " 2"), (91, "Beta", "", "2.0"), (92, "Own", None, None)],
        "hs_object_id BIGINT, name STRING, domain STRING, legacy_company_id STRING",
    )
    return legacy, target


def test_match_joins_on_the_canonical_key(sides, rows):
    pairs = reconcile.match(*sides, object_map("companies"))
    assert rows(pairs, "legacy_id", "target_id") == [("1.0", 100), ("2", 90), ("2", 91)]
    # A legacy column that feeds two properties is there once.
    assert [c for c in pairs.columns if c == "leg_Comp_WebSite"] == ["leg_Comp_WebSite"]


def test_unmatched_and_direct(sides, rows):
    legacy, target = sides
    assert rows(reconcile.unmatched(legacy, target, object_map("companies")), "legacy_id") == [("3",), ("x",)]
    assert rows(reconcile.match_direct(target, object_map("companies"))) == [("1", 100), ("2", 90), ("2", 91)]


def test_every_legacy_row_gets_one_status(sides, rows):
    got = reconcile.reconcile(*sides, object_map("companies"))
    assert rows(got, "legacy_id", "target_id", "reconciliation_status") == [
        (1, 100, "matched"), (2, 90, "conflict"), (3, None, "new"), (None, None, "error"),
    ]
    stats = reconcile.run_stats(got, "companies").first()
    assert tuple(stats) == ("companies", 4, 1, 1, 1, 1)
    assert rows(reconcile.conflicts(got)) == [(2, 90, "domain")]


def test_without_conflicts_found_rows_are_matched(sides, rows):
    got = reconcile.reconcile(*sides, object_map("companies"), mark_conflicts=False)
    assert rows(got, "reconciliation_status") == [("error",), ("matched",), ("matched",), ("new",)]


def test_numbers_compare_by_value(spark):
    legacy = spark.sql("SELECT 1 AS Oppo_OpportunityId, CAST(10.50 AS DECIMAL(15,2)) AS Oppo_Forecast")
    target = spark.sql("SELECT 5 AS hs_object_id, CAST(10.5 AS DECIMAL(20,4)) AS amount, '1' AS legacy_deal_id")
    assert reconcile.reconcile(legacy, target, object_map("deals")).first()["reconciliation_status"] == "matched"


def test_staging_row_of_the_worked_example(spark):
    legacy = spark.sql("SELECT 123 AS Comp_CompanyId, 'ACME Corp' AS Comp_Name, 'acme.com' AS Comp_WebSite")
    target = spark.sql("SELECT 456789L AS hs_object_id, 'Acme' AS name, '123' AS legacy_company_id")
    found = reconcile.reconcile(legacy, target, object_map("companies"), mark_conflicts=False)
    row = reconcile.to_staging(found, "companies", "2024-01-01 00:00:00").first()
    assert (row["legacy_company_id"], row["target_company_id"]) == (123, 456789)
    assert (row["legacy_name"], row["target_name"]) == ("ACME Corp", "Acme")
    assert (row["reconciliation_status"], float(row["match_confidence"])) == ("matched", 100.0)
    assert row["properties_to_update"] == {"name": "ACME Corp", "domain": "acme.com", "website": "acme.com"}


def test_staging_names_follow_the_target_system(sides):
    rows_ = reconcile.reconcile(*sides, object_map("companies"))
    assert "newcrm_company_id" in reconcile.to_staging(rows_, "companies", "2024-01-01", target="newcrm").columns


def test_direct_names_and_missing_fields(sides):
    legacy, _ = sides
    missing = reconcile.missing_fields(legacy, object_map("companies"))
    assert "Comp_Name" not in missing and "Addr_City" in missing
    assert object_map("communications").object_type == "engagements"
    assert object_map("deals").with_crosswalk("old_id").crosswalk == "old_id"
    with pytest.raises(ValueError):
        object_map("tickets")


# ---------------------------------------------------------------------- keyed tables

def test_first_and_last_record_win(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k STRING, at INT, v STRING")
    assert rows(keyed.first_wins(df, ["k"], "at"), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(keyed.last_wins(df, ["k"], "at"), "k", "v") == [("a", "y"), ("b", "z")]
    with pytest.raises(ValueError):
        keyed.first_wins(df, [], "at")


def test_insert_absent_and_overwrite(spark, rows):
    store = spark.createDataFrame([("a", "old")], "k STRING, v STRING")
    new = spark.createDataFrame([("a", 1, "n"), ("b", 1, "x"), ("b", 2, "y")], "k STRING, at INT, v STRING")
    assert rows(keyed.insert_absent(store, new, ["k"], "at")) == [("a", "old"), ("b", "x")]
    assert rows(keyed.overwrite(store, new, ["k"], "at")) == [("a", "n"), ("b", "y")]
    assert rows(keyed.existing_only(new, store, ["k"]), "at") == [(1,)]


def test_nested_records_come_first(spark, rows):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 1, named_struct('id', 7, 'name', 'A')), (2, 2, named_struct('id', 7, 'name', 'B')),
                                (3, 3, NULL) AS t(id, at, company)"""
    )
    tables = keyed.nested_records(df, {"company": ("company", ["id"])}, ["id"], "at", "person")
    assert list(tables) == ["company", "person"]
    assert rows(tables["company"]) == [(7, "A")]


def test_upsert_updates_only_named_columns(spark, rows):
    current = spark.createDataFrame([(1, "first", "pending"), (2, "kept", "pending")], "id INT, name STRING, status STRING")
    incoming = spark.createDataFrame(
        [(1, 1, "ignored", "matched"), (3, 2, "later", "conflict"), (3, 1, "head", "new"), (None, 1, "lost", "new")],
        "id INT, at INT, name STRING, status STRING",
    )
    merged = keyed.upsert(current, incoming, ["id"], ["status"], arrival="at")
    assert rows(merged) == [(1, "first", "matched"), (2, "kept", "pending"), (3, "head", "conflict")]
    again = keyed.upsert(merged, incoming, ["id"], ["status"], arrival="at")
    assert rows(again) == rows(merged)


# ---------------------------------------------------------------------- metrics and quality

def test_closure_rate_without_names(spark, rows):
    df = spark.createDataFrame([(1, "Closed"), (1, "Open"), (1, "Open"), (2, "Closed")], "g INT, s STRING")
    got = metrics.closure_rate(df, "g", "s", "Closed").selectExpr("g", "total_cases", "closed_cases", "double(closure_rate)")
    assert rows(got) == [(1, 3, 1, 33.33), (2, 1, 1, 100.0)]


def test_one_sla_target_for_all(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2024-01-01', TIMESTAMP_NTZ '2024-01-03'),
                                ('a', TIMESTAMP_NTZ '2024-01-01', TIMESTAMP_NTZ '2024-01-09') AS t(k, o, c)"""
    )
    assert float(metrics.sla_share(df, "k", "o", "c", 2).first()["sla_percent"]) == 50.0


def test_extract_stats_count_null_as_one_key(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k INT")
    assert rows(metrics.extract_stats({"e": (df, "k"), "none": (df.limit(0), "k")})) == [
        ("TOTAL", 4, 2, 2), ("e", 4, 2, 2), ("none", 0, 0, 0),
    ]


def test_orphans_and_cardinality(spark):
    tables = {
        "child": spark.createDataFrame([(1, 5), (1, 5), (9, 5), (None, 5), (4, 6)], "p INT, kind INT"),
        "parent": spark.createDataFrame([(1,), (2,)], "id INT"),
    }
    row = quality.check_relationships(
        tables, [Relationship("child", "p", "parent", "id", kind=("kind", 5))]
    ).first()
    assert (row["rows"], row["null_keys"], row["orphans"], row["cardinality"]) == (4, 1, 1, "many:1")


def test_keys_and_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id INT")
    assert tuple(quality.id_profile(df, "id").first()) == (4, 3, 1, 2)
    assert quality.check_key(df, "t", "id").first()["is_key"] is False
    assert quality.check_key(df.where("id IS NOT NULL").distinct(), "t", "id").first()["is_key"] is True


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None)], "x DOUBLE, s STRING")
    got = {r["column_name"]: r["null_count"] for r in quality.null_profile(df).collect()}
    assert got == {"x": 1, "s": 1}
    profile = {r["column_name"]: r for r in quality.column_profile(df, approximate=True).collect()}
    assert profile["s"]["data_type"] == "string" and profile["s"]["ordinal"] == 2


def test_profile_of_maps(spark):
    df = spark.sql("SELECT map('a', 1) AS m, array(1, 2) AS xs")
    got = {r["column_name"]: (r["null_count"], r["distinct_count"]) for r in quality.column_profile(df, approximate=False).collect()}
    assert got == {"m": (0, 1), "xs": (0, 1)}


def test_point_lookup_finds_padded_ids(spark):
    table = spark.sql("SELECT * FROM VALUES (1, ' 6.0'), (2, '66'), (3, NULL) AS t(hs_object_id, legacy_company_id)")
    for wanted in (6, "6", " 6.0 "):
        assert [r[0] for r in search.lookup_by_legacy_id(table, "companies", wanted).collect()] == [1]


def test_search_without_a_limit_and_by_like_names(spark):
    deals = spark.range(150).selectExpr("id AS hs_object_id", "'d' AS dealname", "'new' AS dealtype", "'x' AS legacy_deal_id")
    found = search.search(deals, "deals", "legacy_deal_id", limit=None)
    assert found.count() == 150 and "deal_type" in found.columns


def test_type_suggestions(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2024-01-02", "video", None), ("22", "7", "2024-01-02 10:00:00", "2024", None)],
        "i STRING, d STRING, t STRING, s STRING, e STRING",
    )
    got = {r["column_name"]: r["suggested_type"] for r in quality.suggest_types(df, df.columns).collect()}
    assert got == {"i": "int", "d": "decimal", "t": "datetime", "s": "string", "e": "string"}


def test_find_columns_by_name(spark, rows):
    df = spark.createDataFrame([("1", None, "x")], "Home_PHONE STRING, email STRING, other STRING")
    assert rows(quality.find_columns(df), "column_name", "filled") == [("Home_PHONE", 1), ("email", 0)]
    assert quality.find_columns(df.select("other")).count() == 0


def test_fan_out_ratio(spark):
    before = spark.range(4)
    row = quality.fan_out(before, before.union(before).union(spark.range(2))).first()
    assert (row["rows_before"], row["rows_after"], float(row["ratio"]), row["fans_out"]) == (4, 10, 2.5, True)


def test_target_scan_order(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 2), "b"), (3, None, "c"), (4, datetime(2025, 1, 1), None)],
        "hs_object_id INT, hs_timestamp TIMESTAMP_NTZ, legacy_communication_id STRING",
    )
    got = project.scan_target(df, target_entity("engagements"), limit=2)
    assert [r["hs_object_id"] for r in got.collect()] == [3, 2]


def test_numbers_and_text_compare_by_value(spark):
    kinds = spark.sql("SELECT 80.00BD AS n, '80' AS t, 'eighty' AS w, TIMESTAMP '2024-01-02 00:00:00' AS at, '2024-01-02' AS day")
    types = {f.name: f.dataType for f in kinds.schema.fields}

    def same(a, b):
        return kinds.select(reconcile._same(F.col(a), types[a], F.col(b), types[b])).first()[0]

    assert same("n", "t") and same("t", "n") and same("at", "day") and same("day", "at")
    assert not same("n", "w") and not same("w", "at")


def test_float_ids_are_written_out(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (12345678.0D), (1.5D), (12345678.5D), (100D), (0D), (-3D), (NULL) AS t(k)")
    assert [r[0] for r in df.select(canonical_key("k")).collect()] == ["12345678", "1.5", "12345678.5", "100", "0", "-3", None]
    text = spark.sql("SELECT * FROM VALUES (' 7.0 '), ('1E5'), (''), ('a.0') AS t(k)")
    assert [r[0] for r in text.select(canonical_key("k")).collect()] == ["7", "1E5", None, "a"]


def test_one_incoming_row_of_a_key_is_stored_whole(spark, rows):
    current = spark.createDataFrame([], "id long, a string, b string")
    incoming = spark.createDataFrame([(2, "x", "1"), (2, "y", "2"), (2, "x", "1")], current.schema)
    assert rows(keyed.upsert(current, incoming, ["id"], ["b"])) in ([(2, "x", "1")], [(2, "y", "2")])


def test_distinct_values_move_before_they_are_reduced(spark):
    """No reading task holds the values of all columns; a frequent value, NULLs and equal rows count once."""
    df = spark.range(2000).selectExpr("id % 500 as a", "'x' as b", "cast(null as string) as c", "map('k', id % 3) as m")
    counted = quality.distinct_counts(df, df.columns)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange") > plan.rindex("HashAggregate")
    assert {tuple(r) for r in counted.collect()} == {("a", 500), ("b", 1), ("m", 3)}
    assert quality.distinct_counts(df.limit(0), df.columns).collect() == []


def test_one_row_of_a_key_moves_without_a_second_copy(spark):
    """The row with the least content hash stays, whatever the order; rows are not carried twice to find it."""
    df = spark.range(600).selectExpr("id % 7 as k", "id % 50 as v", "if(id % 5 = 0, null, map('p', string(id % 40))) as m")
    kept = keyed.one_of_each(df, ["k"])
    assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString() and kept.columns == df.columns
    least = {}
    for r in df.selectExpr("*", "xxhash64(k, v, to_json(m)) as h").collect():
        least[r["k"]] = min(least.get(r["k"], (float("inf"),)), (r["h"], r["v"], r["m"]), key=lambda x: x[0])
    assert {r["k"]: (r["v"], r["m"]) for r in keyed.one_of_each(df.orderBy(F.desc("v")), ["k"]).collect()} == {k: x[1:] for k, x in least.items()}
    assert {r["k"]: (r["v"], r["m"]) for r in kept.collect()} == {k: x[1:] for k, x in least.items()}
