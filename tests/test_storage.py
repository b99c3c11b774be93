"""Sources, sinks, keyed tables, extraction and reconciliation runs, streaming."""

from datetime import datetime

import pytest

from crmweave import session
from crmweave.crm.legacy import COMPANY, ENTITIES
from crmweave.crm.target import target_entity
from crmweave.operators.metrics import closure_rate, mean_days_by
from crmweave.operators.reconcile import status_stats
from crmweave.plans.extraction import extract_all, extract_and_save, extract_entities
from crmweave.plans.processed import register_views
from crmweave.plans.reconciliation import reconcile_all, staging_path
from crmweave.session import checkpoint, shared_folder
from crmweave.sources import readers, tables, writers
from crmweave.streaming.upsert import upsert_arrivals

NOW = datetime(2024, 2, 1, 12, 30)


@pytest.fixture
def company(spark):
    return spark.createDataFrame(
        [(1, 'Quote " and, comma', ""), (2, "sym\uf02dbol", None), (3, " spaced ", "w")],
        "Comp_CompanyId BIGINT, Comp_Name STRING, Comp_WebSite STRING",
    )


def test_bronze_csv_round_trip(spark, company, tmp_path, rows):
    path = str(tmp_path / "company.csv")
    writers.write_bronze(company, path, "csv")
    assert rows(readers.read_csv(spark, path, company.schema)) == [
        (1, 'Quote " and, comma', ""), (2, "sym-bol", None), (3, " spaced ", "w"),
    ]


def test_csv_with_byte_order_mark_and_inferred_types(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("\ufeffid,name\n1,Ann\n2,\n", encoding="utf-8")
    df = readers.read_csv(spark, str(path))
    assert df.dtypes == [("id", "int"), ("name", "string")]
    assert df.where("name IS NULL").count() == 1


def test_csv_text_over_several_lines(spark, tmp_path, rows):
    texts = ["a\nb", "\\n", "\\\n\r\\\\", 'q"u,o\r\nte', "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    writers.write_bronze(df, str(tmp_path / "m"), "csv")
    assert rows(readers.read_csv(spark, str(tmp_path / "m"), df.schema, escaped=True)) == list(enumerate(texts))
    assert spark.read.text(str(tmp_path / "m")).where("value <> 'id,t'").count() == len(texts)
    foreign = tmp_path / "f.csv"
    foreign.write_text('Comp_CompanyId,Comp_Name\n5,"two\nlines"\n')
    assert readers.read_entity(spark, str(foreign), COMPANY, multi_line=True).count() == 1


def test_entity_csv_is_typed_by_its_spec(spark, tmp_path):
    path = tmp_path / "company.csv"
    path.write_text("Comp_CompanyId,Comp_PrimaryPersonId\n5,6\n")
    df = readers.read_entity(spark, str(path), COMPANY)
    assert df.schema["Comp_CompanyId"].dataType.simpleString() == "bigint"


def test_tables_are_read_by_name_and_sql_parameters_are_bound(spark, company):
    writers.replace_table(company, "crm_company")
    writers.replace_table(company, "crm_company")
    readers.register({"c": readers.read_entity(spark, "crm_company")})
    got = readers.run_sql(spark, "SELECT count(*) FROM c WHERE Comp_Name = :n", n="x' OR '1'='1")
    assert got.first()[0] == 0
    assert readers.run_sql(spark, "SELECT count(*) FROM c").first()[0] == 3


def test_snapshot_is_skipped_when_empty(spark, company, tmp_path):
    assert writers.write_snapshot(company.limit(0), str(tmp_path / "s"), NOW) is None
    path = writers.write_snapshot(company, str(tmp_path / "s"), NOW)
    assert path.endswith("snapshot_ts=20240201_123000")
    assert spark.read.parquet(path).count() == 3


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for status in ("success", "failed"):
        writers.append_run_log(spark, path, [("match", "company", None, 5, status, None, 10, NOW)])
    assert spark.read.parquet(path).count() == 2


def test_write_all_skips_what_the_first_store_holds(spark, company, tmp_path):
    sinks = [lambda df, p=p: df.write.parquet(str(tmp_path / p)) for p in ("a", "b")]
    store = company.where("Comp_CompanyId = 1")
    writers.write_all(company, sinks, store, ["Comp_CompanyId"])
    assert [spark.read.parquet(str(tmp_path / p)).count() for p in ("a", "b")] == [2, 2]


def test_checkpoint_uses_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpoint(spark.range(5)).count() == 5
    assert shared_folder(spark) in spark.sparkContext.getCheckpointDir().removeprefix("file:")


def upsert(spark, path, values, touched=None):
    df = spark.createDataFrame(values, "id INT, name STRING, status STRING")
    picked = tables.touched_buckets(df, ["id"], 8) if touched else None
    return tables.upsert_table(spark, path, df, ["id"], ["status"], buckets=8, touched=picked)


def test_keyed_table_versions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert tables.read_table(spark, path) is None
    assert upsert(spark, path, [(i, f"n{i}", "new") for i in range(30)]) == 1
    assert upsert(spark, path, [(3, "x", "matched"), (99, "y", "new")], touched=True) == 2
    got = {r["id"]: (r["name"], r["status"]) for r in tables.read_table(spark, path).collect()}
    assert len(got) == 31 and got[3] == ("n3", "matched") and got[99] == ("y", "new") and got[4] == ("n4", "new")


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, [(i, "n", "new") for i in range(200)])
    upsert(spark, path, [(3, "x", "matched")], touched=True)
    assert len(list((tmp_path / "t" / "version=1").glob("bucket=*"))) == 8
    assert len(list((tmp_path / "t" / "version=2").glob("bucket=*"))) == 1


def test_unfinished_version_is_ignored_and_old_buckets_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for status in "abcd":
        upsert(spark, path, [(i, "n", status) for i in range(50)])
    assert {r["status"] for r in tables.read_table(spark, path).collect()} == {"d"}
    assert not list((tmp_path / "t" / "version=1").glob("bucket=*"))
    assert list((tmp_path / "t" / "version=3").glob("bucket=*"))
    (tmp_path / "t" / "version=4" / "_SUCCESS").unlink()
    assert {r["status"] for r in tables.read_table(spark, path).collect()} == {"c"}


@pytest.fixture
def crm(spark, company):
    return {
        "company": company.selectExpr("*", "CAST(10 AS BIGINT) AS Comp_PrimaryAddressId"),
        "address": spark.sql("SELECT 10L AS Addr_AddressId, 'Oslo' AS Addr_City, 1L AS Addr_CompanyId, 4L AS Addr_PersonId"),
        "person": spark.sql("SELECT 4L AS Pers_PersonId, 1L AS Pers_CompanyId, 'Ann' AS Pers_FirstName, NULL AS Pers_LastName, 10L AS Pers_PrimaryAddressId"),
    }


def test_extraction_goes_on_after_a_failure(spark, crm, tmp_path):
    doubled = crm | {"company": crm["company"].union(crm["company"])}
    results = {
        r.entity: r
        for r in extract_entities(
            doubled, str(tmp_path), "2024-02-01 00:00:00", ["Person", "Case", "Company", "Address"], unique=True
        )
    }
    assert list(results) == ["Address", "Company", "Person", "Case"]
    assert results["Case"].status == "error"
    assert (results["Company"].extracted, results["Company"].added, results["Company"].duplicates_skipped) == (6, 3, 3)
    saved = spark.read.parquet(results["Person"].path).first()
    assert saved["Company_Name"] == 'Quote " and, comma' and saved["bronze_source_file"] == "person"


def test_entities_are_extracted_side_by_side(spark, crm, tmp_path):
    results = extract_entities(crm, str(tmp_path), NOW, ["Person", "Company", "Address"], parallel=3)
    assert [(r.entity, r.status, r.extracted) for r in results] == [
        ("Address", "success", 1), ("Company", "success", 3), ("Person", "success", 1),
    ]


def test_shuffles_are_sized_by_the_caller(spark):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.configure(spark, partitions=777)
        assert spark.conf.get(setting) == "777"
    finally:
        spark.conf.unset(setting)


def test_unknown_entities_are_refused(crm, tmp_path):
    with pytest.raises(ValueError):
        extract_entities(crm, str(tmp_path), NOW, ["Invoice"])


def test_target_extraction_reports_what_it_did(spark, tmp_path):
    deals = spark.sql("SELECT 1L AS hs_object_id, 'd' AS dealname, '7' AS legacy_deal_id, 5 AS score")
    spec = target_entity("deals")
    result = extract_and_save(deals, spec, str(tmp_path), NOW)
    assert (result.status, result.extracted) == ("success", 1)
    assert result.columns["extra_columns"] == "score" and not result.columns["is_valid"]
    assert extract_and_save(deals.limit(0), spec, f"{tmp_path}/none", NOW).status == "no_data"
    unlinked = spark.sql("SELECT 1L AS hs_object_id, 'd' AS dealname")
    assert extract_and_save(unlinked, spec, str(tmp_path), NOW).status == "error"
    assert [r.status for r in extract_all({"deals": deals}, [spec], str(tmp_path), NOW)] == ["success"]


def test_views_are_registered_where_their_sources_exist(spark, crm):
    made = register_views(crm)
    assert sorted(made) == ["processed_addresses", "processed_companies", "processed_persons"]
    assert spark.sql("SELECT Person_FullName FROM processed_addresses").first()[0] == "Ann "


def test_reconciliation_run(spark, company, tmp_path):
    target = spark.createDataFrame(
        [(50, 'Quote " and, comma', "1"), (51, "Other", "2")], "hs_object_id BIGINT, name STRING, legacy_company_id STRING"
    )
    bronze = company.union(company.where("Comp_CompanyId = 1"))
    first = reconcile_all(spark, {"companies": bronze}, {"companies": target}, str(tmp_path), "2024-02-01 00:00:00")
    assert first["companies"] == {
        "object_type": "companies", "total": 4, "matched": 2, "unmatched": 1, "conflicts": 1, "errors": 0,
    }
    staged = tables.read_table(spark, staging_path(str(tmp_path), "companies"))
    assert {r["legacy_company_id"]: r["reconciliation_status"] for r in staged.collect()} == {
        1: "matched", 2: "conflict", 3: "new",
    }
    renamed = target.replace("Other", "sym\uf02dbol")
    reconcile_all(spark, {"companies": bronze}, {"companies": renamed}, str(tmp_path), "2024-03-01 00:00:00")
    staged = tables.read_table(spark, staging_path(str(tmp_path), "companies"))
    row = staged.where("legacy_company_id = 2").first()
    # The status is new, while the time of creation and the first target name stay.
    assert (row["reconciliation_status"], row["target_name"]) == ("matched", "Other")
    assert row["created_at"] == datetime(2024, 2, 1) and row["last_updated"] == datetime(2024, 3, 1)
    assert {r["reconciliation_status"]: r["n"] for r in status_stats(staged).collect()} == {"matched": 2, "new": 1}
    log = spark.read.parquet(str(tmp_path / "reconciliation_log"))
    assert [r["status"] for r in log.collect()] == ["success", "success"]


def test_failed_reconciliation_is_logged(spark, company, tmp_path):
    broken = spark.sql("SELECT 1 AS nothing")
    result = reconcile_all(spark, {"companies": company}, {"companies": broken}, str(tmp_path), "2024-02-01 00:00:00")
    assert result["companies"]["status"] == "failed"
    assert spark.read.parquet(str(tmp_path / "reconciliation_log")).first()["status"] == "failed"


def test_streamed_upserts(spark, tmp_path):
    arriving, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))

    def arrive(values):
        df = spark.createDataFrame(values, "id INT, at INT, name STRING, status STRING")
        df.coalesce(1).write.mode("append").parquet(arriving)
        query = upsert_arrivals(
            spark, arriving, df.schema, table, ["id"], ["status", "at"], "at", marks, buckets=4
        )
        query.awaitTermination()

    arrive([(1, 1, "a", "new"), (2, 1, "b", "new")])
    arrive([(2, 3, "later", "matched"), (2, 2, "mid", "conflict"), (3, 2, "c", "new")])
    got = {r["id"]: (r["name"], r["status"]) for r in tables.read_table(spark, table).collect()}
    assert got == {1: ("a", "new"), 2: ("b", "matched"), 3: ("c", "new")}


def test_entities_have_a_key_and_unique_columns():
    for spec in ENTITIES.values():
        assert spec.key in spec.base
        assert len(set(spec.columns)) == len(spec.columns)


def test_from_bronze_to_gold(spark, tmp_path):
    """Extract, read back, build views on the extracted tables, and measure."""
    sources = {
        "company": spark.sql("SELECT 1L AS Comp_CompanyId, 'Acme' AS Comp_Name, 10L AS Comp_PrimaryAddressId"),
        "person": spark.sql("SELECT 4L AS Pers_PersonId, 1L AS Pers_CompanyId, 'Ann' AS Pers_FirstName, 10L AS Pers_PrimaryAddressId"),
        "address": spark.sql("SELECT 10L AS Addr_AddressId, 'Oslo' AS Addr_City, 'Main 1' AS Addr_Address1"),
        "email_link": spark.sql("SELECT 4L AS ELink_RecordID, 1L AS Emai_EmailId, 13 AS ELink_EntityID, 'a@x.de' AS Emai_EmailAddress"),
        "case": spark.sql(
            """SELECT id AS Case_CaseId, 1L AS Case_PrimaryCompanyId, 4L AS Case_PrimaryPersonId,
                      IF(id < 3, 'Closed', 'Open') AS Case_Status, TIMESTAMP_NTZ '2024-01-01' AS Case_Opened,
                      IF(id < 3, TIMESTAMP_NTZ '2024-01-03', NULL) AS Case_Closed FROM range(4)"""
        ),
    }
    results = extract_entities(sources, str(tmp_path), NOW, ["Address", "Company", "Person", "Case"])
    assert {r.status for r in results} == {"success"}
    bronze = {r.entity.lower(): readers.read_parquet(spark, r.path) for r in results}
    assert {r["Person_EmailAddress"] for r in bronze["case"].collect()} == {"a@x.de"}

    register_views(bronze, "silver_")
    silver = spark.table("silver_cases")
    row = silver.where("Case_CaseId = 0").first()
    assert (row["Company_Name"], row["Person_FirstName"], row["bronze_source_file"]) == ("Acme", "Ann", "case")
    assert row["Case_OpenedDate"] == datetime(2024, 1, 1) and row["bronze_extracted_at"] == NOW

    rate = closure_rate(silver, "Comp_CompanyId", "Case_Status", "Closed").first()
    assert (rate["total_cases"], rate["closed_cases"], float(rate["closure_rate"])) == (4, 3, 75.0)
    mean = mean_days_by(silver, "Case_Status", "Case_OpenedDate", "Case_ClosedDate")
    assert {r["Case_Status"]: r["avg_days_to_close"] for r in mean.collect()} == {"Closed": 2.0, "Open": None}


def test_a_shared_folder_must_be_named_on_a_cluster(spark):
    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    rows = spark.range(20).selectExpr("id", "'a' AS v")
    tables.upsert_table(spark, str(tmp_path / "t"), rows, ["id"], ["v"], buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        tables.upsert_table(spark, str(tmp_path / "t"), rows, ["id"], ["v"], buckets=4)


def test_a_missing_table_is_named(spark, crm, tmp_path):
    few = {k: v for k, v in crm.items() if k != "address"}
    found = {r.entity: r.error for r in extract_entities(few, str(tmp_path), NOW, ["Person"])}
    assert found["Person"] == "lacks table address"
