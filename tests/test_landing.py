"""Landed lookups, incremental extraction, checked CSV, run logs and crosswalk links: odd cases and plans."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crmweave.crm.target import object_map
from crmweave.operators.crosswalk import crosswalk_of, link_report
from crmweave.operators.reconcile import reconcile
from crmweave.plans import increment
from crmweave.plans.increment import current_rows, extract_increment
from crmweave.plans.reconciliation import reconcile_all, staging_path
from crmweave.sources.landed import land_for_lookup, lookup_landed
from crmweave.sources.readers import quarantine, read_csv_checked
from crmweave.sources.tables import read_table
from crmweave.sources.writers import log_run, read_run_log


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_reaches_the_scan(spark, tmp_path):
    ids = ["7", " 7.0", None, "", "12", "12.5", "0x"] + [str(i) for i in range(100, 400)]
    df = spark.createDataFrame(list(enumerate(ids)), "n int, ref string")
    land_for_lookup(df.repartition(5), str(tmp_path / "t"), "ref")
    one, several = (lookup_landed(spark, str(tmp_path / "t"), x) for x in ([" 7 "], [12.0, "12.5", "399"]))
    assert "EqualTo(lookup_key,7)" in plan_of(one) and "In(lookup_key" in plan_of(several)
    assert sorted(r["n"] for r in one.collect()) == [0, 1] and sorted(r["ref"] for r in several.collect()) == ["12", "12.5", "399"]
    assert lookup_landed(spark, str(tmp_path / "t"), []).collect() == []
    assert spark.read.parquet(str(tmp_path / "t")).count() == len(ids)
    with pytest.raises(ValueError):
        land_for_lookup(df.withColumnRenamed("n", "lookup_key"), str(tmp_path / "u"), "ref")


def test_increments(spark, tmp_path, rows):
    path, schema = str(tmp_path / "inc"), "id int, v string, at int"
    run = lambda data: extract_increment(spark.createDataFrame(data, schema), path, ["id"], "at")
    with pytest.raises(ValueError):
        current_rows(spark, path, ["id"], "at")
    first = [(1, "a", 5), (2, "b", 5), (3, "c", None), (4, "d", 1), (4, "older", 0)]
    assert (lambda r: (r.run, r.written, r.deleted))(run(first)) == (1, 4, 0)
    assert (lambda r: (r.written, r.deleted))(run(first)) == (0, 0)
    # One more row of the mark's moment, one edited, one without a time, one gone, one that comes too late to be seen.
    second = [(1, "a", 5), (2, "b2", 6), (3, "c", None), (5, "e", 5), (6, "f", None), (7, "late", 2)]
    assert (lambda r: (r.written, r.deleted))(run(second)) == (3, 1)
    now = current_rows(spark, path, ["id"], "at")
    assert rows(now, "id", "v", "extract_run") == [(1, "a", 1), (2, "b2", 3), (3, "c", 1), (5, "e", 3), (6, "f", 3)]
    assert (lambda r: (r.written, r.deleted))(run([])) == (0, 5) and current_rows(spark, path, ["id"], "at").collect() == []
    # A key that comes back is current again.
    assert run([(4, "again", 9)]).written == 1 and rows(current_rows(spark, path, ["id"], "at"), "id", "v") == [(4, "again")]


def test_a_run_without_its_mark_does_not_count(spark, tmp_path):
    path, df = str(tmp_path / "inc"), spark.createDataFrame([(1, 1), (2, 2)], "id int, at int")
    extract_increment(df.limit(1), path, ["id"], "at")
    df.withColumn("id", F.lit(99)).write.parquet(f"{path}/rows/run=2")  # left by a run that was cut short
    assert [r["id"] for r in current_rows(spark, path, ["id"], "at").collect()] == [1]
    assert extract_increment(df, path, ["id"], "at") == increment.Increment(2, 1, 0)
    assert sorted(r["id"] for r in current_rows(spark, path, ["id"], "at").collect()) == [1, 2]


def test_checked_csv(spark, tmp_path):
    lines = ['id,name,price', '1,"a, b",2.5', 'x,c,', ',d,1e', '2', '3,e,1,9', ' 4 ,"say ""hi""",', '5,,3']
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    schema = StructType.fromDDL("id INT NOT NULL, name STRING, price DECIMAL(5,2)")
    good, bad = read_csv_checked(spark, str(tmp_path / "f.csv"), schema)
    assert [(r["id"], r["name"], r["price"] and float(r["price"])) for r in good.orderBy("id").collect()] == [
        (1, "a, b", 2.5), (4, 'say "hi"', None), (5, None, 3.0)
    ]
    assert good.select("id").count() == 3 and good.dtypes == [("id", "int"), ("name", "string"), ("price", "decimal(5,2)")]
    found = {r["record"]: list(r["reasons"]) for r in bad.collect()}
    assert found["2"] == found["3,e,1,9"] == ["wrong number of fields"] and len(found) == 4
    assert ["id is no int"] in found.values() and ["price is no decimal(5,2)", "id is missing"] in found.values()
    counts = {r["reason"]: r["records"] for r in quarantine(bad, str(tmp_path / "q")).collect()}
    assert counts == {"wrong number of fields": 2, "id is no int": 1, "price is no decimal(5,2)": 1, "id is missing": 1}


def test_run_log_is_replaced_by_a_repeated_run(spark, tmp_path, rows):
    path, at = str(tmp_path / "log"), datetime(2024, 5, 6, 7)
    for written in (1, 2):
        log_run(spark, path, "r1", at, [("extract", "X", 5, written, "success", None, 10), ("extract", "Y", 0, 0, "error", "no", None)])
    log_run(spark, path, "r2", datetime(2024, 5, 7), [("extract", "X", 9, 9, "success", None, 10)])
    log = read_run_log(spark, path)
    assert rows(log, "run", "entity_type", "rows_written") == [("r1", "X", 2), ("r1", "Y", 0), ("r2", "X", 9)]
    assert "PartitionFilters: [isnotnull(day" in plan_of(log.where("day = DATE '2024-05-07'"))


@pytest.fixture
def linked(spark):
    """Target companies 100 and up; a contact whose company has two target rows, none, a wrong one; one without a company."""
    companies = spark.createDataFrame([(101, " 1.0"), (100, "1"), (102, "2"), (103, None), (104, "x")], "hs_object_id long, legacy_company_id string")
    persons = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, None), (5, 2)], "Pers_PersonId long, Pers_CompanyId long")
    contacts = spark.createDataFrame(
        [(201, "1", 100), (202, "2", 2), (203, "3", 9), (204, "4", 100)], "hs_object_id long, legacy_contact_id string, associatedcompanyid long"
    )
    return companies, persons, contacts


def test_links_are_compared_and_written_as_target_ids(linked, rows):
    companies, persons, contacts = linked
    walks = {"companies": crosswalk_of(companies, object_map("companies"))}
    assert rows(walks["companies"]) == [("1", 100), ("2", 102), ("x", 104)]
    mapping = object_map("contacts")
    found = reconcile(persons, contacts, mapping, crosswalks=walks)
    got = {r["legacy_id"]: (r["reconciliation_status"], r["properties_to_update"].get("associatedcompanyid")) for r in found.collect()}
    assert got == {1: ("matched", "100"), 2: ("conflict", "102"), 3: ("matched", None), 4: ("conflict", None), 5: ("new", "102")}
    states = {r["legacy_id"]: (r["translated"], r["present"], r["state"]) for r in link_report(found, mapping).collect()}
    assert states == {1: (100, 100, "same"), 2: (102, 2, "differs"), 3: (None, 9, "unresolved"), 4: (None, 100, "empty"), 5: (102, None, "new")}
    # Without crosswalks a link is taken as it stands, and there is nothing to report.
    plain = reconcile(persons, contacts, mapping)
    assert {r["legacy_id"] for r in plain.where("reconciliation_status = 'conflict'").collect()} == {1, 4}
    with pytest.raises(ValueError):
        link_report(plain, mapping)
    alone = replace(mapping, fields=tuple(replace(f, refers=None) for f in mapping.fields))
    assert not [c for c in reconcile(persons, contacts, alone, crosswalks=walks).columns if c.startswith("lnk_")]


def test_a_run_over_all_objects_passes_crosswalks_on(spark, linked, tmp_path, rows):
    companies, persons, contacts = linked
    legacy = {"companies": spark.createDataFrame([(1, "A"), (2, "B")], "Comp_CompanyId long, Comp_Name string"), "contacts": persons}
    run = lambda part: reconcile_all(spark, {**legacy, "contacts": part}, {"companies": companies, "contacts": contacts}, str(tmp_path), "2024-01-01")
    stats = run(persons)
    assert stats["contacts"]["unresolved_links"] == 1 and stats["contacts"]["conflicts"] == 2 and "error" not in stats["companies"]
    lost = spark.read.parquet(f"{staging_path(str(tmp_path), 'contacts')}_unresolved")
    assert rows(lost) == [("contacts", "3", "associatedcompanyid", "9")]
    # A run of one row rewrites one bucket only.
    run(persons.where("Pers_PersonId = 2"))
    table = staging_path(str(tmp_path), "contacts")
    assert len(list((tmp_path / table.rpartition("/")[2] / "version=2").glob("bucket=*"))) == 1
    assert read_table(spark, table).count() == 5
