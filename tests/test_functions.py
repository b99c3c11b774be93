"""Worked examples and the rules for conflicting or careless semantics."""

from decimal import Decimal

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crmweave.crm.target import object_map
from crmweave.functions.columns import share
from crmweave.functions.dates import mean_days, newer_than
from crmweave.functions.keys import canonical_key
from crmweave.functions.money import (
    net_after_discount, net_amount, weighted_forecast, with_deal_amounts,
)
from crmweave.functions.names import conform, resolve_column, snake_name, with_snake_names
from crmweave.functions.payload import map_of, map_rows, payload_rows, update_map
from crmweave.functions.stages import entity_kind, entity_name, final_stage, priority_score, stage_number
from crmweave.functions.text import contains_ci, email_valid, joined, sanitize


def one(df):
    return df.collect()[0][0]


def test_deal_amounts_of_the_worked_example(spark, rows):
    deals = spark.sql(
        """SELECT * FROM VALUES (1, 100000.00, 0.8, 20000.00), (2, 50000.00, 0.5, 10000.00),
                                (3, 75000.00, 0.9, 15000.00) AS t(deal, amount, certainty, cost)"""
    )
    got = with_deal_amounts(deals).select(
        "deal", *(F.col(c).cast("double") for c in ("weighted_forecast", "net_amount", "net_weighted_amount"))
    )
    assert rows(got) == [
        (1, 80000.0, 80000.0, 64000.0), (2, 25000.0, 40000.0, 20000.0), (3, 67500.0, 60000.0, 54000.0),
    ]


def test_amount_is_taken_from_forecast_when_there_is_no_amount(spark):
    df = spark.sql("SELECT 10.00 AS forecast, 0.5 AS certainty, 4.00 AS cost")
    assert with_deal_amounts(df).first()["net_amount"] == Decimal("6.00")


def test_certainty_as_fraction_or_percent(spark):
    df = spark.sql("SELECT CAST(200 AS DECIMAL(15,2)) AS a, CAST(40 AS DECIMAL(5,2)) AS c")
    assert one(df.select(weighted_forecast("a", "c", "percent"))) == Decimal("80")
    assert one(df.select(weighted_forecast("a", "c"))) == Decimal("8000")
    with pytest.raises(ValueError):
        weighted_forecast("a", "c", "per mille")


def test_missing_cost_is_null_unless_a_default_is_given(spark):
    df = spark.sql("SELECT CAST(9 AS DECIMAL(15,2)) AS f, CAST(NULL AS DECIMAL(15,2)) AS c")
    assert one(df.select(net_amount("f", "c"))) is None
    assert one(df.select(net_amount("f", "c", cost_default=0))) == Decimal("9.00")


def test_discount_is_in_percent(spark):
    df = spark.sql("SELECT CAST(80 AS DECIMAL(15,2)) AS r, CAST(25 AS DECIMAL(5,2)) AS d")
    assert one(df.select(net_after_discount("r", "d"))) == Decimal("60")


def test_stages(spark, rows):
    df = spark.createDataFrame(
        [("01 - Identification", "Perdue"), ("05 - Négociations", "Gagnée"), ("06 - x", "?"), (None, None)],
        "stage STRING, outcome STRING",
    )
    assert rows(df.select(stage_number("stage"), final_stage("outcome"))) == [
        (0, "Unknown"), (0, "Unknown"), (1, "Closed Lost"), (5, "Closed Won"),
    ]


def test_priority_and_kind(spark, rows):
    df = spark.createDataFrame([("High", 5), ("Medium", 13), (None, 6)], "p STRING, k INT")
    assert rows(df.select(priority_score("p"), entity_kind("k"))) == [
        (1, "Company"), (2, "Person"), (3, "Unknown"),
    ]


def test_joining_text_treats_null_as_empty(spark, rows):
    df = spark.createDataFrame([("Ann", None), (None, "Lee"), (None, None)], "a STRING, b STRING")
    assert rows(df.select(joined("a", "b"))) == [(" ",), (" Lee",), ("Ann ",)]


def test_entity_name_follows_the_kind(spark, rows):
    df = spark.createDataFrame([(5, "Acme", None, None), (13, None, "Ann", None), (7, "x", "y", "z")],
                               "k INT, c STRING, f STRING, l STRING")
    assert rows(df.select(entity_name("k", "c", "f", "l"))) == [("Acme",), ("Ann ",), ("Unknown",)]


def test_sanitize_touches_text_only(spark):
    df = spark.createDataFrame([("a\uf02db \uf0a7 c", 1)], "t STRING, n INT")
    assert sanitize(df).first() == ("a-b * c", 1)
    assert sanitize(df).schema == df.schema


@pytest.mark.parametrize("raw,expected", [("123.0", "123"), (" 7 ", "7"), ("10", "10"), ("", None), (None, None), ("1.05", "1.05")])
def test_canonical_key(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "k STRING")
    assert one(df.select(canonical_key("k"))) == expected


def test_canonical_key_of_numbers(spark):
    df = spark.sql("SELECT CAST(123 AS DOUBLE) AS d, 123 AS i")
    assert df.select(canonical_key("d"), canonical_key("i")).first() == ("123", "123")


def test_contains_takes_wildcards_literally(spark, rows):
    df = spark.createDataFrame([("100% Wool",), ("1000 Wool",)], "t STRING")
    assert rows(df.where(contains_ci("t", "0% w"))) == [("100% Wool",)]


def test_email_valid(spark, rows):
    df = spark.createDataFrame([("a@b.co",), ("a@b",), ("a b@c.de",), (None,)], "e STRING")
    assert rows(df.select("e", email_valid("e"))) == [
        ("a b@c.de", False), ("a@b", False), ("a@b.co", True), (None, False),
    ]


def test_mean_days_ignores_open_rows(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-02 12:00:00'),
                                (TIMESTAMP_NTZ '2024-01-01 00:00:00', NULL) AS t(o, c)"""
    )
    assert one(df.agg(mean_days("o", "c"))) == 1.5
    assert one(df.where("c IS NULL").agg(mean_days("o", "c"))) is None


def test_moving_filters(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-29 10:00:00' AS t")
    assert df.where(newer_than("t", "2024-02-29 10:30:00", hours=1)).count() == 1
    assert df.where(newer_than("t", "2024-02-29 11:00:00", hours=1)).count() == 0
    assert df.where(newer_than("t", "2024-08-29 09:00:00", months=6)).count() == 1


def test_share_of_nothing_is_null(spark):
    df = spark.range(1)
    assert one(df.select(share(F.lit(1), F.lit(0)))) is None
    assert one(df.select(share(F.lit(1), F.lit(3)))) == Decimal("33.33")


def test_snake_names():
    assert snake_name("[Case_CaseId]") == "case_id"
    assert snake_name("Company_Name") == "company_name"
    assert snake_name("Addr_PostCode") == "addr_post_code"
    assert snake_name("Case_SLAStatus") == "case_sla_status"
    assert snake_name("Addr_Address1") == "addr_address1"


def test_snake_names_must_stay_distinct(spark):
    with pytest.raises(ValueError):
        with_snake_names(spark.sql("SELECT 1 AS Case_CaseId, 2 AS case_id"))


def test_resolver_finds_prefixed_columns():
    columns = ["Case_CaseId", "Case_Status", "Case_Opened", "COMPANY_NAME"]
    assert [resolve_column(n, columns) for n in ("case_id", "status", "opened", "company_name", "nothing")] == [
        "Case_CaseId", "Case_Status", "Case_Opened", "COMPANY_NAME", None,
    ]


def test_conform_types_missing_columns(spark):
    got = conform(spark.sql("SELECT '7' AS Case_CaseId"), StructType.fromDDL("case_id BIGINT, status STRING"))
    assert got.first() == (7, None)
    assert got.dtypes == [("case_id", "bigint"), ("status", "string")]


def test_payload_skips_null_blank_and_nan(spark, rows):
    legacy = spark.createDataFrame(
        [(1, "Acme", "", float("nan")), (2, "NaN", "acme.com", 5.0)],
        "Comp_CompanyId INT, Comp_Name STRING, Comp_WebSite STRING, Comp_Revenue DOUBLE",
    )
    df = legacy.select(
        "Comp_CompanyId", F.to_json(update_map(legacy.schema, object_map("companies"))).alias("p")
    )
    assert rows(payload_rows(df, "Comp_CompanyId", "p")) == [
        (1, "name", "Acme"), (2, "annualrevenue", "5.0"), (2, "domain", "acme.com"), (2, "name", "NaN"),
        (2, "website", "acme.com"),
    ]


def test_maps_are_made_once_and_unfolded_whole(spark, rows):
    df = spark.range(1, 4).selectExpr("id", "CASE id WHEN 1 THEN 'x' END AS a", "CASE id WHEN 1 THEN '' WHEN 2 THEN 'y' END AS b")
    entries = [("a", F.col("a")), ("b", F.col("b"))]
    made = df.select("id", map_of(entries, Column.isNotNull).alias("m"), map_of(entries, lambda v: v != "").alias("filled"))
    assert rows(map_rows(made, "m", "id")) == [(1, "a", "x"), (1, "b", ""), (2, "b", "y")]
    assert rows(map_rows(made, "filled", "id")) == [(1, "a", "x"), (2, "b", "y")]
    assert [len(r.m) for r in made.orderBy("id").collect()] == [2, 1, 0]
    plan = map_rows(made, "m", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_concat(") == 1 and "size(" not in plan
    with pytest.raises(ValueError, match="two entries"):
        map_of([*entries, ("a", F.col("b"))], Column.isNotNull)


def test_updates_are_mapped_without_a_function_per_entry(spark):
    legacy = spark.sql("SELECT 123 AS Comp_CompanyId, 'ACME Corp' AS Comp_Name, '' AS Comp_WebSite")
    plan = legacy.select(update_map(legacy.schema, object_map("companies")).alias("m"))._jdf.queryExecution().analyzed().toString()
    assert "lambda" not in plan
