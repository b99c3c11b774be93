"""Queries over data that arrives in parts, profiles of parts united, and joins over several links."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmweave.crm.legacy import RELATIONSHIPS
from crmweave.functions.keys import canonical_key
from crmweave.operators.autojoin import auto_join
from crmweave.operators.profiles import profile_state, store_profile, united_profile
from crmweave.operators.quality import distinct_counts
from crmweave.sources.tables import read_table, upsert_table
from crmweave.streaming.upsert import upsert_arrivals
from crmweave.testbed.registry import query
from crmweave.testbed.roles import base, roles
from crmweave.testbed.storage import folder

# --------------------------------------------------------------------------
# Joins over several links

@query(
    "q_auto_join_path",
    """SELECT Comm_CommunicationId, Pers_LastName AS person_Pers_LastName, own.Comp_Name AS employer_Comp_Name,
              Addr_City AS employer_seat_Addr_City, direct.Comp_Name AS company_Comp_Name
       FROM communication LEFT JOIN person ON Comm_PersonId = Pers_PersonId
            LEFT JOIN company AS own ON Pers_CompanyId = own.Comp_CompanyId
            LEFT JOIN address ON own.Comp_PrimaryAddressId = Addr_AddressId
            LEFT JOIN company AS direct ON Comm_CompanyId = direct.Comp_CompanyId""",
    "communication", "person", "company", "address",
)
def _(spark, d):
    return auto_join(
        roles(spark, d, "communication", "person", "company", "address"), "communication",
        ["Comm_CommunicationId", "person.Pers_LastName", "employer.Comp_Name", "employer_seat.Addr_City", "company.Comp_Name"],
        RELATIONSHIPS,
        {
            "employer": ("Comm_PersonId", "Pers_CompanyId"),
            "employer_seat": ("Comm_PersonId", "Pers_CompanyId", "Comp_PrimaryAddressId"),
        },
    )


@query(
    "q_auto_join_kinds",
    """SELECT sone_networklink, company.Comp_Name AS company_Comp_Name, Pers_LastName AS person_Pers_LastName,
              own.Comp_Name AS employer_Comp_Name
       FROM social_link LEFT JOIN company ON Related_RecordID = Comp_CompanyId AND Related_TableID = 5
            LEFT JOIN person ON Related_RecordID = Pers_PersonId AND Related_TableID = 13
            LEFT JOIN company AS own ON Pers_CompanyId = own.Comp_CompanyId""",
    "social_link", "company", "person",
)
def _(spark, d):
    # The record id links to a company or a person by its kind, and a person leads on to the company it works for.
    return auto_join(
        roles(spark, d, "social_link", "company", "person"), "social_link",
        ["sone_networklink", "company.Comp_Name", "person.Pers_LastName", "employer.Comp_Name"], RELATIONSHIPS,
        {"employer": ("Related_RecordID", "Pers_CompanyId")},
    )


# --------------------------------------------------------------------------
# Profiles stored per load

PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
FEW = ("o_orderstatus", "o_orderpriority")  # whose values are few enough for exact counts


@query(
    "q_profile_merged",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT o_orderstatus) AS loads, count(*) AS "rows",
                   count(*) - count({c}) AS null_count, TRUE AS as_in_one_pass, TRUE AS near_exact,
                   {f"(SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c}))" if c in FEW else "CAST(NULL AS BIGINT)"}
                       AS top_count
            FROM orders WHERE o_orderstatus IS NOT NULL""" for c in PROFILED
    ),
)
def _(spark, d):
    orders, path = base(spark, d, "orders"), folder(spark, "profiles")
    for load in ("F", "F", "O", "P"):  # the first one arrives twice
        store_profile(orders.where(F.col("o_orderstatus") == load), path, load, PROFILED)
    merged = united_profile(spark.read.parquet(path))
    once = united_profile(profile_state(orders, "all", PROFILED)).select("column_name", F.col("distinct_count").alias("once"))
    exact = distinct_counts(orders, PROFILED).withColumnRenamed("distinct_count", "exact")
    error = 0.03  # several standard errors of either sketch
    return merged.join(once, "column_name").join(exact, "column_name").select(
        "column_name", "loads", "rows", "null_count",
        (F.abs(F.col("distinct_count") - F.col("once")) <= error * F.col("once")).alias("as_in_one_pass"),
        (F.abs(F.col("distinct_count") - F.col("exact")) <= error * F.col("exact")).alias("near_exact"),
        F.when(F.col("column_name").isin(*FEW), F.get("top_values", F.lit(0))["count"]).alias("top_count"),
    )


# --------------------------------------------------------------------------
# Streamed upserts

UPDATED = ("target_company_id", "status", "confidence", "seen")


@query(
    "q_stream_upsert",
    """WITH known AS (
           SELECT CAST(regexp_replace(trim(legacy_company_id), '\\.0$', '') AS BIGINT) AS legacy_company_id,
                  name AS legacy_name, hs_object_id AS target_company_id, 'pending' AS status, 50 AS confidence, 0 AS seen
           FROM companies WHERE legacy_company_id IS NOT NULL),
       arrived AS (
           SELECT Comp_CompanyId, Comp_Name, 'matched' AS status, 100 AS confidence, 1 AS seen FROM company WHERE Comp_Status = 'Active'
           UNION ALL SELECT Comp_CompanyId, Comp_Name, 'checked', 90, 2 FROM company WHERE Comp_Type = 'BUILDING'
           UNION ALL SELECT Comp_CompanyId, Comp_Name, 'final', 95, 3 FROM company WHERE Comp_Type = 'BUILDING' AND Comp_Status = 'Dormant'),
       last_of AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY Comp_CompanyId ORDER BY seen DESC) = 1)
       SELECT coalesce(k.legacy_company_id, Comp_CompanyId) AS legacy_company_id,
              CASE WHEN k.legacy_company_id IS NULL THEN Comp_Name ELSE legacy_name END AS legacy_name,
              coalesce(9000000 + Comp_CompanyId, k.target_company_id) AS target_company_id,
              coalesce(l.status, k.status) AS status, coalesce(l.confidence, k.confidence) AS confidence,
              coalesce(l.seen, k.seen) AS seen, CAST(0 AS BIGINT) AS changed_by_replay
       FROM known AS k FULL OUTER JOIN last_of AS l ON k.legacy_company_id = Comp_CompanyId""",
    "companies", "company",
)
def _(spark, d):
    t = roles(spark, d, "companies", "company")
    known = t["companies"].where(F.col("legacy_company_id").isNotNull()).select(
        canonical_key("legacy_company_id").cast("bigint").alias("legacy_company_id"), F.col("name").alias("legacy_name"),
        F.col("hs_object_id").alias("target_company_id"), F.lit("pending").alias("status"), F.lit(50).alias("confidence"),
        F.lit(0).alias("seen"),
    )
    place, files, keys = folder(spark, "streamed"), folder(spark, "arriving"), ["legacy_company_id"]
    upsert_table(spark, place, known, keys, UPDATED, buckets=16)

    def report(which: str, status: str, confidence: int, seen: int):
        return t["company"].where(which).select(
            F.col("Comp_CompanyId").alias("legacy_company_id"), F.col("Comp_Name").alias("legacy_name"),
            (F.col("Comp_CompanyId") + 9000000).alias("target_company_id"), F.lit(status).alias("status"),
            F.lit(confidence).alias("confidence"), F.lit(seen).alias("seen"),
        )

    def take_up(marks: str) -> None:
        upsert_arrivals(spark, files, known.schema, place, keys, UPDATED, "seen", marks, buckets=16).awaitTermination()

    marks = folder(spark, "marks")
    report("Comp_Status = 'Active'", "matched", 100, 1).write.mode("append").parquet(files)
    take_up(marks)
    report("Comp_Type = 'BUILDING'", "checked", 90, 2).unionByName(
        report("Comp_Type = 'BUILDING' AND Comp_Status = 'Dormant'", "final", 95, 3)
    ).write.mode("append").parquet(files)
    take_up(marks)
    before = read_table(spark, place)
    take_up(folder(spark, "marks"))  # without its marks, the stream takes up all files once more
    after = read_table(spark, place)
    columns = known.columns
    changed = after.select(columns).exceptAll(before.select(columns)).agg(F.count(F.lit(1)).alias("n")).scalar()
    return after.select(*columns).withColumn("changed_by_replay", changed)
