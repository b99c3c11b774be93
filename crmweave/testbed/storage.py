"""Queries that write to the shared folder and read back: extraction, snapshots, loads, logs; and keys of other types."""

from __future__ import annotations

import uuid
from datetime import datetime
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crmweave.crm.target import object_map, target_entity
from crmweave.operators import reconcile
from crmweave.plans.extraction import extract_and_save, extract_entities
from crmweave.plans.increment import current_rows, extract_increment
from crmweave.plans.reconciliation import reconcile_all, staging_path
from crmweave.session import shared_folder
from crmweave.sources.landed import land_for_lookup, lookup_landed
from crmweave.sources.readers import quarantine, read_csv_checked
from crmweave.sources.tables import read_table
from crmweave.sources.writers import log_run, read_run_log, replace_table, write_all
from crmweave.testbed.matching import OBJECTS, joined_sql, legacy_deals
from crmweave.testbed.registry import query
from crmweave.testbed.roles import role, roles

WHEN = datetime(2024, 2, 1)


def folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


EXTRACTED = {
    "Address": ("address", "Addr_AddressId"), "Company": ("company", "Comp_CompanyId"),
    "Person": ("person", "Pers_PersonId"), "Opportunity": ("opportunity", "Oppo_OpportunityId"),
    "Case": ('"case"', "Case_CaseId"), "Communication": ("calendar", "Comm_CommunicationId"),
    "SocialNetwork": ("social_link", "nullif(sone_networklink, '')"),
}


@query(
    "q_extract_all",
    " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, 'success' AS status, count(k) AS extracted, count(DISTINCT k) AS added,
                   count(k) - count(DISTINCT k) AS duplicates_skipped, count(DISTINCT k) AS stored
            FROM (SELECT {key} AS k FROM {table}) AS x"""
        for entity, (table, key) in EXTRACTED.items()
    ),
    "address", "company", "person", "opportunity", "case", "calendar", "social_link", "email_link",
)
def _(spark, d):
    tables = roles(spark, d, "address", "company", "person", "opportunity", "case", "social_link", "email_link")
    tables["communication"] = role(spark, d, "calendar")
    results = extract_entities(tables, folder(spark, "extract"), WHEN)
    stored = None
    for r in results:
        back = spark.read.parquet(r.path) if r.path else spark.range(0)
        row = back.agg(F.count(F.lit(1)).alias("stored")).select(
            *(F.lit(v).alias(n) for n, v in (("entity", r.entity), ("status", r.status))),
            *(F.lit(v).cast("bigint").alias(n) for n, v in (
                ("extracted", r.extracted), ("added", r.added), ("duplicates_skipped", r.duplicates_skipped),
            )),
            "stored",
        )
        stored = row if stored is None else stored.unionByName(row)
    return stored


@query(
    "q_snapshot",
    """SELECT hs_object_id, dealname, legacy_deal_id, TIMESTAMP '2024-02-01 00:00:00' AS taken
       FROM deals WHERE legacy_deal_id IS NOT NULL""",
    "deals",
)
def _(spark, d):
    result = extract_and_save(role(spark, d, "deals"), target_entity("deals"), folder(spark, "snapshot"), WHEN)
    taken = result.path.rpartition("snapshot_ts=")[2]
    return spark.read.parquet(result.path).select(
        "hs_object_id", "dealname", "legacy_deal_id",
        F.to_timestamp(F.lit(taken), "yyyyMMdd_HHmmss").cast("timestamp_ntz").alias("taken"),
    )


@query(
    "q_replace_load",
    """SELECT Case_CaseId, Case_Status, CASE WHEN Case_Status = 'Closed' THEN 'Resolved' ELSE 'Open' END AS category
       FROM "case" WHERE FALSE
       UNION ALL SELECT Case_CaseId, Case_Status, NULL FROM "case" WHERE Case_Priority = 'High' """,
    "case",
)
def _(spark, d):
    table, path = f"loaded_{uuid.uuid4().hex}", folder(spark, "load")
    case = role(spark, d, "case").select("Case_CaseId", "Case_Status", "Case_Priority")
    replace_table(case.where("Case_Priority = 'Low'").select("Case_CaseId"), table, path)
    # The second load replaces the rows and the columns of the first.
    high = case.where("Case_Priority = 'High'")
    replace_table(high.select("Case_CaseId", "Case_Status", F.lit(None).cast("string").alias("category")), table, path)
    return spark.table(table)


@query(
    "q_run_log",
    """SELECT 'extract' AS operation, 'Company' AS entity_type, count(*) AS rows_read, count(*) AS rows_written, 'success' AS status FROM company
       UNION ALL SELECT 'extract', 'Person', count(*), count(*), 'success' FROM person
       UNION ALL SELECT 'extract', 'Address', count(*), count(*), 'success' FROM address
       UNION ALL SELECT 'reconcile', 'companies', count(*), count(*), 'success' FROM company
       UNION ALL SELECT 'reconcile', 'contacts', count(*), count(*), 'success' FROM person""",
    "company", "person", "address",
)
def _(spark, d):
    """The log of a run that extracts and reconciles; it is stored twice, as after a repeated run."""
    path, work = folder(spark, "log"), folder(spark, "logged")
    tables = roles(spark, d, "company", "person", "address")
    entries = [
        ("extract", r.entity, r.extracted, r.added, r.status, r.error, None)
        for r in extract_entities(tables, work, WHEN, names=["Company", "Person", "Address"])
    ]
    kinds = ("companies", "contacts")
    done = reconcile_all(spark, {k: OBJECTS[k]["legacy"](spark, d) for k in kinds}, roles(spark, d, *kinds), work, WHEN)
    for kind, stats in done.items():
        staged = read_table(spark, staging_path(work, kind)).count()
        entries.append(("reconcile", kind, stats["total"], staged, stats.get("status", "success"), stats.get("error"), None))
    for _ in range(2):
        log_run(spark, path, "first", WHEN, entries)
    return read_run_log(spark, path).where("day = DATE '2024-02-01' AND run = 'first'").select(
        "operation", "entity_type", "rows_read", "rows_written", "status"
    )


# Rows that change: a third comes later, every tenth of the others is edited, every seventeenth goes.
_BEFORE = "SELECT Comm_CommunicationId AS id, Comm_Subject AS subject, Comm_DateTime AS changed FROM communication WHERE Comm_CommunicationId % 3 <> 0"
_AFTER = """SELECT Comm_CommunicationId AS id,
           CASE WHEN Comm_CommunicationId % 3 <> 0 AND Comm_CommunicationId % 10 = 0 THEN 'edited' ELSE Comm_Subject END AS subject,
           CASE WHEN Comm_CommunicationId % 3 = 0 OR Comm_CommunicationId % 10 = 0 THEN Comm_DateTime + INTERVAL 4000 DAY
                ELSE Comm_DateTime END AS changed
    FROM communication WHERE Comm_CommunicationId % 17 <> 3"""


def _increments(spark, d):
    """Three runs: the first state, the same again, the second state."""
    path = folder(spark, "increment")
    states = [spark.sql(sql.replace("FROM communication", "FROM {c}"), c=role(spark, d, "communication")) for sql in (_BEFORE, _BEFORE, _AFTER)]
    return path, [extract_increment(state, path, ["id"], "changed") for state in states]


@query(
    "q_extract_increment",
    f"SELECT id, subject, changed, CASE WHEN id % 3 = 0 OR id % 10 = 0 THEN 3 ELSE 1 END AS run FROM ({_AFTER}) AS s",
    "communication",
)
def _(spark, d):
    path, _ = _increments(spark, d)
    return current_rows(spark, path, ["id"], "changed").withColumnRenamed("extract_run", "run").select("id", "subject", "changed", "run")


@query(
    "q_extract_increment_runs",
    f"""SELECT 1 AS run, count(*) AS written, 0::BIGINT AS deleted FROM ({_BEFORE}) AS b
        UNION ALL SELECT 2, 0, 0
        UNION ALL SELECT 3, (SELECT count(*) FROM ({_AFTER}) AS a WHERE id % 3 = 0 OR id % 10 = 0),
                         (SELECT count(*) FROM ({_BEFORE}) AS b WHERE id % 17 = 3)""",
    "communication",
)
def _(spark, d):
    path, runs = _increments(spark, d)
    parts = []
    for r in runs:
        rows, gone = (spark.read.parquet(f"{path}/{kind}/run={r.run}") for kind in ("rows", "deleted"))
        if (r.written, r.deleted) != (rows.count(), gone.count()):
            raise RuntimeError(f"run {r.run} counted {r.written} and {r.deleted} rows otherwise than it stored them")
        parts.append(
            rows.agg(F.lit(r.run).alias("run"), F.count("*").alias("written")).withColumn("deleted", gone.agg(F.count("*")).scalar())
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FAULTS = """CASE WHEN Comp_CompanyId % 7 = 0 THEN 'x' ELSE '' END || CAST(Comp_CompanyId AS STRING) || ',' ||
    '"' || Comp_Name || ', Ltd"' || CASE WHEN Comp_CompanyId % 13 = 0 THEN '' ELSE ',' ||
    CASE WHEN Comp_CompanyId % 11 = 0 THEN 'n/a' WHEN Comp_CompanyId % 5 = 0 THEN '' ELSE Comp_Revenue END || ',2024-02-' ||
    CASE WHEN Comp_CompanyId % 19 = 0 THEN '31' ELSE '01' END END AS line"""


def _checked_csv(spark, d):
    path = folder(spark, "faults")
    lines = role(spark, d, "company").selectExpr(_FAULTS)
    spark.createDataFrame([("id,name,revenue,day",)], "line string").unionByName(lines).coalesce(1).write.text(path)
    return read_csv_checked(spark, path, StructType.fromDDL("id BIGINT, name STRING, revenue DECIMAL(15,2), day DATE"))


@query(
    "q_csv_quarantine",
    """SELECT Comp_CompanyId AS id, Comp_Name || ', Ltd' AS name,
              CASE WHEN Comp_CompanyId % 5 <> 0 THEN CAST(Comp_Revenue AS DOUBLE) END AS revenue, DATE '2024-02-01' AS day
       FROM company WHERE Comp_CompanyId % 7 <> 0 AND Comp_CompanyId % 13 <> 0 AND Comp_CompanyId % 11 <> 0 AND Comp_CompanyId % 19 <> 0""",
    "company",
)
def _(spark, d):
    return _checked_csv(spark, d)[0]


@query(
    "q_csv_quarantine_reasons",
    """SELECT reason, count(*) AS records FROM (
           SELECT unnest(list_filter(CASE WHEN Comp_CompanyId % 13 = 0 THEN ['wrong number of fields'] ELSE [
               CASE WHEN Comp_CompanyId % 7 = 0 THEN 'id is no bigint' END,
               CASE WHEN Comp_CompanyId % 11 = 0 THEN 'revenue is no decimal(15,2)' END,
               CASE WHEN Comp_CompanyId % 19 = 0 THEN 'day is no date' END] END, lambda x: x IS NOT NULL)) AS reason
           FROM company) AS r GROUP BY reason""",
    "company",
)
def _(spark, d):
    return quarantine(_checked_csv(spark, d)[1], folder(spark, "quarantine"))


_LANDED: WeakKeyDictionary[SparkSession, dict[str, str]] = WeakKeyDictionary()


def landed_deals(spark, d) -> str:
    """Deals landed for lookups, once a session."""
    known = _LANDED.setdefault(spark, {})
    if d not in known:
        known[d] = folder(spark, "landed")
        land_for_lookup(role(spark, d, "deals"), known[d], "legacy_deal_id")
    return known[d]


@query(
    "q_lookup_landed",
    """SELECT hs_object_id, dealname, amount::DOUBLE AS amount FROM deals WHERE legacy_deal_id IN ('3', '70', '71', '1200')""",
    "deals",
)
def _(spark, d):
    return lookup_landed(spark, landed_deals(spark, d), [3, " 70.0 ", 71.0, "1200", "no such"]).select("hs_object_id", "dealname", "amount")


@query(
    "q_several_stores",
    " UNION ALL ".join(
        f"""SELECT '{store}' AS store, Comp_CompanyId, Comp_Name FROM company
            WHERE Comp_CompanyId % 3 <> 0""" for store in ("first", "second")
    ),
    "company",
)
def _(spark, d):
    company = role(spark, d, "company").select("Comp_CompanyId", "Comp_Name")
    paths = {s: folder(spark, f"store-{s}") for s in ("first", "second")}
    sinks = [lambda df, p=p: df.write.parquet(p) for p in paths.values()]
    write_all(company, sinks, company.where("Comp_CompanyId % 3 = 0"), ["Comp_CompanyId"])
    first, second = (
        spark.read.parquet(p).select(F.lit(s).alias("store"), "Comp_CompanyId", "Comp_Name") for s, p in paths.items()
    )
    return first.unionByName(second)


@query(
    "q_match_float_ids",
    """SELECT CAST(20000000 + Comp_CompanyId AS STRING) AS legacy_id, hs_object_id AS target_id
       FROM company JOIN companies ON hs_object_id - 1000000 = Comp_CompanyId""",
    "company", "companies",
)
def _(spark, d):
    legacy = role(spark, d, "company").withColumn("Comp_CompanyId", (F.col("Comp_CompanyId") + 20_000_000).cast("double"))
    target = role(spark, d, "companies").withColumn(
        "legacy_company_id", F.concat(F.lit(" "), (F.col("hs_object_id") + 19_000_000).cast("string"))
    )
    found = reconcile.match(legacy, target, object_map("companies"))
    return found.select(F.format_string("%.0f", "legacy_id").alias("legacy_id"), "target_id")


@query(
    "q_conflicts_deals",
    f"""SELECT legacy_id, target_id, 'deal_certainty' AS property FROM {joined_sql("deals")}
        WHERE target_id IS NOT NULL AND Oppo_Certainty <> CASE WHEN legacy_id % 7 = 0 THEN 5 ELSE Oppo_Certainty END""",
    *OBJECTS["deals"]["roles"],
)
def _(spark, d):
    # The target holds certainty as text, written in another way than the number.
    target = role(spark, d, "deals").alias("t").join(
        role(spark, d, "opportunity").select((F.col("Oppo_OpportunityId") + 3_000_000).alias("hs_object_id"), "Oppo_Certainty"),
        "hs_object_id",
    ).withColumn(
        "deal_certainty",
        F.when((F.col("hs_object_id") - 3_000_000) % 7 == 0, F.lit(" 5 ")).otherwise(F.col("Oppo_Certainty").cast("int").cast("string")),
    ).drop("Oppo_Certainty")
    found = reconcile.conflicts(reconcile.reconcile(legacy_deals(spark, d), target, object_map("deals")))
    return found.where("property = 'deal_certainty'")
