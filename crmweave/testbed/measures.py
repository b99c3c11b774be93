"""Queries: aggregates, Gold metrics, profiles and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from crmweave.crm.legacy import RELATIONSHIPS
from crmweave.crm.target import object_map, target_entity
from crmweave.functions.money import net_amount, weighted_forecast
from crmweave.operators import metrics, quality
from crmweave.operators.lookup import left_lookup
from crmweave.testbed.entities import CASE_SQL, COMPANY_SQL, OPPORTUNITY_SQL, PERSON_SQL, entity
from crmweave.testbed.registry import query
from crmweave.testbed.roles import base, role, roles

CASE_SECONDS = "CAST((epoch(Case_Closed) - epoch(Case_Opened)) AS BIGINT)"


def percent(part: str, whole: str) -> str:
    """Exact percentage, rounded half up."""
    return f"CAST(round(CAST(100 * {part} AS DECIMAL(24,6)) / nullif({whole}, 0), 2) AS DOUBLE)"


# --------------------------------------------------------------------------
# Aggregates

@query(
    "q_avg_days_to_close",
    f"""SELECT Case_Status, count(*) AS n,
               round(CAST(sum({CASE_SECONDS}) AS DOUBLE) / nullif(count({CASE_SECONDS}), 0) / 86400, 6)
                   AS avg_days_to_close
        FROM "case" GROUP BY Case_Status""",
    "case",
)
def _(spark, d):
    return metrics.mean_days_by(role(spark, d, "case"), "Case_Status", "Case_Opened", "Case_Closed")


@query(
    "q_closure_rate",
    f"""WITH totals AS (
            SELECT Case_PrimaryCompanyId, count(*) AS total_cases,
                   sum(CASE WHEN Case_Status = 'Closed' THEN 1 ELSE 0 END) AS closed
            FROM "case" GROUP BY Case_PrimaryCompanyId)
        SELECT Case_PrimaryCompanyId, total_cases, CAST(closed AS BIGINT) AS closed_cases,
               {percent("closed", "total_cases")} AS closure_rate, Comp_Name
        FROM totals JOIN company ON Case_PrimaryCompanyId = Comp_CompanyId""",
    "case", "company",
)
def closure_rate(spark, d):
    t = roles(spark, d, "case", "company")
    return metrics.closure_rate(
        t["case"], "Case_PrimaryCompanyId", "Case_Status", "Closed", t["company"], "Comp_CompanyId", "Comp_Name"
    )


LOG_SQL = """SELECT CASE WHEN value > 20 THEN 'update' ELSE 'match' END AS operation,
                    event_type AS entity_type,
                    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
                    ts AS "timestamp" FROM events"""


@query(
    "q_recent_log",
    f"""SELECT operation, entity_type, status, count(*) AS n FROM ({LOG_SQL}) AS log
        WHERE "timestamp" > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 36 HOUR
        GROUP BY operation, entity_type, status""",
)
def _(spark, d):
    log = base(spark, d, "events").select(
        F.when(F.col("value") > 20, "update").otherwise("match").alias("operation"),
        F.col("event_type").alias("entity_type"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("ts").alias("timestamp"),
    )
    return metrics.log_counts(log, "2024-01-30 12:00:00", hours=36)


@query(
    "q_forecast_totals",
    """SELECT count(*) AS n, CAST(sum(Oppo_Forecast) AS DOUBLE) AS total_forecast,
              CAST(sum(Oppo_Forecast * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2))) AS DOUBLE) AS weighted_total,
              CAST(sum(Oppo_Forecast - coalesce(oppo_cout, 0)) AS DOUBLE) AS net_total
       FROM opportunity""",
    "opportunity",
)
def _(spark, d):
    return metrics.totals(
        role(spark, d, "opportunity"),
        {
            "total_forecast": "Oppo_Forecast",
            "weighted_total": weighted_forecast("Oppo_Forecast", "Oppo_Certainty", "percent"),
            "net_total": net_amount("Oppo_Forecast", "oppo_cout", cost_default=0),
        },
    )


@query(
    "q_row_count",
    """SELECT 'companies' AS table_name, count(*) AS n, count(legacy_company_id) AS n_with_key FROM companies
       UNION ALL SELECT 'contacts', count(*), count(legacy_contact_id) FROM contacts
       UNION ALL SELECT 'deals', count(*), count(legacy_deal_id) FROM deals
       UNION ALL SELECT 'engagements', count(*), count(legacy_communication_id) FROM engagements""",
    "companies", "contacts", "deals", "engagements",
)
def _(spark, d):
    t = roles(spark, d, "companies", "contacts", "deals", "engagements")
    return metrics.row_counts({name: (df, target_entity(name).key) for name, df in t.items()})


@query(
    "q_table_counts",
    """SELECT 'companies' AS table_name, true AS present, count(*) AS n FROM companies
       UNION ALL SELECT 'deals', true, count(*) FROM deals
       UNION ALL SELECT 'tickets', false, NULL""",
    "companies", "deals",
)
def _(spark, d):
    return metrics.table_presence(roles(spark, d, "companies", "deals"), ["companies", "deals", "tickets"])


@query(
    "q_extract_stats",
    """WITH parts AS (
           SELECT 'Company' AS entity, count(*) AS extracted, count(DISTINCT Comp_CompanyId) AS added FROM company
           UNION ALL SELECT 'Opportunity', count(*), count(DISTINCT Oppo_OpportunityId) FROM opportunity
           UNION ALL SELECT 'SocialLink', count(*),
                            count(DISTINCT Related_TableID) + max(CASE WHEN Related_TableID IS NULL THEN 1 ELSE 0 END)
                     FROM social_link)
       SELECT entity, extracted, added, extracted - added AS duplicates_skipped FROM parts
       UNION ALL SELECT 'TOTAL', CAST(sum(extracted) AS BIGINT), CAST(sum(added) AS BIGINT),
                        CAST(sum(extracted - added) AS BIGINT) FROM parts""",
    "company", "opportunity", "social_link",
)
def _(spark, d):
    t = roles(spark, d, "company", "opportunity", "social_link")
    return metrics.extract_stats(
        {
            "Company": (t["company"], "Comp_CompanyId"),
            "Opportunity": (t["opportunity"], "Oppo_OpportunityId"),
            "SocialLink": (t["social_link"], "Related_TableID"),
        }
    )


# --------------------------------------------------------------------------
# Gold metrics

@query(
    "q_gold_resolution",
    f"""SELECT Case_Priority, count(*) AS closed_cases,
               round(CAST(sum({CASE_SECONDS}) AS DOUBLE) / count(*) / 86400, 6) AS avg_days,
               round(CAST(min({CASE_SECONDS}) AS DOUBLE) / 86400, 6) AS min_days,
               round(CAST(max({CASE_SECONDS}) AS DOUBLE) / 86400, 6) AS max_days
        FROM "case" WHERE Case_Closed IS NOT NULL GROUP BY Case_Priority""",
    "case",
)
def _(spark, d):
    return metrics.resolution_by(role(spark, d, "case"), "Case_Priority", "Case_Opened", "Case_Closed")


@query(
    "q_gold_status_by_company",
    """SELECT Case_PrimaryCompanyId, count(*) AS total,
              count(CASE WHEN Case_Status = 'Open' THEN 1 END) AS open_cases,
              count(CASE WHEN Case_Status = 'Pending' THEN 1 END) AS pending_cases,
              count(CASE WHEN Case_Status = 'Closed' THEN 1 END) AS closed_cases
       FROM "case" GROUP BY Case_PrimaryCompanyId""",
    "case",
)
def _(spark, d):
    return metrics.status_by(
        role(spark, d, "case"), "Case_PrimaryCompanyId", "Case_Status",
        {"open_cases": "Open", "pending_cases": "Pending", "closed_cases": "Closed"},
    )


@query(
    "q_gold_priority",
    f"""SELECT Case_Priority, count(*) AS n, {percent("count(*)", '(SELECT count(*) FROM "case")')} AS percent
        FROM "case" GROUP BY Case_Priority""",
    "case",
)
def _(spark, d):
    return metrics.distribution(role(spark, d, "case"), "Case_Priority")


@query(
    "q_gold_sla",
    f"""WITH done AS (
            SELECT Case_Priority, {CASE_SECONDS} AS seconds,
                   CASE Case_Priority WHEN 'High' THEN 20 WHEN 'Medium' THEN 40 WHEN 'Low' THEN 60 END AS days
            FROM "case" WHERE Case_Closed IS NOT NULL)
        SELECT Case_Priority, count(*) AS closed_cases,
               count(CASE WHEN seconds <= days * 86400 THEN 1 END) AS within_target,
               {percent("count(CASE WHEN seconds <= days * 86400 THEN 1 END)", "count(*)")} AS sla_percent
        FROM done GROUP BY Case_Priority""",
    "case",
)
def _(spark, d):
    return metrics.sla_share(
        role(spark, d, "case"), "Case_Priority", "Case_Opened", "Case_Closed", {"High": 20, "Medium": 40, "Low": 60}
    )


# --------------------------------------------------------------------------
# Profiles and checks

def _union(parts):
    return " UNION ALL ".join(parts)


NULL_COLUMNS = (
    "Oppo_OpportunityId", "Oppo_PrimaryPersonId", "oppo_cout", "Company_Name", "Person_LastName",
    "Person_EmailAddress", "Net_Amount",
)


@query(
    "q_null_profile",
    f"WITH o AS ({OPPORTUNITY_SQL}) "
    + _union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS rows FROM o"
        for c in NULL_COLUMNS
    ),
    "opportunity", "company", "person",
)
def _(spark, d):
    return quality.null_profile(entity("Opportunity", "opportunity", "company", "person")(spark, d), NULL_COLUMNS)


@query(
    "q_id_profile",
    """SELECT count(*) AS total, count(legacy_company_id) AS non_null,
              count(*) - count(legacy_company_id) AS nulls, count(DISTINCT legacy_company_id) AS unique_ids
       FROM companies""",
    "companies",
)
def _(spark, d):
    return quality.id_profile(role(spark, d, "companies"), "legacy_company_id")


COMPANY_COLUMNS = (
    "Comp_CompanyId", "Comp_PrimaryPersonId", "Comp_PrimaryAddressId", "Comp_Name", "Comp_Type", "Comp_Status",
    "Comp_Territory", "Comp_Sector", "Comp_Revenue", "Comp_WebSite", "Comp_EmailAddress", "Comp_PhoneNumber",
)


@query(
    "q_column_profile",
    _union(
        f"""SELECT '{c}' AS column_name, {i} AS ordinal, count(*) - count({c}) AS null_count,
                   count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS STRING) AS min_value,
                   CAST(max({c}) AS STRING) AS max_value, count(*) AS rows FROM company"""
        for i, c in enumerate(COMPANY_COLUMNS, 1)
    ),
    "company",
)
def _(spark, d):
    return quality.column_profile(role(spark, d, "company"), approximate=False).drop("data_type", "nullable")


@query(
    "q_find_columns",
    _union(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS filled,
                   {percent(f"count({c})", "count(*)")} AS percent FROM x"""
        for c in ("Pers_EmailAddress", "Pers_PhoneNumber")
    ).join((f"WITH x AS ({PERSON_SQL}) ", "")),
    "person", "company", "address",
)
def _(spark, d):
    return quality.find_columns(entity("Person", "person", "company", "address")(spark, d))


def _fk_sql(child, column, parent, key, where="TRUE"):
    quoted = '"case"' if child == "case" else child
    return f"""
        SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, '{key}' AS parent_key,
               (SELECT count(*) FROM {quoted} WHERE {where}) AS rows,
               (SELECT count(*) FROM {quoted} WHERE {where} AND {column} IS NULL) AS null_keys,
               (SELECT count(*) FROM {quoted} WHERE {where} AND {column} IS NOT NULL
                    AND NOT EXISTS (SELECT 1 FROM {'"case"' if parent == "case" else parent} WHERE {key} = {column})) AS orphans,
               CASE WHEN (SELECT max(n) FROM (SELECT count(*) AS n FROM {quoted}
                    WHERE {where} AND {column} IS NOT NULL GROUP BY {column}) AS g) > 1
                    THEN 'many:1' ELSE '1:1' END AS cardinality"""


_FK_TABLES = ("address", "company", "person", "opportunity", "case", "communication", "social_link")


@query(
    "q_fk_check",
    _union(
        _fk_sql(
            r.child, r.column, r.parent, r.key,
            f"{r.kind[0]} = {r.kind[1]}" if r.kind else "TRUE",
        )
        for r in RELATIONSHIPS
    ),
    *_FK_TABLES,
)
def _(spark, d):
    return quality.check_relationships(roles(spark, d, *_FK_TABLES), RELATIONSHIPS)


@query(
    "q_pk_check",
    """SELECT 'company' AS table_name, 'Comp_CompanyId' AS key_column, count(*) AS rows,
              count(Comp_CompanyId) AS non_null, count(DISTINCT Comp_CompanyId) AS unique_keys,
              count(*) = count(DISTINCT Comp_CompanyId) AS is_key FROM company
       UNION ALL
       SELECT 'lineitem', 'l_orderkey', count(*), count(l_orderkey), count(DISTINCT l_orderkey),
              count(*) = count(DISTINCT l_orderkey) FROM lineitem""",
    "company",
)
def _(spark, d):
    return quality.check_key(role(spark, d, "company"), "company", "Comp_CompanyId").unionByName(
        quality.check_key(base(spark, d, "lineitem"), "lineitem", "l_orderkey")
    )


@query(
    "q_linkage_report",
    f"""WITH p AS ({PERSON_SQL}), o AS ({OPPORTUNITY_SQL}), c AS ({COMPANY_SQL}), k AS ({CASE_SQL})
        SELECT 'Person' AS entity, 'Pers_CompanyId' AS key_column, 'Company_Name' AS looked_up, count(*) AS rows,
               count(Pers_CompanyId) AS with_key, count(Company_Name) AS resolved,
               count(CASE WHEN Pers_CompanyId IS NOT NULL AND Company_Name IS NULL THEN 1 END) AS orphans FROM p
        UNION ALL
        SELECT 'Person', 'Pers_PrimaryAddressId', 'Address_City', count(*), count(Pers_PrimaryAddressId),
               count(Address_City),
               count(CASE WHEN Pers_PrimaryAddressId IS NOT NULL AND Address_City IS NULL THEN 1 END)
        FROM p
        UNION ALL
        SELECT 'Opportunity', 'Oppo_PrimaryPersonId', 'Person_FirstName', count(*), count(Oppo_PrimaryPersonId),
               count(Person_FirstName),
               count(CASE WHEN Oppo_PrimaryPersonId IS NOT NULL AND Person_FirstName IS NULL THEN 1 END)
        FROM o
        UNION ALL
        SELECT 'Company', 'Comp_PrimaryAddressId', 'Address_City', count(*), count(Comp_PrimaryAddressId),
               count(Address_City),
               count(CASE WHEN Comp_PrimaryAddressId IS NOT NULL AND Address_City IS NULL THEN 1 END)
        FROM c
        UNION ALL
        SELECT 'Case', 'Case_PrimaryCompanyId', 'Company_Name', count(*), count(Case_PrimaryCompanyId),
               count(Company_Name),
               count(CASE WHEN Case_PrimaryCompanyId IS NOT NULL AND Company_Name IS NULL THEN 1 END)
        FROM k
        UNION ALL
        SELECT 'Case', 'Case_PrimaryPersonId', 'Person_FirstName', count(*), count(Case_PrimaryPersonId),
               count(Person_FirstName),
               count(CASE WHEN Case_PrimaryPersonId IS NOT NULL AND Person_FirstName IS NULL THEN 1 END)
        FROM k
        UNION ALL
        SELECT 'Communication', 'Comm_CaseId', 'Case_Description', count(*), count(Comm_CaseId), count(Case_Description),
               count(CASE WHEN Comm_CaseId IS NOT NULL AND Case_Description IS NULL THEN 1 END)
        FROM (SELECT Comm_CaseId, Case_Description FROM communication LEFT JOIN "case" ON Comm_CaseId = Case_CaseId) AS m""",
    "person", "company", "address", "opportunity", "case", "email_link", "communication",
)
def _(spark, d):
    entities = {
        "Person": entity("Person", "person", "company", "address")(spark, d),
        "Opportunity": entity("Opportunity", "opportunity", "company", "person")(spark, d),
        "Company": entity("Company", "company", "address")(spark, d),
        "Case": entity("Case", "case", "company", "person", "email_link")(spark, d),
        "Communication": left_lookup(
            role(spark, d, "communication"), role(spark, d, "case"), [("Comm_CaseId", "Case_CaseId")],
            {"Case_Description": "Case_Description"},
        ),
    }
    return quality.linkage_report(
        entities,
        [
            ("Person", "Pers_CompanyId", "Company_Name"),
            ("Person", "Pers_PrimaryAddressId", "Address_City"),
            ("Opportunity", "Oppo_PrimaryPersonId", "Person_FirstName"),
            ("Company", "Comp_PrimaryAddressId", "Address_City"),
            ("Case", "Case_PrimaryCompanyId", "Company_Name"),
            ("Case", "Case_PrimaryPersonId", "Person_FirstName"),
            ("Communication", "Comm_CaseId", "Case_Description"),
        ],
    )


@query(
    "q_fanout_check",
    """WITH after AS (SELECT 1 FROM company LEFT JOIN phone_link ON Comp_CompanyId = PLink_RecordId),
            n AS (SELECT (SELECT count(*) FROM company) AS b, (SELECT count(*) FROM after) AS a)
       SELECT b AS rows_before, a AS rows_after,
              CAST(round(CAST(a AS DECIMAL(24,8)) / b, 4) AS DOUBLE) AS ratio, a > b AS fans_out FROM n""",
    "company", "phone_link",
)
def _(spark, d):
    t = roles(spark, d, "company", "phone_link")
    companies = t["company"].select("Comp_CompanyId")
    after = left_lookup(
        companies, t["phone_link"], [("Comp_CompanyId", "PLink_RecordId")], {"Phone": "Phon_FullNumber"}
    )
    return quality.fan_out(companies, after)


@query(
    "q_validate_columns",
    """SELECT false AS is_valid, 18 AS expected_count, 8 AS actual_count,
              'closedate,company,deal_brand,deal_certainty,deal_notes,deal_priority,' ||
              'deal_source,deal_status,dealtype,hs_lastmodifieddate,pipeline' AS missing_columns,
              'score' AS extra_columns, count(*) AS row_count FROM deals""",
    "deals",
)
def _(spark, d):
    deals = role(spark, d, "deals").withColumn("score", F.lit(1))
    return quality.validate_columns(deals, target_entity("deals").base)


@query(
    "q_required_fields",
    """SELECT 'Pers_FirstName' AS legacy_column, 'firstname' AS target_property,
              count(CASE WHEN Pers_FirstName IS NULL OR trim(Pers_FirstName) = '' THEN 1 END) AS missing,
              count(*) AS rows FROM person
       UNION ALL
       SELECT 'Pers_LastName', 'lastname',
              count(CASE WHEN Pers_LastName IS NULL OR trim(Pers_LastName) = '' THEN 1 END), count(*) FROM person""",
    "person",
)
def _(spark, d):
    return quality.required_fields(role(spark, d, "person"), object_map("contacts"))


TYPED = ("Comp_Revenue", "Comp_Territory", "Comp_PhoneNumber", "Comp_Name")


def _type_sql(c):
    whole, dec, when = (
        f"count(CASE WHEN regexp_matches({c}, '{shape}') THEN 1 END)"
        for shape in (r"^[+-]?\d+$", r"^[+-]?\d+(\.\d+)?$", r"^\d{4}-\d{1,2}-\d{1,2}")
    )
    return f"""
        SELECT '{c}' AS column_name, count({c}) AS filled,
               {percent(whole, f"count({c})")} AS int_percent,
               {percent(dec, f"count({c})")} AS decimal_percent,
               {percent(when, f"count({c})")} AS datetime_percent,
               CASE WHEN {whole} = count({c}) THEN 'int' WHEN {dec} = count({c}) THEN 'decimal'
                    WHEN {when} = count({c}) THEN 'datetime' ELSE 'string' END AS suggested_type
        FROM company"""


@query("q_suggest_types", _union(_type_sql(c) for c in TYPED), "company")
def _(spark, d):
    return quality.suggest_types(role(spark, d, "company"), TYPED)
