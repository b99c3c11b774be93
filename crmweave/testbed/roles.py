"""CRM tables derived from the generic test tables.

The derivations are plain SQL that Spark and the checking engine both read, so a
query and its check start from the same rows.  They are test data, not operators.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events", "documents")

# Per role: the SQL, and the roles it reads besides base tables.
ROLE_SQL = {
    # Legacy system.  One address per company and per person.
    "address": """
        SELECT c_custkey * 2 AS Addr_AddressId, c_custkey AS Addr_CompanyId,
               CAST(NULL AS BIGINT) AS Addr_PersonId, 'Billing' AS Addr_Type,
               'Building ' || CAST(c_custkey AS STRING) AS Addr_Address1,
               n_name AS Addr_City, r_name AS Addr_Country,
               CAST(10000 + n_nationkey AS STRING) AS Addr_PostCode
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT s_suppkey * 2 + 1, CAST(NULL AS BIGINT), s_suppkey, 'Office',
               'Floor ' || CAST(s_suppkey AS STRING), n_name, r_name, CAST(20000 + n_nationkey AS STRING)
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "company": """
        SELECT c_custkey AS Comp_CompanyId, c_custkey AS Comp_PrimaryPersonId,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey * 2 END AS Comp_PrimaryAddressId,
               c_name AS Comp_Name, c_mktsegment AS Comp_Type,
               CASE WHEN c_acctbal < 0 THEN 'Dormant' ELSE 'Active' END AS Comp_Status,
               CAST(c_nationkey AS STRING) AS Comp_Territory, lower(c_mktsegment) AS Comp_Sector,
               CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING) AS Comp_Revenue,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
                    ELSE 'www.' || lower(replace(c_name, '#', '-')) || '.example' END AS Comp_WebSite,
               'info@' || lower(replace(c_name, '#', '-')) || '.example' AS Comp_EmailAddress,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '04' || CAST(c_custkey AS STRING) END
                   AS Comp_PhoneNumber
        FROM customer""",
    "person": """
        SELECT s_suppkey AS Pers_PersonId,
               CASE WHEN s_acctbal < 500 THEN NULL ELSE s_suppkey END AS Pers_CompanyId,
               s_suppkey * 2 + 1 AS Pers_PrimaryAddressId,
               substr(s_name, 1, 8) AS Pers_FirstName,
               CASE WHEN s_acctbal < 0 THEN NULL ELSE substr(s_name, 10) END AS Pers_LastName,
               CASE WHEN s_acctbal < 2000 THEN NULL
                    ELSE 'p' || CAST(s_suppkey AS STRING) || '@mail.example' END AS Pers_EmailAddress,
               '06' || CAST(s_suppkey AS STRING) AS Pers_PhoneNumber,
               CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS Pers_Status,
               CAST(s_nationkey AS STRING) AS Pers_Territory
        FROM supplier""",
    "opportunity": """
        SELECT o_orderkey AS Oppo_OpportunityId,
               'Order ' || CAST(o_orderkey AS STRING) AS Oppo_Description,
               o_custkey AS Oppo_PrimaryCompanyId,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS Oppo_PrimaryPersonId,
               CASE o_orderstatus WHEN 'F' THEN 'Gagnée' WHEN 'P' THEN 'Perdue' WHEN 'O' THEN 'En cours' END
                   AS Oppo_Status,
               '0' || substr(o_orderpriority, 1, 1) || ' - ' || substr(o_orderpriority, 3) AS Oppo_Stage,
               o_orderpriority AS Oppo_Priority,
               CAST(o_totalprice AS DECIMAL(15,2)) AS Oppo_Forecast,
               CAST(100 - 20 * CAST(substr(o_orderpriority, 1, 1) AS INT) AS DECIMAL(5,2)) AS Oppo_Certainty,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE CAST(floor(o_totalprice * 0.25) AS DECIMAL(15,2)) END AS oppo_cout,
               CAST(o_totalprice AS DECIMAL(15,2)) AS Oppo_EstimatedRevenue,
               CAST(5 * CAST(substr(o_orderpriority, 1, 1) AS INT) AS DECIMAL(5,2)) AS Oppo_DiscountPercent,
               o_orderdate AS Oppo_CreatedDate, o_orderdate + INTERVAL 30 DAY AS Oppo_TargetClose
        FROM orders""",
    "case": """
        SELECT o_orderkey AS Case_CaseId, o_custkey AS Case_PrimaryCompanyId,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS Case_PrimaryPersonId,
               'Order ' || CAST(o_orderkey AS STRING) AS Case_Description,
               CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS Case_Status,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS Case_Priority,
               o_orderdate AS Case_Opened,
               CASE WHEN o_orderstatus = 'F' THEN last_ship END AS Case_Closed
        FROM orders LEFT JOIN
             (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) AS shipped
             ON o_orderkey = l_orderkey""",
    "communication": """
        SELECT event_id AS Comm_CommunicationId, user_id AS Comm_CompanyId,
               CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS Comm_PersonId,
               event_id AS Comm_OpportunityId,
               CASE WHEN event_type = 'click' THEN event_id END AS Comm_CaseId,
               event_type AS Comm_Type,
               CASE WHEN value > 20 THEN 'Outbound' ELSE 'Inbound' END AS Comm_Action,
               CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Complete' END AS Comm_Status,
               CASE WHEN value > 50 THEN 'High' WHEN value > 10 THEN 'Medium' ELSE 'Low' END AS Comm_Priority,
               event_type || ' ' || CAST(event_id AS STRING) AS Comm_Subject, props AS Comm_Note,
               ts AS Comm_DateTime, ts AS Comm_OriginalDateTime
        FROM events""",
    # The calendar view of communications arrives joined already.
    "calendar": """
        SELECT communication.*, Pers_PersonId, Pers_FirstName, Pers_LastName, Pers_EmailAddress,
               Comp_CompanyId, Comp_Name
        FROM communication LEFT JOIN person ON Comm_PersonId = Pers_PersonId
             LEFT JOIN company ON Comm_CompanyId = Comp_CompanyId""",
    "social_link": """
        SELECT CASE WHEN event_type = 'error' THEN ''
                    ELSE 'https://social.example/' || CAST(event_id AS STRING) END AS sone_networklink,
               CASE event_type WHEN 'click' THEN 5 WHEN 'view' THEN 13 WHEN 'signup' THEN 13
                    WHEN 'purchase' THEN 7 END AS Related_TableID,
               user_id AS Related_RecordID, event_type AS network_type, event_type AS bord_caption,
               ts AS CreatedDate
        FROM events""",
    "social_network": """
        SELECT event_id AS SoN_SocialNetworkId, event_type AS SoN_Platform,
               'https://social.example/' || CAST(event_id AS STRING) AS SoN_ProfileURL,
               user_id AS SoN_PersonId, ts AS SoN_CreatedDate
        FROM events""",
    "phone_link": """
        SELECT event_id AS Phon_PhoneId, user_id AS PLink_RecordId,
               CASE event_type WHEN 'click' THEN 'Business' WHEN 'view' THEN 'Mobile' WHEN 'signup' THEN 'Home'
                    WHEN 'purchase' THEN 'Fax' ELSE 'Other' END AS PLink_Type,
               '04 ' || CAST(1000000 + event_id AS STRING) AS Phon_FullNumber
        FROM events""",
    "email_link": """
        SELECT event_id AS Emai_EmailId, user_id AS ELink_RecordID,
               CASE WHEN event_type = 'click' THEN 'Business' ELSE 'Personal' END AS ELink_Type,
               CASE event_type WHEN 'click' THEN 5 WHEN 'view' THEN 13 WHEN 'signup' THEN 6 ELSE 7 END
                   AS ELink_EntityID,
               CASE WHEN event_type = 'error' THEN 'unknown at ' || CAST(event_id AS STRING)
                    ELSE 'u' || CAST(event_id AS STRING) || '@mail.example' END AS Emai_EmailAddress
        FROM events""",
    # Target system: one segment is not migrated, one has lost its crosswalk ids, ids
    # of some nations went through a float, and debtors were renamed.
    "companies": """
        SELECT 1000000 + c_custkey AS hs_object_id,
               CASE WHEN c_acctbal < 0 THEN c_name || ' SA' ELSE c_name END AS name,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
                    ELSE 'www.' || lower(replace(c_name, '#', '-')) || '.example' END AS domain,
               c_mktsegment AS type, lower(c_mktsegment) AS industry, n_name AS city, r_name AS country,
               CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING) AS annualrevenue,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
                    WHEN n_regionkey = 0 THEN ' ' || CAST(c_custkey AS STRING) || '.0'
                    ELSE CAST(c_custkey AS STRING) END AS legacy_company_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_mktsegment <> 'MACHINERY'""",
    "contacts": """
        SELECT 2000000 + s_suppkey AS hs_object_id, substr(s_name, 1, 8) AS firstname,
               CASE WHEN s_nationkey > 20 THEN 'Renamed' ELSE substr(s_name, 10) END AS lastname,
               'p' || CAST(s_suppkey AS STRING) || '@mail.example' AS email,
               CASE WHEN s_nationkey < 3 THEN 'Former owner' ELSE 'Customer#' || substr(s_name, 10) END
                   AS company,
               s_suppkey AS associatedcompanyid, n_name AS city, r_name AS country,
               CASE WHEN s_acctbal > 9000 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS legacy_contact_id,
               CASE WHEN s_acctbal > 7000 THEN CAST(s_suppkey AS STRING) END AS legacy_company_id,
               CAST(NULL AS STRING) AS legacy_deal_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE s_acctbal > -500""",
    "deals": """
        SELECT 3000000 + o_orderkey AS hs_object_id,
               'Order ' || CAST(o_orderkey AS STRING) AS dealname,
               CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(15,2)) + 1
                    ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS amount,
               '0' || substr(o_orderpriority, 1, 1) || ' - ' || substr(o_orderpriority, 3) AS dealstage,
               o_orderdate AS createdate, o_custkey AS associatedcompanyid,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey AS STRING) END
                   AS legacy_deal_id
        FROM orders WHERE o_orderstatus <> 'P'""",
    "engagements": """
        SELECT 4000000 + event_id AS hs_object_id, event_type AS hs_engagement_type, ts AS hs_timestamp,
               CASE WHEN value > 100 THEN 'edited' ELSE event_type || ' ' || CAST(event_id AS STRING) END
                   AS hs_engagement_subject,
               props AS hs_note_body, user_id AS associated_company_id, user_id AS associated_contact_id,
               CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id AS STRING) END
                   AS legacy_communication_id
        FROM events WHERE event_type <> 'error'""",
    # The same objects linked to each other by ids of the target system; some links are wrong or missing.
    "linked_contacts": """
        SELECT hs_object_id, firstname, lastname, email, company,
               CASE WHEN associatedcompanyid % 5 = 0 THEN 1000001 + associatedcompanyid
                    ELSE 1000000 + associatedcompanyid END AS associatedcompanyid,
               city, country, legacy_contact_id
        FROM contacts""",
    "linked_deals": """
        SELECT hs_object_id, dealname, amount, dealstage, createdate,
               CASE WHEN associatedcompanyid % 7 <> 0 THEN 1000000 + associatedcompanyid END AS associatedcompanyid,
               CASE WHEN associatedcompanyid % 3 <> 0 THEN 2000000 + associatedcompanyid END AS primary_contact_id,
               legacy_deal_id
        FROM deals""",
    "linked_engagements": """
        SELECT hs_object_id, hs_engagement_type, hs_timestamp, hs_engagement_subject, hs_note_body,
               1000000 + associated_company_id AS associated_company_id,
               2000000 + associated_contact_id AS associated_contact_id,
               CASE WHEN hs_object_id % 4 <> 0 THEN hs_object_id - 1000000 END AS associated_deal_id,
               legacy_communication_id
        FROM engagements""",
}
# Text that names base tables or roles; "case" is a keyword and quoted where used.
_ROLE_INPUTS = {
    "calendar": ("communication", "person", "company"), "linked_contacts": ("contacts",), "linked_deals": ("deals",),
    "linked_engagements": ("engagements",),
}
_BASE_INPUTS = {
    "address": ("customer", "supplier", "nation", "region"),
    "company": ("customer",), "person": ("supplier",), "opportunity": ("orders",),
    "case": ("orders", "lineitem"), "communication": ("events",), "calendar": (),
    "social_link": ("events",), "social_network": ("events",), "phone_link": ("events",),
    "email_link": ("events",), "companies": ("customer", "nation", "region"),
    "contacts": ("supplier", "nation", "region"), "deals": ("orders",), "engagements": ("events",),
    "linked_contacts": (), "linked_deals": (), "linked_engagements": (),
}


# Resolved tables by session: handles like those of a catalog, holding no rows.
_HANDLES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    handles = _HANDLES.setdefault(spark, {})
    if (sf_dir, name) not in handles:
        handles[sf_dir, name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return handles[sf_dir, name]


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One CRM table as a DataFrame."""
    handles = _HANDLES.setdefault(spark, {})
    if (sf_dir, name) not in handles:
        inputs = {t: base(spark, sf_dir, t) for t in _BASE_INPUTS[name]}
        inputs |= {r: role(spark, sf_dir, r) for r in _ROLE_INPUTS.get(name, ())}
        names = "|".join(inputs)
        sql = re.sub(rf"\b(FROM|JOIN) ({names})\b", r"\1 {\2} AS \2", ROLE_SQL[name])
        handles[sf_dir, name] = spark.sql(sql, **inputs)
    return handles[sf_dir, name]


def roles(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: role(spark, sf_dir, name) for name in names}


def check_sql(body: str, *names: str) -> str:
    """Checking SQL: the given roles as named subqueries, then the query itself."""
    ordered: list[str] = []
    for name in names:
        for needed in (*_ROLE_INPUTS.get(name, ()), name):
            if needed not in ordered:
                ordered.append(needed)
    parts = []
    for name in ordered:
        quoted = '"case"' if name == "case" else name
        parts.append(f"{quoted} AS ({ROLE_SQL[name]})")
    if body.lstrip().upper().startswith("WITH "):
        body = body.lstrip()[5:]
        return "WITH " + ",\n".join(parts) + ",\n" + body
    return "WITH " + ",\n".join(parts) + "\n" + body
