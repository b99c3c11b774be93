"""Queries: reconciliation, payloads, staging, exports, keyed tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from crmweave.crm.target import object_map
from crmweave.functions.keys import canonical_key
from crmweave.functions.payload import legacy_value, payload_rows
from crmweave.operators import keyed, reconcile
from crmweave.plans.reconciliation import all_run_stats
from crmweave.specs import FieldMap
from crmweave.testbed.entities import COMPANY_SQL, OPPORTUNITY_SQL, PERSON_SQL, entity
from crmweave.testbed.registry import query
from crmweave.testbed.roles import base, role, roles

AS_OF = "2024-02-01 00:00:00"


def canon(expression: str) -> str:
    return f"nullif(regexp_replace(trim(CAST({expression} AS STRING)), '\\.0$', ''), '')"


COMM_SQL = """SELECT Comm_CommunicationId, Comm_OpportunityId, Comm_CaseId, Comm_Type, Comm_Action, Comm_Status,
                     Comm_DateTime, Comm_Note, Comm_Subject, Comm_OriginalDateTime,
                     Pers_PersonId AS Person_Id, Comp_CompanyId AS Company_Id
              FROM calendar"""


def legacy_companies(spark, d):
    return entity("Company", "company", "address")(spark, d)


def legacy_contacts(spark, d):
    return entity("Person", "person", "company", "address")(spark, d)


def legacy_deals(spark, d):
    return entity("Opportunity", "opportunity", "company", "person")(spark, d)


def legacy_comms(spark, d):
    return role(spark, d, "calendar").select(
        "Comm_CommunicationId", "Comm_OpportunityId", "Comm_CaseId", "Comm_Type", "Comm_Action", "Comm_Status",
        "Comm_DateTime", "Comm_Note", "Comm_Subject", "Comm_OriginalDateTime",
        F.col("Pers_PersonId").alias("Person_Id"), F.col("Comp_CompanyId").alias("Company_Id"),
    )


# Per object: builder of the legacy rows, their SQL, the roles both need, legacy id,
# crosswalk, and the compared pairs (legacy expression, target expression, property).
OBJECTS = {
    "companies": dict(
        legacy=legacy_companies, sql=COMPANY_SQL, roles=("company", "address", "companies"),
        id="Comp_CompanyId", crosswalk="legacy_company_id",
        pairs=(
            ("Comp_Name", "name"), ("Comp_WebSite", "domain"), ("Comp_Type", "type"), ("Comp_Sector", "industry"),
            ("Comp_Revenue", "annualrevenue"), ("Address_City", "city"), ("Address_Country", "country"),
        ),
    ),
    "contacts": dict(
        legacy=legacy_contacts, sql=PERSON_SQL, roles=("person", "company", "address", "contacts"),
        id="Pers_PersonId", crosswalk="legacy_contact_id",
        pairs=(
            ("Pers_FirstName", "firstname"), ("Pers_LastName", "lastname"), ("Pers_EmailAddress", "email"),
            ("CAST(Pers_CompanyId AS STRING)", "CAST(associatedcompanyid AS STRING)"),
            ("Company_Name", "company"), ("Address_City", "city"), ("Address_Country", "country"),
        ),
    ),
    "deals": dict(
        legacy=legacy_deals, sql=OPPORTUNITY_SQL, roles=("opportunity", "company", "person", "deals"),
        id="Oppo_OpportunityId", crosswalk="legacy_deal_id",
        pairs=(
            ("Oppo_Description", "dealname"),
            ("CAST(CAST(Oppo_Forecast AS DECIMAL(15,2)) AS STRING)", "CAST(amount AS STRING)"),
            ("Oppo_Stage", "dealstage"),
            ("CAST(Oppo_PrimaryCompanyId AS STRING)", "CAST(associatedcompanyid AS STRING)"),
            ("CAST(Oppo_CreatedDate AS STRING)", "CAST(createdate AS STRING)"),
        ),
    ),
    "engagements": dict(
        legacy=legacy_comms, sql=COMM_SQL, roles=("calendar", "engagements"),
        id="Comm_CommunicationId", crosswalk="legacy_communication_id",
        pairs=(
            ("Comm_Subject", "hs_engagement_subject"), ("Comm_Note", "hs_note_body"),
            ("CAST(Comm_DateTime AS STRING)", "CAST(hs_timestamp AS STRING)"),
            ("Comm_Type", "hs_engagement_type"),
            ("CAST(Company_Id AS STRING)", "CAST(associated_company_id AS STRING)"),
            ("CAST(Person_Id AS STRING)", "CAST(associated_contact_id AS STRING)"),
        ),
    ),
}
SHORT = {"companies": "companies", "contacts": "contacts", "deals": "deals", "engagements": "comms"}


def _property(expression):
    return expression.removeprefix("CAST(").split(" AS ")[0]


def joined_sql(kind):
    """Legacy rows left joined to target rows on the canonical id, for use as a subquery."""
    o = OBJECTS[kind]
    return f"""(SELECT leg.*, tgt.*, tgt.hs_object_id AS target_id,
                       CAST({canon("leg." + o["id"])} AS BIGINT) AS legacy_id
                FROM ({o["sql"]}) AS leg LEFT JOIN
                     (SELECT * FROM {kind} WHERE {o["crosswalk"]} IS NOT NULL) AS tgt
                     ON {canon("leg." + o["id"])} = {canon("tgt." + o["crosswalk"])}) AS j"""


def differs(left, right):
    return f"nullif(trim({left}), '') IS DISTINCT FROM nullif(trim({right}), '')"


def conflict_list_sql(kind):
    tests = ", ".join(
        f"CASE WHEN {differs(left, right)} THEN '{_property(right)}' END" for left, right in OBJECTS[kind]["pairs"]
    )
    return f"CASE WHEN target_id IS NULL THEN '' ELSE concat_ws(',', {tests}) END"


def status_sql(kind, mark_conflicts=True):
    conflict = f"WHEN {conflict_list_sql(kind)} <> '' THEN 'conflict'" if mark_conflicts else ""
    return f"CASE WHEN target_id IS NULL THEN 'new' {conflict} ELSE 'matched' END"


def reconciled(spark, d, kind, mark_conflicts=True):
    return reconcile.reconcile(
        OBJECTS[kind]["legacy"](spark, d), role(spark, d, kind), object_map(kind), mark_conflicts
    )


# --------------------------------------------------------------------------
# Matching

MATCH_COLUMNS = {
    "companies": {
        "leg_Comp_Name": "Comp_Name", "leg_Addr_City": "Address_City", "tgt_name": "name", "tgt_domain": "domain",
    },
    "contacts": {
        "leg_Pers_LastName": "Pers_LastName", "leg_Comp_Name": "Company_Name", "tgt_lastname": "lastname",
        "tgt_email": "email",
    },
    "deals": {
        "leg_Oppo_Description": "Oppo_Description", "leg_Oppo_Stage": "Oppo_Stage", "tgt_dealname": "dealname",
        "tgt_dealstage": "dealstage",
    },
    "engagements": {
        "leg_Comm_Subject": "Comm_Subject", "leg_Comm_DateTime": "Comm_DateTime",
        "tgt_hs_engagement_subject": "hs_engagement_subject",
    },
}


def _matcher(kind):
    def run(spark, d):
        pairs = reconcile.match(OBJECTS[kind]["legacy"](spark, d), role(spark, d, kind), object_map(kind))
        return pairs.select("legacy_id", "target_id", *MATCH_COLUMNS[kind])

    return run


def _reconciler(kind):
    def run(spark, d):
        return reconciled(spark, d, kind).select(
            "legacy_id", "target_id", F.array_join("conflict_fields", ",").alias("conflict_fields"),
            "reconciliation_status", "match_confidence",
        )

    return run


for _kind, _o in OBJECTS.items():
    _chosen = ", ".join(f"{source} AS {name}" for name, source in MATCH_COLUMNS[_kind].items())
    query(
        f"q_match_{SHORT[_kind]}",
        f"""SELECT leg.{_o["id"]} AS legacy_id, tgt.hs_object_id AS target_id, {_chosen}
            FROM ({_o["sql"]}) AS leg JOIN {_kind} AS tgt
                 ON {canon("leg." + _o["id"])} = {canon("tgt." + _o["crosswalk"])}""",
        *_o["roles"],
    )(_matcher(_kind))
    query(
        f"q_reconcile_{SHORT[_kind]}",
        f"""SELECT legacy_id, target_id, {conflict_list_sql(_kind)} AS conflict_fields,
                   {status_sql(_kind)} AS reconciliation_status,
                   CASE WHEN target_id IS NOT NULL THEN 100.0::DOUBLE END AS match_confidence
            FROM {joined_sql(_kind)}""",
        *_o["roles"],
    )(_reconciler(_kind))


@query(
    "q_unmatched",
    f"""SELECT Comp_CompanyId AS legacy_id, Comp_Name AS "leg_Comp_Name", Address_City AS "leg_Addr_City"
        FROM ({COMPANY_SQL}) AS leg
        WHERE NOT EXISTS (SELECT 1 FROM companies
                          WHERE {canon("legacy_company_id")} = {canon("Comp_CompanyId")})""",
    "company", "address", "companies",
)
def _(spark, d):
    rows = reconcile.unmatched(legacy_companies(spark, d), role(spark, d, "companies"), object_map("companies"))
    return rows.select("legacy_id", "leg_Comp_Name", "leg_Addr_City")


@query(
    "q_match_direct",
    f"""SELECT {canon("legacy_company_id")} AS legacy_id, hs_object_id AS target_id FROM companies
        WHERE legacy_company_id IS NOT NULL""",
    "companies",
)
def _(spark, d):
    return reconcile.match_direct(role(spark, d, "companies"), object_map("companies"))


@query(
    "q_conflicts",
    " UNION ALL ".join(
        f"""SELECT legacy_id, target_id, '{_property(right)}' AS property FROM {joined_sql("contacts")}
            WHERE target_id IS NOT NULL AND {differs(left, right)}"""
        for left, right in OBJECTS["contacts"]["pairs"]
    ),
    *OBJECTS["contacts"]["roles"],
)
def _(spark, d):
    return reconcile.conflicts(reconciled(spark, d, "contacts"))


# --------------------------------------------------------------------------
# Payloads

PAYLOAD = {
    "name": "Comp_Name", "domain": "Comp_WebSite", "website": "Comp_WebSite", "phone": "Comp_PhoneNumber",
    "type": "Comp_Type", "territory": "Comp_Territory", "industry": "Comp_Sector", "annualrevenue": "Comp_Revenue",
    "city": "Address_City", "country": "Address_Country", "zip": "Address_PostCode", "address": "Address_Street1",
}


def payload_sql(source, key, properties, extra=""):
    return " UNION ALL ".join(
        f"""SELECT {key}, '{name}' AS property, CAST({column} AS STRING) AS value FROM {source}
            WHERE {column} IS NOT NULL AND CAST({column} AS STRING) <> '' {extra}"""
        for name, column in properties.items()
    )


@query(
    "q_payload_long",
    payload_sql(f"({COMPANY_SQL}) AS leg", "Comp_CompanyId AS legacy_id", PAYLOAD),
    "company", "address",
)
def _(spark, d):
    rows = reconciled(spark, d, "companies").select(
        "legacy_id", F.to_json("properties_to_update").alias("payload")
    )
    return payload_rows(rows, "legacy_id", "payload")


@query(
    "q_json_props",
    """SELECT event_id, k AS property, json_extract_string(props, '$.' || k) AS value
       FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) AS keys""",
)
def _(spark, d):
    return payload_rows(base(spark, d, "events"), "event_id", "props")


@query(
    "q_field_defaults",
    """SELECT Comp_CompanyId, coalesce(Comp_WebSite, 'unknown.example') AS domain, lower(Comp_Type) AS type,
              coalesce(nullif(Comp_PhoneNumber, ''), 'none') AS phone, 'import' AS hs_lead_source
       FROM company""",
    "company",
)
def _(spark, d):
    company = role(spark, d, "company")
    fields = (
        FieldMap("Comp_WebSite", "domain", default="unknown.example"),
        FieldMap("Comp_Type", "type", transform="lower"),
        FieldMap("Comp_PhoneNumber", "phone", default="none"),
        FieldMap("Comp_Source", "hs_lead_source", default="import"),
    )
    mapping = replace(object_map("companies"), fields=fields)
    return company.select(
        "Comp_CompanyId", *(legacy_value(f, company.schema).alias(f.target) for f in mapping.fields)
    )


# --------------------------------------------------------------------------
# Staging

STAGE_COLUMNS = {
    "companies": """legacy_id AS legacy_company_id, target_id AS target_company_id, Comp_Name AS legacy_name,
        name AS target_name, Comp_WebSite AS legacy_domain, domain AS target_domain""",
    "contacts": """legacy_id AS legacy_contact_id, target_id AS target_contact_id,
        Pers_EmailAddress AS legacy_email, email AS target_email, Pers_FirstName AS legacy_firstname,
        Pers_LastName AS legacy_lastname, firstname AS target_firstname, lastname AS target_lastname,
        Pers_CompanyId AS legacy_company_id, associatedcompanyid AS target_company_id""",
    "deals": """legacy_id AS legacy_deal_id, target_id AS target_deal_id, Oppo_Description AS legacy_dealname,
        dealname AS target_dealname, Oppo_Forecast AS legacy_amount, CAST(amount AS DOUBLE) AS target_amount,
        Oppo_PrimaryCompanyId AS legacy_company_id, associatedcompanyid AS target_company_id,
        Oppo_PrimaryPersonId AS legacy_contact_id""",
    "engagements": """legacy_id AS legacy_communication_id, target_id AS target_engagement_id,
        Comm_Type AS legacy_type, Comm_Subject AS legacy_subject, Comm_DateTime AS legacy_datetime,
        Company_Id AS legacy_company_id, associated_company_id AS target_company_id,
        Person_Id AS legacy_contact_id, associated_contact_id AS target_contact_id""",
}
# Head columns left out of a comparison because the test tables hold nothing for them.
EMPTY_COLUMNS = {"deals": ("target_contact_id",)}
MAPS = ("legacy_properties", "properties_to_update")


def staged(spark, d, kind, mark_conflicts=True):
    return reconcile.to_staging(reconciled(spark, d, kind, mark_conflicts), kind, AS_OF, notes="first run")


def _stager(kind):
    def run(spark, d):
        return staged(spark, d, kind).drop(*MAPS, *EMPTY_COLUMNS.get(kind, ()))

    return run


for _kind, _o in OBJECTS.items():
    query(
        f"q_stage_{SHORT[_kind]}",
        f"""SELECT {STAGE_COLUMNS[_kind]}, {status_sql(_kind)} AS reconciliation_status,
                   CASE WHEN target_id IS NOT NULL THEN 100.0::DOUBLE END AS match_confidence,
                   'first run' AS notes, TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS last_updated
            FROM {joined_sql(_kind)}""",
        *_o["roles"],
    )(_stager(_kind))


@query(
    "q_recon_stats",
    f"""SELECT {status_sql("companies")} AS reconciliation_status, count(*) AS n,
               avg(CASE WHEN target_id IS NOT NULL THEN 100.0::DOUBLE END) AS avg_confidence
        FROM {joined_sql("companies")} GROUP BY 1""",
    *OBJECTS["companies"]["roles"],
)
def _(spark, d):
    return reconcile.status_stats(staged(spark, d, "companies"))


ALL_ROLES = tuple(dict.fromkeys(r for o in OBJECTS.values() for r in o["roles"]))


@query(
    "q_recon_run_stats",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS object_type, count(*) AS total,
                   count(CASE WHEN s = 'matched' THEN 1 END) AS matched,
                   count(CASE WHEN s = 'new' THEN 1 END) AS unmatched,
                   count(CASE WHEN s = 'conflict' THEN 1 END) AS conflicts, 0::BIGINT AS errors
            FROM (SELECT {status_sql(kind)} AS s FROM {joined_sql(kind)}) AS r"""
        for kind in OBJECTS
    ),
    *ALL_ROLES,
)
def _(spark, d):
    legacy = {kind: o["legacy"](spark, d) for kind, o in OBJECTS.items()}
    return all_run_stats(legacy, roles(spark, d, *OBJECTS))


@query(
    "q_update_export",
    f"WITH m AS (SELECT * FROM {joined_sql('companies')} WHERE target_id IS NOT NULL) "
    + payload_sql("m", "target_id AS target_company_id", PAYLOAD),
    *OBJECTS["companies"]["roles"],
)
def _(spark, d):
    ready = reconcile.update_export(staged(spark, d, "companies"), "target_company_id")
    return payload_rows(ready, "target_company_id", "properties_to_update")


@query(
    "q_create_export",
    f"WITH m AS (SELECT * FROM {joined_sql('contacts')} WHERE target_id IS NULL) "
    + payload_sql(
        "m", "legacy_id AS legacy_contact_id",
        {
            "Pers_FirstName": "Pers_FirstName", "Pers_LastName": "Pers_LastName",
            "Pers_EmailAddress": "Pers_EmailAddress", "Pers_PhoneNumber": "Pers_PhoneNumber",
            "Pers_CompanyId": "Pers_CompanyId", "Comp_Name": "Company_Name", "Addr_City": "Address_City",
            "Addr_Country": "Address_Country", "Addr_PostCode": "Address_PostCode",
            "Addr_Street1": "Address_Street1",
        },
    ),
    *OBJECTS["contacts"]["roles"],
)
def _(spark, d):
    fresh = reconcile.create_export(staged(spark, d, "contacts"), ["legacy_contact_id"])
    return payload_rows(fresh, "legacy_contact_id", "legacy_properties")


# --------------------------------------------------------------------------
# Keyed tables

@query(
    "q_upsert",
    """WITH current_rows AS (
           SELECT CAST(regexp_replace(trim(legacy_company_id), '\\.0$', '') AS BIGINT) AS legacy_company_id,
                  name AS legacy_name, hs_object_id AS target_company_id, 'pending' AS status, 50 AS confidence
           FROM companies WHERE legacy_company_id IS NOT NULL),
       incoming AS (
           SELECT Comp_CompanyId AS legacy_company_id, Comp_Name AS legacy_name,
                  9000000 + Comp_CompanyId AS target_company_id, 'matched' AS status, 100 AS confidence
           FROM company WHERE Comp_Status = 'Active')
       SELECT coalesce(c.legacy_company_id, i.legacy_company_id) AS legacy_company_id,
              CASE WHEN c.legacy_company_id IS NOT NULL THEN c.legacy_name ELSE i.legacy_name END AS legacy_name,
              coalesce(i.target_company_id, c.target_company_id) AS target_company_id,
              coalesce(i.status, c.status) AS status, coalesce(i.confidence, c.confidence) AS confidence
       FROM current_rows AS c FULL OUTER JOIN incoming AS i ON c.legacy_company_id = i.legacy_company_id""",
    "companies", "company",
)
def _(spark, d):
    t = roles(spark, d, "companies", "company")
    current = t["companies"].where(F.col("legacy_company_id").isNotNull()).select(
        canonical_key("legacy_company_id").cast("bigint").alias("legacy_company_id"),
        F.col("name").alias("legacy_name"), F.col("hs_object_id").alias("target_company_id"),
        F.lit("pending").alias("status"), F.lit(50).alias("confidence"),
    )
    incoming = t["company"].where("Comp_Status = 'Active'").select(
        F.col("Comp_CompanyId").alias("legacy_company_id"), F.col("Comp_Name").alias("legacy_name"),
        (F.col("Comp_CompanyId") + 9000000).alias("target_company_id"),
        F.lit("matched").alias("status"), F.lit(100).alias("confidence"),
    )
    return keyed.upsert(current, incoming, ["legacy_company_id"], ["target_company_id", "status", "confidence"])


@query(
    "q_new_only",
    """SELECT Comm_CommunicationId, Comm_Type, Comm_Subject FROM communication
       WHERE NOT EXISTS (SELECT 1 FROM engagements
                         WHERE legacy_communication_id = CAST(Comm_CommunicationId AS STRING))""",
    "communication", "engagements",
)
def _(spark, d):
    t = roles(spark, d, "communication", "engagements")
    store = t["engagements"].select(
        canonical_key("legacy_communication_id").cast("bigint").alias("Comm_CommunicationId")
    )
    incoming = t["communication"].select("Comm_CommunicationId", "Comm_Type", "Comm_Subject")
    return keyed.new_only(incoming, store, ["Comm_CommunicationId"])


_DEDUPE = """SELECT Comm_CompanyId, Comm_Type, Comm_CommunicationId, Comm_DateTime, Comm_Subject FROM (
    SELECT *, row_number() OVER (PARTITION BY Comm_CompanyId, Comm_Type
                                 ORDER BY Comm_DateTime {0}, Comm_CommunicationId {0}) AS r
    FROM communication) AS ranked WHERE r = 1"""
_DEDUPE_COLUMNS = ("Comm_CompanyId", "Comm_Type", "Comm_CommunicationId", "Comm_DateTime", "Comm_Subject")


@query("q_dedupe_first", _DEDUPE.format("ASC"), "communication")
def _(spark, d):
    rows = role(spark, d, "communication").select(*_DEDUPE_COLUMNS)
    return keyed.first_wins(rows, ["Comm_CompanyId", "Comm_Type"], ["Comm_DateTime", "Comm_CommunicationId"])


@query("q_dedupe_last", _DEDUPE.format("DESC"), "communication")
def _(spark, d):
    rows = role(spark, d, "communication").select(*_DEDUPE_COLUMNS)
    return keyed.last_wins(rows, ["Comm_CompanyId", "Comm_Type"], ["Comm_DateTime", "Comm_CommunicationId"])


_STORE = """store AS (SELECT Comm_CompanyId, Comm_Type, 'stored' AS Comm_Subject FROM communication
                      WHERE Comm_Status = 'Failed' GROUP BY ALL)"""


def _store_and_rows(spark, d):
    rows = role(spark, d, "communication").select(*_DEDUPE_COLUMNS, "Comm_Status")
    store = rows.where("Comm_Status = 'Failed'").select(
        "Comm_CompanyId", "Comm_Type", F.lit("stored").alias("Comm_Subject")
    ).distinct()
    return store, rows


@query(
    "q_insert_absent",
    f"""WITH {_STORE}, incoming AS ({_DEDUPE.format("ASC")})
        SELECT * FROM store UNION ALL
        SELECT Comm_CompanyId, Comm_Type, Comm_Subject FROM incoming AS i
        WHERE NOT EXISTS (SELECT 1 FROM store AS s
                          WHERE s.Comm_CompanyId = i.Comm_CompanyId AND s.Comm_Type = i.Comm_Type)""",
    "communication",
)
def _(spark, d):
    store, rows = _store_and_rows(spark, d)
    return keyed.insert_absent(
        store, rows, ["Comm_CompanyId", "Comm_Type"], ["Comm_DateTime", "Comm_CommunicationId"]
    )


@query(
    "q_overwrite",
    f"""WITH {_STORE}, incoming AS ({_DEDUPE.format("DESC")})
        SELECT Comm_CompanyId, Comm_Type, Comm_Subject FROM incoming UNION ALL
        SELECT * FROM store AS s
        WHERE NOT EXISTS (SELECT 1 FROM incoming AS i
                          WHERE s.Comm_CompanyId = i.Comm_CompanyId AND s.Comm_Type = i.Comm_Type)""",
    "communication",
)
def _(spark, d):
    store, rows = _store_and_rows(spark, d)
    return keyed.overwrite(
        store, rows, ["Comm_CompanyId", "Comm_Type"], ["Comm_DateTime", "Comm_CommunicationId"]
    )
