"""Queries: reconciliation with links translated by crosswalks, and a run over all objects."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.crm.target import object_map
from crmweave.functions.payload import map_rows
from crmweave.operators import reconcile
from crmweave.operators.crosswalk import crosswalk_of, link_report
from crmweave.plans.reconciliation import reconcile_all, staging_path
from crmweave.session import shared_folder
from crmweave.sources.tables import read_table
from crmweave.testbed.matching import AS_OF, OBJECTS, canon, differs
from crmweave.testbed.registry import query
from crmweave.testbed.roles import role

# Per object: the role of its target rows; its links (legacy column in the checking SQL, property, object referred to).
LINKED = {
    "companies": ("companies", ()),
    "contacts": ("linked_contacts", (("Pers_CompanyId", "associatedcompanyid", "companies"),)),
    "deals": (
        "linked_deals",
        (("Oppo_PrimaryCompanyId", "associatedcompanyid", "companies"), ("Oppo_PrimaryPersonId", "primary_contact_id", "contacts")),
    ),
    "engagements": (
        "linked_engagements",
        (
            ("Comm_OpportunityId", "associated_deal_id", "deals"), ("Company_Id", "associated_company_id", "companies"),
            ("Person_Id", "associated_contact_id", "contacts"),
        ),
    ),
}
ROLES = tuple(
    dict.fromkeys([r for kind, o in OBJECTS.items() for r in o["roles"] if r != kind] + [r for r, _ in LINKED.values()])
)


def crosswalk_name(kind):
    return f"walk_{kind}"


def walks_sql():
    return ", ".join(
        f"""{crosswalk_name(kind)} AS (
            SELECT {canon(OBJECTS[kind]["crosswalk"])} AS k, min(hs_object_id) AS id FROM {LINKED[kind][0]}
            WHERE {canon(OBJECTS[kind]["crosswalk"])} IS NOT NULL GROUP BY 1)"""
        for kind in ("companies", "contacts", "deals")
    )


def linked_sql(kind):
    """Legacy rows left joined to target rows, with t_<property> for each translated link."""
    o, (table, links) = OBJECTS[kind], LINKED[kind]
    joins = " ".join(
        f"LEFT JOIN {crosswalk_name(parent)} AS w{i} ON {canon('leg.' + column)} = w{i}.k" for i, (column, _, parent) in enumerate(links)
    )
    names = "".join(f", w{i}.id AS t_{name}" for i, (_, name, _) in enumerate(links))
    return f"""(SELECT leg.*, tgt.*, tgt.hs_object_id AS target_id, CAST({canon("leg." + o["id"])} AS BIGINT) AS legacy_id {names}
                FROM ({o["sql"]}) AS leg LEFT JOIN
                     (SELECT * FROM {table} WHERE {o["crosswalk"]} IS NOT NULL) AS tgt
                     ON {canon("leg." + o["id"])} = {canon("tgt." + o["crosswalk"])} {joins}) AS j"""


def conflicts_sql(kind):
    links = LINKED[kind][1]
    plain = [
        (right.removeprefix("CAST(").split(" AS ")[0], differs(left, right)) for left, right in OBJECTS[kind]["pairs"]
    ]
    tests = dict(plain) | {
        name: f"(t_{name} IS NOT NULL OR {canon(column)} IS NULL) AND t_{name} IS DISTINCT FROM {name}" for column, name, _ in links
    }
    order = [f.target for f in object_map(kind).fields if f.target in tests]
    listed = ", ".join(f"CASE WHEN {tests[n]} THEN '{n}' END" for n in order)
    return f"CASE WHEN target_id IS NULL THEN '' ELSE concat_ws(',', {listed}) END"


def status_sql(kind):
    return f"CASE WHEN target_id IS NULL THEN 'new' WHEN {conflicts_sql(kind)} <> '' THEN 'conflict' ELSE 'matched' END"


def linked(spark, d, kind) -> DataFrame:
    walks = {k: crosswalk_of(role(spark, d, LINKED[k][0]), object_map(k)) for k in LINKED}
    return reconcile.reconcile(OBJECTS[kind]["legacy"](spark, d), role(spark, d, LINKED[kind][0]), object_map(kind), crosswalks=walks)


@query(
    "q_crosswalk_links",
    f"WITH {walks_sql()} " + " UNION ALL ".join(
        f"""SELECT '{kind}' AS object_type, legacy_id, target_id, '{name}' AS property, {canon(column)} AS legacy_link,
                   t_{name} AS translated, {name} AS present,
                   CASE WHEN {canon(column)} IS NULL THEN 'empty' WHEN t_{name} IS NULL THEN 'unresolved'
                        WHEN target_id IS NULL THEN 'new' WHEN t_{name} IS NOT DISTINCT FROM {name} THEN 'same'
                        ELSE 'differs' END AS state
            FROM {linked_sql(kind)}"""
        for kind, (_, links) in LINKED.items() for column, name, _ in links
    ),
    *ROLES,
)
def _(spark, d):
    parts = [link_report(linked(spark, d, kind), object_map(kind)).drop("legacy_key") for kind, (_, links) in LINKED.items() if links]
    return reduce(DataFrame.unionByName, parts)


for _kind in ("contacts", "deals", "engagements"):

    def _reconciled(spark, d, kind=_kind):
        rows = linked(spark, d, kind)
        return rows.select("legacy_id", "target_id", F.array_join("conflict_fields", ",").alias("conflict_fields"), "reconciliation_status")

    query(
        f"q_reconcile_linked_{_kind}",
        f"""WITH {walks_sql()} SELECT legacy_id, target_id, {conflicts_sql(_kind)} AS conflict_fields,
                   {status_sql(_kind)} AS reconciliation_status FROM {linked_sql(_kind)}""",
        *ROLES,
    )(_reconciled)


# Columns of the checking SQL by legacy field, where the names differ.
NAMES = {
    "Addr_City": "Address_City", "Addr_Country": "Address_Country", "Addr_PostCode": "Address_PostCode",
    "Addr_Street1": "Address_Street1",
}
# Legacy fields that the test rows of each object have, with their SQL.
STAGED = {
    "companies": {
        f: NAMES.get(f, f) for f in (
            "Comp_Name", "Comp_WebSite", "Comp_PhoneNumber", "Comp_Type", "Comp_Territory", "Comp_Sector", "Comp_Revenue",
            *NAMES,
        )
    },
    "contacts": {
        f: NAMES.get(f, f) for f in ("Pers_FirstName", "Pers_LastName", "Pers_EmailAddress", "Pers_PhoneNumber", "Pers_CompanyId", *NAMES)
    } | {"Comp_Name": "Company_Name"},
    "deals": {
        "Oppo_Description": "Oppo_Description", "Oppo_Forecast": "CAST(Oppo_Forecast AS DECIMAL(15,2))", "Oppo_Stage": "Oppo_Stage",
        "Oppo_Status": "Oppo_Status", "Oppo_Certainty": "CAST(Oppo_Certainty AS DECIMAL(5,2))", "Oppo_TargetClose": "Oppo_TargetClose",
        "Oppo_Priority": "Oppo_Priority", "Oppo_PrimaryCompanyId": "Oppo_PrimaryCompanyId", "Comp_Name": "Company_Name",
        "Pers_PersonId": "Oppo_PrimaryPersonId", "Oppo_CreatedDate": "Oppo_CreatedDate",
    },
    "engagements": {
        "Comm_Subject": "Comm_Subject", "Comm_Note": "Comm_Note", "Comm_DateTime": "Comm_DateTime", "Comm_Type": "Comm_Type",
        "Comm_Action": "Comm_Action", "Comm_Status": "Comm_Status", "Comm_OriginalDateTime": "Comm_OriginalDateTime",
        "Comm_OpportunityId": "Comm_OpportunityId", "Comm_CaseId": "Comm_CaseId", "Comp_CompanyId": "Company_Id", "Pers_PersonId": "Person_Id",
    },
}


def maps_sql(kind):
    """Both maps of the staged rows, one row per entry; empty text is an entry of the legacy properties only."""
    links = {name for _, name, _ in LINKED[kind][1]}
    entries = [("legacy_properties", field, f"CAST({sql} AS STRING)", "TRUE") for field, sql in STAGED[kind].items()]
    for f in object_map(kind).fields:
        if f.legacy in STAGED[kind]:
            value = f"CAST({f't_{f.target}' if f.target in links else STAGED[kind][f.legacy]} AS STRING)"
            entries.append(("properties_to_update", f.target, value, f"trim({value}) <> ''"))
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS object_type, legacy_id, '{name}' AS map, '{prop}' AS property, {value} AS value
            FROM r_{kind} WHERE {value} IS NOT NULL AND {keep}"""
        for name, prop, value, keep in entries
    )


@query(
    "q_stage_maps",
    f"WITH {walks_sql()}, " + ", ".join(f"r_{k} AS (SELECT * FROM {linked_sql(k)})" for k in LINKED) + " "
    + " UNION ALL ".join(maps_sql(kind) for kind in LINKED),
    *ROLES,
)
def _(spark, d):
    parts = []
    for kind in LINKED:
        staged = reconcile.to_staging(linked(spark, d, kind), kind, AS_OF)
        for name in ("legacy_properties", "properties_to_update"):
            parts.append(
                map_rows(staged, name, F.lit(kind).alias("object_type"), F.col(staged.columns[0]).alias("legacy_id"), F.lit(name).alias("map"))
            )
    return reduce(DataFrame.unionByName, parts)


@query(
    "q_stage_linked_deals",
    f"""WITH {walks_sql()} SELECT legacy_id AS legacy_deal_id, target_id AS target_deal_id,
               Oppo_PrimaryCompanyId AS legacy_company_id, associatedcompanyid AS target_company_id,
               Oppo_PrimaryPersonId AS legacy_contact_id, primary_contact_id AS target_contact_id,
               {status_sql("deals")} AS reconciliation_status
        FROM {linked_sql("deals")}""",
    *ROLES,
)
def _(spark, d):
    return reconcile.to_staging(linked(spark, d, "deals"), "deals", AS_OF).select(
        "legacy_deal_id", "target_deal_id", "legacy_company_id", "target_company_id", "legacy_contact_id", "target_contact_id",
        "reconciliation_status",
    )


@query(
    "q_reconcile_all",
    f"WITH {walks_sql()} " + " UNION ALL ".join(
        f"SELECT '{kind}' AS object_type, {status_sql(kind)} AS outcome, count(*) AS n FROM {linked_sql(kind)} GROUP BY ALL" for kind in LINKED
    ) + "".join(
        f""" UNION ALL SELECT '{kind}', 'unresolved {name}', count(*) FROM {linked_sql(kind)}
             WHERE {canon(column)} IS NOT NULL AND t_{name} IS NULL HAVING count(*) > 0"""
        for kind, (_, links) in LINKED.items() for column, name, _ in links
    ),
    *ROLES,
)
def _(spark, d):
    """What a run over all objects leaves in its tables."""
    folder = f"{shared_folder(spark)}/staging-{uuid.uuid4().hex}"
    legacy = {kind: o["legacy"](spark, d) for kind, o in OBJECTS.items()}
    target = {kind: role(spark, d, name) for kind, (name, _) in LINKED.items()}
    done = reconcile_all(spark, legacy, target, folder, AS_OF)
    if failed := [kind for kind, stats in done.items() if "error" in stats]:
        raise RuntimeError(f"reconciliation of {failed} failed")
    parts = []
    for kind, (_, links) in LINKED.items():
        staged = read_table(spark, staging_path(folder, kind))
        parts.append(staged.groupBy(F.lit(kind).alias("object_type"), F.col("reconciliation_status").alias("outcome")).agg(F.count("*").alias("n")))
        if links:
            lost = spark.read.parquet(f"{staging_path(folder, kind)}_unresolved")
            parts.append(lost.groupBy("object_type", F.concat(F.lit("unresolved "), "property").alias("outcome")).agg(F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, parts)
