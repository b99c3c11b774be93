"""Queries: keys and links found in the data alone."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.crm.legacy import RELATIONSHIPS
from crmweave.operators.discovery import discover_keys, discover_links
from crmweave.testbed.matching import canon
from crmweave.testbed.registry import query
from crmweave.testbed.roles import base, role

# Columns that may hold ids, by table; those of person and company keep a text column too.
IDS = {
    "company": ("Comp_CompanyId", "Comp_PrimaryPersonId", "Comp_PrimaryAddressId", "Comp_Name"),
    "person": ("Pers_PersonId", "Pers_CompanyId", "Pers_PrimaryAddressId", "Pers_EmailAddress"),
    "opportunity": ("Oppo_OpportunityId", "Oppo_PrimaryCompanyId", "Oppo_PrimaryPersonId"),
    "case": ("Case_CaseId", "Case_PrimaryCompanyId", "Case_PrimaryPersonId"),
    "address": ("Addr_AddressId", "Addr_CompanyId", "Addr_PersonId"),
    "communication": ("Comm_CommunicationId", "Comm_CompanyId", "Comm_PersonId", "Comm_OpportunityId", "Comm_CaseId"),
    "companies": ("hs_object_id", "legacy_company_id"),
    "contacts": ("hs_object_id", "associatedcompanyid", "legacy_contact_id"),
}
DECLARED = tuple(r for r in RELATIONSHIPS if not r.kind)


def _values_sql():
    named = [(t, c) for t, columns in IDS.items() for c in columns]
    return ", ".join(
        (
            "vals AS (" + " UNION ALL ".join(
                f"""SELECT '{t}' AS t, '{c}' AS c, {canon(c)} AS v, count(*) AS n FROM {'"case"' if t == "case" else t}
                    WHERE {canon(c)} IS NOT NULL GROUP BY 3"""
                for t, c in named
            ) + ")",
            "cols AS (SELECT t, c, count(*) AS d, sum(n)::BIGINT AS filled, max(n) AS most FROM vals GROUP BY t, c)",
            "declared AS (SELECT * FROM (VALUES " + ", ".join(
                f"('{r.child}', '{r.column}', '{r.parent}', '{r.key}')" for r in DECLARED
            ) + ") AS x(t, c, pt, pc))",
        )
    )


LINKS_SQL = f"""WITH {_values_sql()}, met AS (
        SELECT a.t, a.c, b.t AS pt, b.c AS pc, count(*) AS shared, sum(a.n)::BIGINT AS hit
        FROM vals AS a JOIN vals AS b ON a.v = b.v AND (a.t <> b.t OR a.c <> b.c) GROUP BY ALL),
    found AS (
        SELECT m.t AS child, m.c AS child_column, m.pt AS parent, m.pc AS parent_key, k.filled AS rows,
               k.filled - m.hit AS orphans, round(m.shared / p.d, 6) AS coverage, x.t IS NOT NULL AS declared
        FROM met AS m JOIN cols AS k ON m.t = k.t AND m.c = k.c JOIN cols AS p ON m.pt = p.t AND m.pc = p.c AND p.most = 1
             LEFT JOIN declared AS x ON m.t = x.t AND m.c = x.c AND m.pt = x.pt AND m.pc = x.pc
        WHERE m.shared >= 0.9 * k.d AND k.d >= 2)"""


def found_links(spark, d) -> DataFrame:
    tables = {t: role(spark, d, t).select(*columns) for t, columns in IDS.items()}
    return discover_links(tables, declared=DECLARED)


query("q_discover_links", LINKS_SQL + " SELECT * FROM found", *IDS)(found_links)


@query(
    "q_discover_links_precision",
    LINKS_SQL + """ SELECT count(*) AS found, count(CASE WHEN declared THEN 1 END) AS declared_found,
        round(count(CASE WHEN declared THEN 1 END) / count(*), 6) AS precision FROM found""",
    *IDS,
)
def _(spark, d):
    """How much of what the data allow is meant: small dense ids are included in each other by chance."""
    n = F.count(F.when(F.col("declared"), 1))
    return found_links(spark, d).agg(
        F.count("*").alias("found"), n.alias("declared_found"), F.round(n / F.count("*"), 6).alias("precision")
    )


KEY_COLUMNS = {
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "events": ("event_id", "ts", "user_id", "event_type"),
}


def _sets_sql(table, columns):
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS t, {list(s)} AS cols, count(*) AS n, count(DISTINCT {"(" + ", ".join(s) + ")" if len(s) > 1 else s[0]}) AS d,
                   {" AND ".join(f"count({c}) = count(*)" for c in s)} AS whole FROM {table}"""
        for size in (1, 2, 3) for s in combinations(columns, size)
    )


@query(
    "q_discover_keys",
    "WITH sets AS (" + " UNION ALL ".join(_sets_sql(t, c) for t, c in KEY_COLUMNS.items()) + """),
    keys AS (SELECT * FROM sets WHERE whole AND n = d AND n > 0)
    SELECT t AS table_name, array_to_string(cols, ',') AS key_columns, n AS rows FROM keys AS a
    WHERE NOT EXISTS (SELECT 1 FROM keys AS b WHERE b.t = a.t AND len(b.cols) < len(a.cols) AND list_has_all(a.cols, b.cols))""",
)
def _(spark, d):
    return reduce(DataFrame.unionByName, (discover_keys(base(spark, d, t), t, columns=c) for t, c in KEY_COLUMNS.items()))
