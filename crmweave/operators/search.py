"""Parameterised searches over target tables.

A parameter that is not given drops its clause.  Values are bound as literals, so
wildcard and quote characters in them have no special meaning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.crm.target import crosswalk_column, object_type_of
from crmweave.functions.keys import canonical_key
from crmweave.functions.names import resolve_column
from crmweave.functions.text import contains_ci
from crmweave.operators.lookup import left_lookup

DEFAULT_LIMIT = 100
KEY = "hs_object_id"


@dataclass(frozen=True)
class Search:
    """Returned columns, and how each parameter is compared.

    ``together`` parameters are substring tests combined by AND; everything else is
    combined by OR.
    """

    columns: tuple[str, ...]
    contains: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()
    together: tuple[str, ...] = ()


# Returned columns and searchable parameters; the crosswalk column is
# added to both.
SEARCHES = {
    "contacts": Search(
        columns=(
            "hs_object_id", "firstname", "lastname", "email", "phone", "mobilephone",
            "jobtitle", "department", "company", "associatedcompanyid", "city", "country",
        ),
        contains=("company",),
        equals=("email",),
        together=("firstname", "lastname"),
    ),
    "companies": Search(
        columns=(
            "hs_object_id", "name", "domain", "website", "phone", "city", "state", "country",
            "zip", "industry", "numberofemployees", "annualrevenue",
        ),
        contains=("name",),
        equals=("domain",),
    ),
    "deals": Search(
        columns=(
            "hs_object_id", "dealname", "amount", "dealstage", "closedate", "createdate",
            "pipeline", "deal_status", "deal_certainty", "deal_type", "deal_source",
            "associatedcompanyid",
        ),
        contains=("dealname",),
        equals=("dealstage",),
    ),
    "engagements": Search(
        columns=(
            "hs_object_id", "hs_engagement_subject", "hs_note_body", "hs_timestamp",
            "hs_engagement_type", "hs_engagement_status", "associated_company_id",
            "associated_contact_id",
        ),
        equals=("associated_company_id",),
    ),
}


def search(
    table: DataFrame,
    object_type: str,
    crosswalk: str | None = None,
    limit: int | None = DEFAULT_LIMIT,
    **parameters: object,
) -> DataFrame:
    """Rows with a crosswalk id that satisfy any of the given parameters; all of them with ``limit=None``.

    A returned column that the table has under a like name keeps the name given in ``SEARCHES``.
    """
    kind = object_type_of(object_type)
    spec = SEARCHES[kind]
    crosswalk = crosswalk or crosswalk_column(kind)
    known = {*spec.contains, *spec.equals, *spec.together, crosswalk}
    if unknown := set(parameters) - known:
        raise ValueError(f"cannot search {kind} by {sorted(unknown)}; known: {sorted(known)}")
    given = {name: value for name, value in parameters.items() if value not in (None, "")}

    clauses: list[Column] = []
    clauses += [contains_ci(c, str(given[c])) for c in spec.contains if c in given]
    clauses += [F.col(c) == F.lit(given[c]) for c in spec.equals if c in given]
    names = [contains_ci(c, str(given[c])) for c in spec.together if c in given]
    if names:
        clauses.append(reduce(lambda a, b: a & b, names))
    if crosswalk in given:
        clauses.append(_carries(crosswalk, given[crosswalk]))

    found = table.where(F.col(crosswalk).isNotNull())
    if clauses:
        found = found.where(reduce(lambda a, b: a | b, clauses))
    known_as = {c: resolve_column(c, table.columns) for c in (*spec.columns, crosswalk)}
    found = found.select(*(F.col(actual).alias(c) for c, actual in known_as.items() if actual)).orderBy(KEY)
    return found if limit is None else found.limit(limit)


def _carries(crosswalk: str, legacy_id: object) -> Column:
    """Whether a row carries an id, padded or through a float as it may be.

    This reads the column of every row. Where point lookups matter, store ``canonical_key`` as a column and name that.
    """
    return canonical_key(crosswalk) == F.lit(str(legacy_id).strip().removesuffix(".0"))


def lookup_by_legacy_id(
    table: DataFrame, object_type: str, legacy_id: object, crosswalk: str | None = None
) -> DataFrame:
    """The target row for one legacy id: one row or none."""
    crosswalk = crosswalk or crosswalk_column(object_type)
    found = table.where(_carries(crosswalk, legacy_id))
    return found.orderBy(KEY).limit(1)


def high_value(
    deals: DataFrame, least: object, amount: str = "amount", crosswalk: str | None = None, k: int = 50
) -> DataFrame:
    """The k largest linked deals above an amount."""
    crosswalk = crosswalk or crosswalk_column("deals")
    return (
        deals.where((F.col(amount) > F.lit(least)) & F.col(crosswalk).isNotNull())
        .select(KEY, "dealname", amount, crosswalk)
        .orderBy(F.col(amount).desc(), F.col(KEY))
        .limit(k)
    )


def linked_or_tagged(
    table: DataFrame, tags: DataFrame, on: tuple[str, str], crosswalk: str
) -> DataFrame:
    """Rows that carry a crosswalk id or have a row in a tag table.

    Each tag key is looked up once, so rows are neither lost nor repeated.
    """
    key, tag_key = on
    tagged = tags.select(F.col(tag_key).alias("__tag")).distinct().withColumn("__tagged", F.lit(True))
    return (
        left_lookup(table, tagged, [(key, "__tag")], {"__tagged": "__tagged"})
        .where(F.col(crosswalk).isNotNull() | F.coalesce("__tagged", F.lit(False)))
        .drop("__tagged")
    )
