"""Silver layer: the seven processed views, and views built on top of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.crm.views import VIEWS
from crmweave.functions.columns import is_filled
from crmweave.functions.money import net_amount, net_weighted_amount, weighted_forecast
from crmweave.functions.stages import entity_kind, entity_name
from crmweave.operators.lookup import left_lookup
from crmweave.operators.project import party_lookup, project_entity


def processed_view(
    tables: Mapping[str, DataFrame], name: str, missing: str = "null", distinct: bool = True
) -> DataFrame:
    """One of the seven views.

    ``distinct=False`` saves the shuffle of whole rows where keys are known to be
    unique, so that no two rows can be equal.
    """
    return project_entity(tables, VIEWS[name], missing=missing, distinct=distinct)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "processed_") -> list[str]:
    """Register every view whose source is at hand as ``processed_<name>``."""
    made = []
    for name, spec in VIEWS.items():
        if {spec.source, *(lk.source for lk in spec.lookups)} <= set(tables):
            processed_view(tables, name).createOrReplaceTempView(prefix + name)
            made.append(prefix + name)
    return made


def layered_opportunities(
    opportunity: DataFrame, companies: DataFrame, persons: DataFrame, scale: str = "fraction"
) -> DataFrame:
    """Opportunities joined to the processed company and person views.

    The views may hold several rows per id (one per address), so only their id and
    name columns take part, reduced to distinct rows, and nothing fans out.
    """
    company = companies.select("Comp_CompanyId", "Comp_Name", "Comp_WebSite").distinct()
    person = persons.select("Pers_PersonId", "Pers_FirstName", "Pers_LastName", "Pers_EmailAddress").distinct()
    df = left_lookup(
        opportunity, company, [("Oppo_PrimaryCompanyId", "Comp_CompanyId")],
        {"Comp_Name": "Comp_Name", "Comp_WebSite": "Comp_WebSite"},
    )
    df = left_lookup(
        df, person, [("Oppo_PrimaryPersonId", "Pers_PersonId")],
        {c: c for c in ("Pers_FirstName", "Pers_LastName", "Pers_EmailAddress")},
    )
    net = net_amount("Oppo_Forecast", "oppo_cout")
    return df.withColumns(
        {
            "Weighted_Forecast": weighted_forecast("Oppo_Forecast", "Oppo_Certainty", scale),
            "Net_Amount": net,
            "Net_Weighted_Amount": net_weighted_amount(net, "Oppo_Certainty", scale),
        }
    ).where(F.col("Oppo_OpportunityId").isNotNull())


def social_links(links: DataFrame, company: DataFrame, person: DataFrame) -> DataFrame:
    """Social links with the kind and name of the company or person they belong to."""
    party = party_lookup(company, person)
    names = ("Comp_Name", "Comp_WebSite", "Pers_FirstName", "Pers_LastName")
    df = left_lookup(
        links.where(is_filled("sone_networklink")), party,
        [("Related_TableID", "Party_Kind"), ("Related_RecordID", "Party_Id")], {c: c for c in names},
    )
    return df.withColumns(
        {
            "entity_type": entity_kind("Related_TableID"),
            "entity_name": entity_name("Related_TableID", "Comp_Name", "Pers_FirstName", "Pers_LastName"),
        }
    )
