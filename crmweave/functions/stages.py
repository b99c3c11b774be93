"""Categories derived from status, stage, priority, outcome and entity kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column, recode
from crmweave.functions.text import joined

# Final stage per outcome.
OUTCOME_STAGE = {
    "No-go": "Closed Lost",
    "Abandonnée": "Closed Lost",
    "Perdue": "Closed Lost",
    "Gagnée": "Closed Won",
    "En cours": "In Progress",
}
# Codes of the entity kinds used by link tables.
COMPANY_KIND, CASE_KIND, OPPORTUNITY_KIND, PERSON_KIND = 5, 6, 7, 13
# Priority scores and status categories.
PRIORITY_SCORE = {"High": 1, "Medium": 2}
STATUS_CATEGORY = {"Active": "Current"}


def final_stage(outcome: Column | str) -> Column:
    return recode(outcome, OUTCOME_STAGE, "Unknown")


def stage_number(stage: Column | str) -> Column:
    """1 to 5 from a two-digit prefix ``01`` to ``05``; anything else, NULL too, is 0."""
    prefix = F.substring(as_column(stage), 1, 2)
    return recode(prefix, {f"0{n}": n for n in range(1, 6)}, 0)


def status_category(status: Column | str) -> Column:
    return recode(status, STATUS_CATEGORY, "Inactive")


def priority_score(priority: Column | str) -> Column:
    return recode(priority, PRIORITY_SCORE, 3)


def entity_kind(kind: Column | str) -> Column:
    return recode(kind, {COMPANY_KIND: "Company", PERSON_KIND: "Person"}, "Unknown")


def entity_name(
    kind: Column | str, company: Column | str, first: Column | str, last: Column | str
) -> Column:
    """Name of the linked party, chosen by its kind."""
    kind = as_column(kind)
    return (
        F.when(kind == COMPANY_KIND, as_column(company))
        .when(kind == PERSON_KIND, joined(first, last))
        .otherwise(F.lit("Unknown"))
    )
