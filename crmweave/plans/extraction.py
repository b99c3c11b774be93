"""Bronze layer: extract, check and save entities."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crmweave.crm.legacy import DEPENDENCY_ORDER, ENTITIES
from crmweave.operators.contact import with_contact
from crmweave.operators.keyed import first_wins
from crmweave.operators.project import party_lookup, project_entity, scan_target, stamp_provenance
from crmweave.operators.quality import compare_columns
from crmweave.sources.writers import write_bronze, write_snapshot
from crmweave.specs import EntitySpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class EntityResult:
    entity: str
    status: str
    extracted: int = 0
    added: int = 0
    path: str | None = None
    error: str | None = None

    @property
    def duplicates_skipped(self) -> int:
        return self.extracted - self.added


def extract_entities(
    tables: Mapping[str, DataFrame],
    out_dir: str,
    extracted_at: datetime | str,
    names: Sequence[str] | None = None,
    conditions: Mapping[str, Column | str] | None = None,
    limit: int | None = None,
    unique: bool = True,
    fmt: str = "parquet",
    specs: Mapping[str, EntitySpec] = ENTITIES,
    parallel: int = 1,
) -> list[EntityResult]:
    """Extract entities in dependency order; a failing one does not stop the rest.

    ``unique`` keeps one row per key, which costs a shuffle, and counts what it
    dropped.  Where the sources hold companies and persons but no ``party``, which the
    polymorphic links look up, it is made of them.  ``parallel`` jobs are submitted at a time, so that one entity can use
    the executors another one's last tasks leave idle.
    """
    chosen = set(names or specs)
    if unknown := chosen - set(specs):
        raise ValueError(f"unknown entities {sorted(unknown)}; known: {sorted(specs)}")
    if "party" not in tables and {"company", "person"} <= set(tables):
        tables = {**tables, "party": party_lookup(tables["company"], tables["person"])}
    order = [n for n in DEPENDENCY_ORDER if n in chosen] + sorted(chosen - set(DEPENDENCY_ORDER))

    def extract(name: str) -> EntityResult:
        condition = (conditions or {}).get(name)
        path = f"{out_dir}/{name.lower()}"
        return _extract_entity(tables, specs[name], path, extracted_at, condition, limit, unique, fmt)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(extract, order))


def _extract_entity(
    tables: Mapping[str, DataFrame],
    spec: EntitySpec,
    path: str,
    extracted_at: datetime | str,
    condition: Column | str | None,
    limit: int | None,
    unique: bool,
    fmt: str,
) -> EntityResult:
    """One job: rows are counted while they are written."""
    seen, kept = Observation(), Observation()
    if missing := sorted({spec.source, *(x.source for x in spec.lookups)} - set(tables)):
        return EntityResult(spec.name, "error", error=f"lacks table {', '.join(missing)}")
    try:
        df = project_entity(tables, spec, condition, limit)
        df = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if unique:
            # Which of several equal keys survives must not depend on row order.
            df = first_wins(df, [spec.key], [c for c in df.columns if c != spec.key])
        df = df.observe(kept, F.count(F.lit(1)).alias("n"))
        write_bronze(stamp_provenance(df, extracted_at, spec.source), path, fmt)
        return EntityResult(spec.name, "success", seen.get["n"], kept.get["n"], path)
    except (PySparkException, ValueError) as error:
        log.warning("extraction of %s failed: %s", spec.name, error)
        return EntityResult(spec.name, "error", error=str(error).splitlines()[0])


@dataclass(frozen=True)
class SnapshotResult(EntityResult):
    """``status`` is success, no_data or error; ``columns`` compares the table with its specification."""

    columns: Mapping[str, object] | None = None


def extract_and_save(
    table: DataFrame, spec: EntitySpec, out_dir: str, taken_at: datetime, limit: int | None = None,
    validate: bool = True, fmt: str = "parquet",
) -> SnapshotResult:
    """Scan a target object and save a snapshot of it, in one job."""
    columns = compare_columns(table.columns, spec.base) if validate else None
    seen = Observation()
    try:
        path = write_snapshot(scan_target(table, spec, limit), f"{out_dir}/{spec.name}", taken_at, fmt, seen)
    except PySparkException as failure:
        return SnapshotResult(spec.name, "error", error=str(failure).splitlines()[0], columns=columns)
    rows = seen.get["n"]
    return SnapshotResult(spec.name, "success" if path else "no_data", rows, rows, path, columns=columns)


def extract_all(
    tables: Mapping[str, DataFrame], specs: Sequence[EntitySpec], out_dir: str, taken_at: datetime,
    limit: int | None = None, validate: bool = True,
) -> list[SnapshotResult]:
    """``extract_and_save`` for several target objects, one after the other."""
    return [extract_and_save(tables[s.source], s, out_dir, taken_at, limit, validate) for s in specs]


def companies_with_contacts(
    company: DataFrame, phones: DataFrame, emails: DataFrame, fan_out: bool = False
) -> DataFrame:
    """Companies with their business phone and e-mail; one row each unless ``fan_out``."""
    df = with_contact(
        company, phones, "Comp_CompanyId", "PLink_RecordId", ("PLink_Type", "Business"), "Phon_PhoneId",
        {"Company_Phone": "Phon_FullNumber", "Phone_Id": "Phon_PhoneId"}, fan_out,
    )
    return with_contact(
        df, emails, "Comp_CompanyId", "ELink_RecordID", ("ELink_Type", "Business"), "Emai_EmailId",
        {"Company_Email": "Emai_EmailAddress", "Email_Id": "Emai_EmailId"}, fan_out,
    )


def persons_with_contacts(
    person: DataFrame, phones: DataFrame, emails: DataFrame, fan_out: bool = False
) -> DataFrame:
    """Persons with their business phone and e-mail; one row each unless ``fan_out``."""
    df = with_contact(
        person, phones, "Pers_PersonId", "PLink_RecordId", ("PLink_Type", "Business"), "Phon_PhoneId",
        {"Person_Phone": "Phon_FullNumber", "Phone_Id": "Phon_PhoneId"}, fan_out,
    )
    return with_contact(
        df, emails, "Pers_PersonId", "ELink_RecordID", ("ELink_Type", "Business"), "Emai_EmailId",
        {"Person_Email": "Emai_EmailAddress", "Email_Id": "Emai_EmailId"}, fan_out,
    )
