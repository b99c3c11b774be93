"""Fixed schemas of the reconciliation staging tables and the run log."""

from __future__ import annotations

from pyspark.sql.types import StructType

from crmweave.crm.target import object_type_of
from crmweave.specs import ddl_names

# Head columns per object; "{target}" is the target system's prefix.
_HEADS = {
    "companies": """
        legacy_company_id BIGINT, {target}_company_id BIGINT, legacy_name STRING,
        {target}_name STRING, legacy_domain STRING, {target}_domain STRING""",
    "contacts": """
        legacy_contact_id BIGINT, {target}_contact_id BIGINT, legacy_email STRING,
        {target}_email STRING, legacy_firstname STRING, legacy_lastname STRING,
        {target}_firstname STRING, {target}_lastname STRING, legacy_company_id BIGINT,
        {target}_company_id BIGINT""",
    "deals": """
        legacy_deal_id BIGINT, {target}_deal_id BIGINT, legacy_dealname STRING,
        {target}_dealname STRING, legacy_amount DECIMAL(15,2), {target}_amount DECIMAL(15,2),
        legacy_company_id BIGINT, {target}_company_id BIGINT, legacy_contact_id BIGINT,
        {target}_contact_id BIGINT""",
    "engagements": """
        legacy_communication_id BIGINT, {target}_engagement_id BIGINT, legacy_type STRING,
        legacy_subject STRING, legacy_datetime TIMESTAMP_NTZ, legacy_company_id BIGINT,
        {target}_company_id BIGINT, legacy_contact_id BIGINT, {target}_contact_id BIGINT""",
}
# Columns shared by the four tables.
_TAIL = """
    legacy_properties MAP<STRING,STRING>, properties_to_update MAP<STRING,STRING>,
    reconciliation_status STRING, match_confidence DECIMAL(5,2), notes STRING,
    created_at TIMESTAMP_NTZ, last_updated TIMESTAMP_NTZ"""

# Where each head column comes from: the legacy row's column ("leg")
# or the target row's property ("tgt").
_HEAD_SOURCES = {
    "companies": (
        ("leg", "Comp_Name"), ("tgt", "name"), ("leg", "Comp_WebSite"), ("tgt", "domain"),
    ),
    "contacts": (
        ("leg", "Pers_EmailAddress"), ("tgt", "email"), ("leg", "Pers_FirstName"),
        ("leg", "Pers_LastName"), ("tgt", "firstname"), ("tgt", "lastname"),
        ("leg", "Pers_CompanyId"), ("tgt", "associatedcompanyid"),
    ),
    "deals": (
        ("leg", "Oppo_Description"), ("tgt", "dealname"), ("leg", "Oppo_Forecast"),
        ("tgt", "amount"), ("leg", "Oppo_PrimaryCompanyId"), ("tgt", "associatedcompanyid"),
        ("leg", "Pers_PersonId"), ("tgt", "primary_contact_id"),
    ),
    "engagements": (
        ("leg", "Comm_Type"), ("leg", "Comm_Subject"), ("leg", "Comm_DateTime"),
        ("leg", "Comp_CompanyId"), ("tgt", "associated_company_id"),
        ("leg", "Pers_PersonId"), ("tgt", "associated_contact_id"),
    ),
}

RUN_LOG_DDL = """
operation STRING, entity_type STRING, legacy_id BIGINT, target_id BIGINT, status STRING,
error_message STRING, execution_time_ms BIGINT, timestamp TIMESTAMP_NTZ
"""


def staging_schema(object_type: str, target: str = "target") -> StructType:
    head = _HEADS[object_type_of(object_type)].format(target=target)
    return StructType.fromDDL(f"{head}, {_TAIL}")


def staging_key(object_type: str) -> str:
    return ddl_names(_HEADS[object_type_of(object_type)])[0]


def head_columns(object_type: str, target: str = "target") -> list[tuple[str, str, str]]:
    """(staging column, side, source column) after the two id columns."""
    kind = object_type_of(object_type)
    names = ddl_names(_HEADS[kind].format(target=target))[2:]
    return [(name, side, src) for name, (side, src) in zip(names, _HEAD_SOURCES[kind], strict=True)]


def default_update_columns(object_type: str, target: str = "target") -> tuple[str, ...]:
    """Columns an upsert overwrites; all others keep their first value."""
    names = ddl_names(_HEADS[object_type_of(object_type)].format(target=target))
    return (
        names[1], "properties_to_update", "reconciliation_status", "match_confidence",
        "notes", "last_updated",
    )


def run_log_schema() -> StructType:
    return StructType.fromDDL(RUN_LOG_DDL)
