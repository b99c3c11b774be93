"""Target-CRM objects: columns to read and the mapping from legacy entities."""

from __future__ import annotations

from crmweave.specs import EntitySpec, FieldMap, ObjectMap

# Property names and types of the target objects.  The crosswalk
# column that carries the legacy id is named by the caller.
CONTACTS_DDL = """
hs_object_id BIGINT, firstname STRING, lastname STRING, email STRING, phone STRING,
mobilephone STRING, jobtitle STRING, department STRING, salutation STRING, company STRING,
associatedcompanyid BIGINT, address STRING, city STRING, state STRING, country STRING,
zip STRING, {crosswalk} STRING, createdate TIMESTAMP_NTZ, lastmodifieddate TIMESTAMP_NTZ,
hs_lastmodifieddate TIMESTAMP_NTZ
"""
COMPANIES_DDL = """
hs_object_id BIGINT, name STRING, domain STRING, website STRING, phone STRING, address STRING,
city STRING, state STRING, country STRING, zip STRING, industry STRING, type STRING,
numberofemployees STRING, annualrevenue STRING, hs_lead_source STRING, territory STRING,
{crosswalk} STRING, createdate TIMESTAMP_NTZ, hs_lastmodifieddate TIMESTAMP_NTZ
"""
DEALS_DDL = """
hs_object_id BIGINT, dealname STRING, amount DECIMAL(15,2), dealstage STRING, pipeline STRING,
closedate TIMESTAMP_NTZ, createdate TIMESTAMP_NTZ, hs_lastmodifieddate TIMESTAMP_NTZ,
dealtype STRING, deal_status STRING, deal_certainty STRING, deal_priority STRING,
deal_source STRING, deal_brand STRING, deal_notes STRING, company STRING,
associatedcompanyid BIGINT, {crosswalk} STRING
"""
ENGAGEMENTS_DDL = """
hs_object_id BIGINT, hs_engagement_type STRING, hs_timestamp TIMESTAMP_NTZ,
hs_engagement_subject STRING, hs_note_body STRING, hs_engagement_status STRING,
hs_call_direction STRING, hs_call_duration STRING, hs_meeting_title STRING,
hs_email_subject STRING, associated_company_id BIGINT, associated_contact_id BIGINT,
associated_deal_id BIGINT, {crosswalk} STRING, createdate TIMESTAMP_NTZ,
hs_lastmodifieddate TIMESTAMP_NTZ
"""

CROSSWALK_SUFFIX = {
    "companies": "company_id",
    "contacts": "contact_id",
    "deals": "deal_id",
    "engagements": "communication_id",
}
ALIASES = {"communications": "engagements"}
OBJECT_ORDER = ("companies", "contacts", "deals", "engagements")


def object_type_of(name: str) -> str:
    """Canonical object type; ``communications`` are stored as ``engagements``."""
    name = ALIASES.get(name, name)
    if name not in CROSSWALK_SUFFIX:
        raise ValueError(f"unknown object type {name!r}; known: {sorted(CROSSWALK_SUFFIX)}")
    return name


def crosswalk_column(object_type: str, prefix: str = "legacy") -> str:
    return f"{prefix}_{CROSSWALK_SUFFIX[object_type_of(object_type)]}"


def target_entity(object_type: str, crosswalk: str | None = None) -> EntitySpec:
    """Spec for scanning a target object: rows that carry a crosswalk id, ordered."""
    kind = object_type_of(object_type)
    ddl = {
        "contacts": CONTACTS_DDL,
        "companies": COMPANIES_DDL,
        "deals": DEALS_DDL,
        "engagements": ENGAGEMENTS_DDL,
    }[kind]
    crosswalk = crosswalk or crosswalk_column(kind)
    order = ("-hs_timestamp", "hs_object_id") if kind == "engagements" else ("hs_object_id",)
    return EntitySpec(
        name=kind, source=kind, key=crosswalk, ddl=ddl.format(crosswalk=crosswalk), order_by=order
    )


# Legacy column -> target property, in declaration order.
# Aliases are the names the extraction specs give to the same legacy column.
_COMPANY_FIELDS = (
    FieldMap("Comp_Name", "name", required=True),
    FieldMap("Comp_WebSite", "domain"),
    FieldMap("Comp_WebSite", "website"),
    FieldMap("Comp_PhoneNumber", "phone", aliases=("Company_Phone",)),
    FieldMap("Comp_Type", "type"),
    FieldMap("Comp_Territory", "territory"),
    FieldMap("Comp_Sector", "industry"),
    FieldMap("Comp_Employees", "numberofemployees"),
    FieldMap("Comp_Revenue", "annualrevenue"),
    FieldMap("Comp_Source", "hs_lead_source"),
    FieldMap("Addr_City", "city", aliases=("Address_City",)),
    FieldMap("Addr_State", "state", aliases=("Address_State",)),
    FieldMap("Addr_Country", "country", aliases=("Address_Country",)),
    FieldMap("Addr_PostCode", "zip", aliases=("Address_PostCode",)),
    FieldMap("Addr_Street1", "address", aliases=("Address_Street1", "Addr_Address1")),
    FieldMap("Comp_CreatedDate", "createdate"),
)
_CONTACT_FIELDS = (
    FieldMap("Pers_FirstName", "firstname", required=True),
    FieldMap("Pers_LastName", "lastname", required=True),
    FieldMap("Pers_EmailAddress", "email", aliases=("Person_Email",)),
    FieldMap("Pers_PhoneNumber", "phone", aliases=("Person_Phone",)),
    FieldMap("Pers_MobileNumber", "mobilephone"),
    FieldMap("Pers_Title", "jobtitle"),
    FieldMap("Pers_Department", "department"),
    FieldMap("Pers_Salutation", "salutation"),
    FieldMap("Pers_CompanyId", "associatedcompanyid", refers="companies"),
    FieldMap("Comp_Name", "company", aliases=("Company_Name",)),
    FieldMap("Addr_City", "city", aliases=("Address_City",)),
    FieldMap("Addr_State", "state", aliases=("Address_State",)),
    FieldMap("Addr_Country", "country", aliases=("Address_Country",)),
    FieldMap("Addr_PostCode", "zip", aliases=("Address_PostCode",)),
    FieldMap("Addr_Street1", "address", aliases=("Address_Street1", "Addr_Address1")),
    FieldMap("Pers_CreatedDate", "createdate"),
)
_DEAL_FIELDS = (
    FieldMap("Oppo_Description", "dealname", required=True),
    FieldMap("Oppo_Forecast", "amount"),
    FieldMap("Oppo_Stage", "dealstage"),
    FieldMap("Oppo_Status", "deal_status"),
    FieldMap("Oppo_Certainty", "deal_certainty"),
    FieldMap("Oppo_Type", "dealtype"),
    FieldMap("Oppo_Source", "deal_source"),
    FieldMap("Oppo_TargetClose", "closedate"),
    FieldMap("Oppo_ActualClose", "actual_close_date"),
    FieldMap("Oppo_Priority", "deal_priority"),
    FieldMap("Oppo_Product", "deal_brand"),
    FieldMap("Oppo_Note", "deal_notes"),
    FieldMap("Oppo_PrimaryCompanyId", "associatedcompanyid", refers="companies"),
    FieldMap("Comp_Name", "company", aliases=("Company_Name",)),
    FieldMap("Pers_PersonId", "primary_contact_id", aliases=("Oppo_PrimaryPersonId",), refers="contacts"),
    FieldMap("Oppo_CreatedDate", "createdate"),
)
_ENGAGEMENT_FIELDS = (
    FieldMap("Comm_Subject", "hs_engagement_subject"),
    FieldMap("Comm_Note", "hs_note_body"),
    FieldMap("Comm_DateTime", "hs_timestamp"),
    FieldMap("Comm_Type", "hs_engagement_type"),
    FieldMap("Comm_Action", "hs_call_direction"),
    FieldMap("Comm_Status", "hs_engagement_status"),
    FieldMap("Comm_OriginalDateTime", "hs_original_datetime"),
    FieldMap("Comm_OpportunityId", "associated_deal_id", refers="deals"),
    FieldMap("Comm_CaseId", "associated_ticket_id"),
    FieldMap("Comp_CompanyId", "associated_company_id", aliases=("Company_Id", "Comm_CompanyId"), refers="companies"),
    FieldMap("Pers_PersonId", "associated_contact_id", aliases=("Person_Id", "Comm_PersonId"), refers="contacts"),
)

# Per object the legacy entity, its id, the fields and the target
# properties that must be present ("{crosswalk}" stands for the crosswalk column).
_OBJECTS = {
    "companies": (
        "Company", "Comp_CompanyId", _COMPANY_FIELDS,
        ("hs_object_id", "name", "{crosswalk}", "domain", "city", "country"),
    ),
    "contacts": (
        "Person", "Pers_PersonId", _CONTACT_FIELDS,
        ("hs_object_id", "firstname", "lastname", "email", "{crosswalk}", "company"),
    ),
    "deals": (
        "Opportunity", "Oppo_OpportunityId", _DEAL_FIELDS,
        ("hs_object_id", "dealname", "{crosswalk}", "amount", "dealstage", "company"),
    ),
    "engagements": (
        "Communication", "Comm_CommunicationId", _ENGAGEMENT_FIELDS,
        ("hs_object_id", "hs_engagement_subject", "hs_timestamp", "hs_engagement_type"),
    ),
}


def object_map(object_type: str, crosswalk: str | None = None) -> ObjectMap:
    """Mapping of one object type (``communications`` is accepted for engagements)."""
    kind = object_type_of(object_type)
    entity, legacy_id, fields, required = _OBJECTS[kind]
    crosswalk = crosswalk or crosswalk_column(kind)
    return ObjectMap(
        object_type=kind,
        legacy_entity=entity,
        legacy_id=legacy_id,
        target_id="hs_object_id",
        crosswalk=crosswalk,
        fields=fields,
        required=tuple(crosswalk if c == "{crosswalk}" else c for c in required),
    )
