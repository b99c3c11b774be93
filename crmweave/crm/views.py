"""Specs of the seven processed (Silver) views: distinct, left joined."""

from __future__ import annotations

from dataclasses import replace

from crmweave.functions.money import net_after_discount, weighted_forecast
from crmweave.functions.text import joined
from crmweave.specs import EntitySpec, Lookup


def _person_name():
    return joined("Pers_FirstName", "Pers_LastName")


_STAMPS = "bronze_extracted_at TIMESTAMP_NTZ, bronze_source_file STRING"

# Columns of the views.
_ADDRESS_COLUMNS = {
    c: c
    for c in (
        "Addr_AddressId", "Addr_Street1", "Addr_Street2", "Addr_City", "Addr_State",
        "Addr_PostCode", "Addr_Country",
    )
}
_COMPANY_COLUMNS = {
    "Comp_CompanyId": "Comp_CompanyId", "Company_Name": "Comp_Name", "Company_Website": "Comp_WebSite",
}
_PERSON_COLUMNS = {
    "Pers_PersonId": "Pers_PersonId", "Person_FirstName": "Pers_FirstName", "Person_LastName": "Pers_LastName",
}

COMPANIES = EntitySpec(
    name="companies", source="company", key="Comp_CompanyId", distinct=True,
    ddl=f"""
    Comp_CompanyId BIGINT, Comp_Name STRING, Comp_WebSite STRING, Comp_Type STRING,
    Comp_Status STRING, Comp_Source STRING, Comp_Territory STRING, Comp_Sector STRING,
    Comp_Revenue STRING, Comp_Employees STRING, Comp_EmailAddress STRING,
    Comp_PhoneCountryCode STRING, Comp_PhoneCityCode STRING, Comp_PhoneNumber STRING,
    Comp_CreatedDate TIMESTAMP_NTZ, Comp_UpdatedDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(Lookup("address", (("Comp_CompanyId", "Addr_CompanyId"),), _ADDRESS_COLUMNS),),
)

PERSONS = EntitySpec(
    name="persons", source="person", key="Pers_PersonId", distinct=True,
    ddl=f"""
    Pers_PersonId BIGINT, Pers_Salutation STRING, Pers_FirstName STRING, Pers_MiddleName STRING,
    Pers_LastName STRING, Pers_EmailAddress STRING, Pers_PhoneCountryCode STRING,
    Pers_PhoneCityCode STRING, Pers_PhoneNumber STRING, Pers_Territory STRING, Pers_Type STRING,
    Pers_Status STRING, Pers_Department STRING, Pers_JobTitle STRING,
    Pers_CreatedDate TIMESTAMP_NTZ, Pers_UpdatedDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(
        Lookup("company", (("Pers_CompanyId", "Comp_CompanyId"),), _COMPANY_COLUMNS),
        Lookup("address", (("Pers_PersonId", "Addr_PersonId"),), _ADDRESS_COLUMNS),
    ),
)

OPPORTUNITIES = EntitySpec(
    name="opportunities", source="opportunity", key="Oppo_OpportunityId", distinct=True,
    ddl=f"""
    Oppo_OpportunityId BIGINT, Oppo_Description STRING, Oppo_Status STRING, Oppo_Stage STRING,
    Oppo_Certainty DECIMAL(5,2), Oppo_Forecast DECIMAL(15,2), Oppo_CloseDate TIMESTAMP_NTZ,
    Oppo_Source STRING, Oppo_Type STRING, Oppo_Territory STRING, Oppo_ProductLine STRING,
    Oppo_EstimatedRevenue DECIMAL(15,2), Oppo_DiscountPercent DECIMAL(5,2), Oppo_Notes STRING,
    Oppo_CreatedDate TIMESTAMP_NTZ, Oppo_UpdatedDate TIMESTAMP_NTZ,
    Oppo_LastActivityDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(
        Lookup("company", (("Oppo_PrimaryCompanyId", "Comp_CompanyId"),), _COMPANY_COLUMNS),
        Lookup("person", (("Oppo_PrimaryPersonId", "Pers_PersonId"),), _PERSON_COLUMNS),
    ),
    computed={
        "Weighted_Forecast": lambda: weighted_forecast("Oppo_Forecast", "Oppo_Certainty", "percent"),
        "Net_Amount": lambda: net_after_discount("Oppo_EstimatedRevenue", "Oppo_DiscountPercent"),
    },
)

COMMUNICATIONS = EntitySpec(
    name="communications", source="communication", key="Comm_CommunicationId", distinct=True,
    ddl=f"""
    Comm_CommunicationId BIGINT, Comm_Type STRING, Comm_Action STRING, Comm_Status STRING,
    Comm_Subject STRING, Comm_Note STRING, Comm_OriginalDateTime TIMESTAMP_NTZ,
    Comm_DateTime TIMESTAMP_NTZ, Comm_Priority STRING, Comm_CreatedDate TIMESTAMP_NTZ,
    Comm_UpdatedDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(
        Lookup(
            "company", (("Comm_CompanyId", "Comp_CompanyId"),),
            {"Comp_CompanyId": "Comp_CompanyId", "Company_Name": "Comp_Name"},
        ),
        Lookup(
            "person", (("Comm_PersonId", "Pers_PersonId"),),
            {"Pers_PersonId": "Pers_PersonId", "Person_FullName": _person_name},
        ),
        Lookup(
            "opportunity", (("Comm_OpportunityId", "Oppo_OpportunityId"),),
            {"Oppo_OpportunityId": "Oppo_OpportunityId", "Opportunity_Description": "Oppo_Description"},
        ),
    ),
)

CASES = EntitySpec(
    name="cases", source="case", key="Case_CaseId", distinct=True,
    ddl=f"""
    Case_CaseId BIGINT, Case_Reference STRING, Case_Status STRING, Case_Type STRING,
    Case_Priority STRING, Case_Severity STRING, Case_Origin STRING, Case_Subject STRING,
    Case_Description STRING, Case_Resolution STRING, Case_OpenedDate TIMESTAMP_NTZ,
    Case_ClosedDate TIMESTAMP_NTZ, Case_ResponseTime STRING, Case_ResolutionTime STRING,
    Case_SLAStatus STRING, Case_Product STRING, Case_Category STRING, Case_Subcategory STRING,
    Case_AssignedTo STRING, Case_CreatedDate TIMESTAMP_NTZ, Case_UpdatedDate TIMESTAMP_NTZ,
    {_STAMPS}""",
    lookups=(
        Lookup("company", (("Case_PrimaryCompanyId", "Comp_CompanyId"),), _COMPANY_COLUMNS),
        Lookup("person", (("Case_PrimaryPersonId", "Pers_PersonId"),), _PERSON_COLUMNS),
    ),
)

SOCIAL_NETWORKS = EntitySpec(
    name="social_networks", source="social_network", key="SoN_SocialNetworkId", distinct=True,
    ddl=f"""
    SoN_SocialNetworkId BIGINT, SoN_Platform STRING, SoN_ProfileURL STRING, SoN_Username STRING,
    SoN_FollowerCount BIGINT, SoN_ConnectionCount BIGINT, SoN_Verified BOOLEAN,
    SoN_CreatedDate TIMESTAMP_NTZ, SoN_UpdatedDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(Lookup("person", (("SoN_PersonId", "Pers_PersonId"),), _PERSON_COLUMNS),),
)

ADDRESSES = EntitySpec(
    name="addresses", source="address", key="Addr_AddressId", distinct=True,
    ddl=f"""
    Addr_AddressId BIGINT, Addr_Type STRING, Addr_Street1 STRING, Addr_Street2 STRING,
    Addr_City STRING, Addr_State STRING, Addr_PostCode STRING, Addr_Country STRING,
    Addr_CreatedDate TIMESTAMP_NTZ, Addr_UpdatedDate TIMESTAMP_NTZ, {_STAMPS}""",
    lookups=(
        Lookup(
            "company", (("Addr_CompanyId", "Comp_CompanyId"),),
            {"Comp_CompanyId": "Comp_CompanyId", "Company_Name": "Comp_Name"},
        ),
        Lookup(
            "person", (("Addr_PersonId", "Pers_PersonId"),),
            {"Pers_PersonId": "Pers_PersonId", "Person_FullName": _person_name},
        ),
    ),
)

# Names the extracted tables use for columns of the views.
ALIASES = {
    "Addr_Street1": ("Addr_Address1", "Address_Street1"),
    "Addr_Street2": ("Addr_Address2", "Address_Street2"),
    "Comp_PhoneCityCode": ("Comp_PhoneAreaCode",),
    "Pers_PhoneCityCode": ("Pers_PhoneAreaCode",),
    "Pers_JobTitle": ("Pers_Title",),
    "Oppo_Notes": ("Oppo_Note",),
    "Oppo_CloseDate": ("Oppo_ActualClose",),
    "Comm_CompanyId": ("Company_Id", "Comp_CompanyId"),
    "Comm_PersonId": ("Person_Id", "Pers_PersonId"),
    "Case_OpenedDate": ("Case_Opened",),
    "Case_ClosedDate": ("Case_Closed",),
}

VIEWS = {
    v.name: replace(v, aliases=ALIASES)
    for v in (COMPANIES, PERSONS, OPPORTUNITIES, COMMUNICATIONS, CASES, SOCIAL_NETWORKS, ADDRESSES)
}
