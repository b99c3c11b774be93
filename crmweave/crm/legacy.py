"""Extraction specs of the seven legacy entities and their relationships."""

from __future__ import annotations

from crmweave.functions.money import net_amount, net_weighted_amount, weighted_forecast
from crmweave.functions.stages import COMPANY_KIND, PERSON_KIND, entity_kind, entity_name
from crmweave.specs import EntitySpec, Lookup, Relationship

# Column names and types of the legacy tables.
COMPANY_DDL = """
Comp_CompanyId BIGINT, Comp_PrimaryPersonId BIGINT, Comp_PrimaryAddressId BIGINT, Comp_Name STRING,
Comp_Type STRING, Comp_Status STRING, Comp_Source STRING, Comp_Territory STRING,
Comp_Revenue STRING, Comp_Employees STRING, Comp_Sector STRING, Comp_WebSite STRING,
Comp_EmailAddress STRING, Comp_PhoneCountryCode STRING, Comp_PhoneAreaCode STRING,
Comp_PhoneNumber STRING, Comp_FaxCountryCode STRING, Comp_FaxAreaCode STRING,
Comp_FaxNumber STRING, Comp_CreatedDate TIMESTAMP_NTZ, Comp_UpdatedDate TIMESTAMP_NTZ,
Comp_CreatedBy BIGINT, Comp_UpdatedBy BIGINT
"""
PERSON_DDL = """
Pers_PersonId BIGINT, Pers_CompanyId BIGINT, Pers_PrimaryAddressId BIGINT, Pers_Salutation STRING,
Pers_FirstName STRING, Pers_LastName STRING, Pers_MiddleName STRING, Pers_Suffix STRING,
Pers_Gender STRING, Pers_Title STRING, Pers_TitleCode STRING, Pers_Type STRING,
Pers_Department STRING, Pers_Status STRING, Pers_Source STRING, Pers_Territory STRING,
Pers_WebSite STRING, Pers_EmailAddress STRING, Pers_PhoneCountryCode STRING,
Pers_PhoneAreaCode STRING, Pers_PhoneNumber STRING, Pers_MobileCountryCode STRING,
Pers_MobileAreaCode STRING, Pers_MobileNumber STRING, Pers_FaxCountryCode STRING,
Pers_FaxAreaCode STRING, Pers_FaxNumber STRING, Pers_CreatedDate TIMESTAMP_NTZ,
Pers_UpdatedDate TIMESTAMP_NTZ, Pers_CreatedBy BIGINT, Pers_UpdatedBy BIGINT
"""
OPPORTUNITY_DDL = """
Oppo_OpportunityId BIGINT, Oppo_Description STRING, Oppo_PrimaryCompanyId BIGINT,
Oppo_PrimaryPersonId BIGINT, Oppo_AssignedUserId BIGINT, Oppo_Type STRING, Oppo_Product STRING,
Oppo_Source STRING, Oppo_Note STRING, Oppo_CustomerRef STRING, Oppo_Status STRING,
Oppo_Stage STRING, Oppo_Forecast DECIMAL(15,2), Oppo_Certainty DECIMAL(5,2),
Oppo_Priority STRING, Oppo_TargetClose TIMESTAMP_NTZ, Oppo_ActualClose TIMESTAMP_NTZ,
Oppo_WinProbability DECIMAL(5,2), Oppo_Total DECIMAL(15,2), oppo_cout DECIMAL(15,2),
Oppo_CreatedDate TIMESTAMP_NTZ, Oppo_UpdatedDate TIMESTAMP_NTZ, Oppo_CreatedBy BIGINT,
Oppo_UpdatedBy BIGINT
"""
CASE_DDL = """
Case_CaseId BIGINT, Case_PrimaryCompanyId BIGINT, Case_PrimaryPersonId BIGINT, Case_AssignedUserId BIGINT,
Case_Description STRING, Case_Status STRING, Case_Stage STRING, Case_Priority STRING,
Case_Opened TIMESTAMP_NTZ, Case_Closed TIMESTAMP_NTZ
"""
COMMUNICATION_DDL = """
Comm_CommunicationId BIGINT, Comm_OpportunityId BIGINT, Comm_CaseId BIGINT, Comm_Type STRING,
Comm_Action STRING, Comm_Status STRING, Comm_Priority STRING, Comm_DateTime TIMESTAMP_NTZ,
Comm_ToDateTime TIMESTAMP_NTZ, Comm_Note STRING, Comm_Subject STRING, Comm_Email STRING,
Comm_CreatedDate TIMESTAMP_NTZ, Comm_UpdatedDate TIMESTAMP_NTZ,
Comm_OriginalDateTime TIMESTAMP_NTZ, Comm_OriginalToDateTime TIMESTAMP_NTZ
"""
SOCIAL_LINK_DDL = """
sone_networklink STRING, Related_TableID INT, Related_RecordID BIGINT, bord_caption STRING,
network_type STRING, sone_network STRING, CreatedDate TIMESTAMP_NTZ, UpdatedDate TIMESTAMP_NTZ
"""
ADDRESS_DDL = """
Addr_AddressId BIGINT, Addr_CompanyId BIGINT, Addr_PersonId BIGINT, Addr_Type STRING,
Addr_Address1 STRING, Addr_Address2 STRING, Addr_Address3 STRING, Addr_City STRING,
Addr_State STRING, Addr_Country STRING, Addr_PostCode STRING, Addr_CountryCode STRING,
Addr_CreatedDate TIMESTAMP_NTZ, Addr_UpdatedDate TIMESTAMP_NTZ
"""

COMPANY = EntitySpec(
    name="Company",
    source="company",
    key="Comp_CompanyId",
    ddl=COMPANY_DDL,
    lookups=(
        Lookup(
            "address",
            on=(("Comp_PrimaryAddressId", "Addr_AddressId"),),
            columns={
                "Address_Id": "Addr_AddressId",
                "Address_Street1": "Addr_Address1",
                "Address_Street2": "Addr_Address2",
                "Address_Street3": "Addr_Address3",
                "Address_City": "Addr_City",
                "Address_State": "Addr_State",
                "Address_Country": "Addr_Country",
                "Address_PostCode": "Addr_PostCode",
            },
        ),
    ),
)

PERSON = EntitySpec(
    name="Person",
    source="person",
    key="Pers_PersonId",
    ddl=PERSON_DDL,
    lookups=(
        Lookup(
            "company",
            on=(("Pers_CompanyId", "Comp_CompanyId"),),
            columns={"Company_Name": "Comp_Name", "Company_WebSite": "Comp_WebSite"},
        ),
        Lookup(
            "address",
            on=(("Pers_PrimaryAddressId", "Addr_AddressId"),),
            columns={
                "Address_Id": "Addr_AddressId",
                "Address_Street1": "Addr_Address1",
                "Address_City": "Addr_City",
                "Address_State": "Addr_State",
                "Address_Country": "Addr_Country",
                "Address_PostCode": "Addr_PostCode",
            },
        ),
    ),
)

OPPORTUNITY = EntitySpec(
    name="Opportunity",
    source="opportunity",
    key="Oppo_OpportunityId",
    ddl=OPPORTUNITY_DDL,
    lookups=(
        Lookup(
            "company",
            on=(("Oppo_PrimaryCompanyId", "Comp_CompanyId"),),
            columns={"Company_Name": "Comp_Name", "Company_WebSite": "Comp_WebSite"},
        ),
        Lookup(
            "person",
            on=(("Oppo_PrimaryPersonId", "Pers_PersonId"),),
            columns={
                "Person_FirstName": "Pers_FirstName",
                "Person_LastName": "Pers_LastName",
                "Person_EmailAddress": "Pers_EmailAddress",
            },
        ),
    ),
    computed={
        "Weighted_Forecast": lambda: weighted_forecast("Oppo_Forecast", "Oppo_Certainty"),
        "Net_Amount": lambda: net_amount("Oppo_Forecast", "oppo_cout"),
        "Net_Weighted_Amount": lambda: net_weighted_amount(
            net_amount("Oppo_Forecast", "oppo_cout"), "Oppo_Certainty"
        ),
    },
)

CASE = EntitySpec(
    name="Case",
    source="case",
    key="Case_CaseId",
    ddl=CASE_DDL,
    require_key=False,
    lookups=(
        Lookup(
            "company",
            on=(("Case_PrimaryCompanyId", "Comp_CompanyId"),),
            columns={"Company_Name": "Comp_Name", "Company_WebSite": "Comp_WebSite"},
        ),
        Lookup(
            "person",
            on=(("Case_PrimaryPersonId", "Pers_PersonId"),),
            columns={"Person_FirstName": "Pers_FirstName", "Person_LastName": "Pers_LastName"},
        ),
        Lookup(
            "email_link",
            on=(("Case_PrimaryPersonId", "ELink_RecordID"),),
            where=(("ELink_EntityID", PERSON_KIND),),
            columns={"Person_EmailAddress": "Emai_EmailAddress"},
            pick="Emai_EmailId",
        ),
    ),
)

# The communication source is already joined: its person and company columns are
# projected under other names.
COMMUNICATION = EntitySpec(
    name="Communication",
    source="communication",
    key="Comm_CommunicationId",
    ddl=COMMUNICATION_DDL,
    renamed={
        "Person_Id": "Pers_PersonId",
        "Person_FirstName": "Pers_FirstName",
        "Person_LastName": "Pers_LastName",
        "Person_EmailAddress": "Pers_EmailAddress",
        "Company_Id": "Comp_CompanyId",
        "Company_Name": "Comp_Name",
        "Case_Description": "Case_Description",
        "Case_CompanyId": "Case_PrimaryCompanyId",
        "Case_PersonId": "Case_PrimaryPersonId",
    },
)

SOCIAL_LINK = EntitySpec(
    name="SocialNetwork",
    source="social_link",
    key="sone_networklink",
    blank_key_is_missing=True,
    ddl=SOCIAL_LINK_DDL,
    lookups=(
        Lookup(
            "party",
            on=(("Related_TableID", "Party_Kind"), ("Related_RecordID", "Party_Id")),
            columns={
                "Company_Name": "Comp_Name",
                "Company_WebSite": "Comp_WebSite",
                "Person_FirstName": "Pers_FirstName",
                "Person_LastName": "Pers_LastName",
            },
        ),
    ),
    computed={
        "entity_type": lambda: entity_kind("Related_TableID"),
        "entity_name": lambda: entity_name(
            "Related_TableID", "Company_Name", "Person_FirstName", "Person_LastName"
        ),
    },
)

ADDRESS = EntitySpec(name="Address", source="address", key="Addr_AddressId", ddl=ADDRESS_DDL)

ENTITIES = {
    spec.name: spec
    for spec in (CASE, COMPANY, PERSON, OPPORTUNITY, COMMUNICATION, SOCIAL_LINK, ADDRESS)
}

# Parents before children, so that a failed parent is known before its children run.
DEPENDENCY_ORDER = (
    "Address", "Company", "Person", "Opportunity", "Case", "Communication", "SocialNetwork",
)

# Which child column points at which parent key.  The 1:many rows of
# the cardinality table are the same links read from the other end.
RELATIONSHIPS = (
    Relationship("address", "Addr_CompanyId", "company", "Comp_CompanyId"),
    Relationship("address", "Addr_PersonId", "person", "Pers_PersonId"),
    Relationship("company", "Comp_PrimaryAddressId", "address", "Addr_AddressId"),
    Relationship("person", "Pers_PrimaryAddressId", "address", "Addr_AddressId"),
    Relationship("communication", "Comm_CaseId", "case", "Case_CaseId"),
    Relationship("person", "Pers_CompanyId", "company", "Comp_CompanyId"),
    Relationship("opportunity", "Oppo_PrimaryCompanyId", "company", "Comp_CompanyId"),
    Relationship("opportunity", "Oppo_PrimaryPersonId", "person", "Pers_PersonId"),
    Relationship("case", "Case_PrimaryCompanyId", "company", "Comp_CompanyId"),
    Relationship("case", "Case_PrimaryPersonId", "person", "Pers_PersonId"),
    Relationship("communication", "Comm_CompanyId", "company", "Comp_CompanyId"),
    Relationship("communication", "Comm_PersonId", "person", "Pers_PersonId"),
    Relationship("communication", "Comm_OpportunityId", "opportunity", "Oppo_OpportunityId"),
    Relationship(
        "social_link", "Related_RecordID", "company", "Comp_CompanyId",
        kind=("Related_TableID", COMPANY_KIND),
    ),
    Relationship(
        "social_link", "Related_RecordID", "person", "Pers_PersonId",
        kind=("Related_TableID", PERSON_KIND),
    ),
)
