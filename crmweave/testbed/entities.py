"""Queries: extraction, projection, filters, views, joins and contact points."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crmweave.crm.legacy import ENTITIES, RELATIONSHIPS
from crmweave.crm.target import object_map, target_entity
from crmweave.functions.dates import newer_than
from crmweave.functions.money import (
    net_after_discount, net_amount, net_weighted_amount, weighted_forecast, with_deal_amounts,
)
from crmweave.functions.names import conform, with_snake_names
from crmweave.functions.stages import final_stage, priority_score, stage_number, status_category
from crmweave.functions.text import email_valid, joined, sanitize
from crmweave.operators import contact, project, search
from crmweave.operators.autojoin import auto_join
from crmweave.operators.lookup import left_lookup, with_group_count
from crmweave.plans.extraction import companies_with_contacts, persons_with_contacts
from crmweave.plans.processed import layered_opportunities, processed_view, social_links
from crmweave.session import shared_folder
from crmweave.sources.readers import read_csv, register, run_sql
from crmweave.sources.writers import write_bronze
from crmweave.testbed.registry import query
from crmweave.testbed.roles import base, role, roles

# --------------------------------------------------------------------------
# Extraction of the seven entities

COMPANY_SQL = """
    SELECT Comp_CompanyId, Comp_PrimaryPersonId, Comp_PrimaryAddressId, Comp_Name, Comp_Type,
           Comp_Status, Comp_Territory, Comp_Revenue, Comp_Sector, Comp_WebSite, Comp_EmailAddress,
           Comp_PhoneNumber, Addr_AddressId AS Address_Id, Addr_Address1 AS Address_Street1,
           Addr_City AS Address_City, Addr_Country AS Address_Country, Addr_PostCode AS Address_PostCode
    FROM company LEFT JOIN address ON Comp_PrimaryAddressId = Addr_AddressId
    WHERE Comp_CompanyId IS NOT NULL"""
PERSON_SQL = """
    SELECT Pers_PersonId, Pers_CompanyId, Pers_PrimaryAddressId, Pers_FirstName, Pers_LastName,
           Pers_Status, Pers_Territory, Pers_EmailAddress, Pers_PhoneNumber,
           Comp_Name AS Company_Name, Comp_WebSite AS Company_WebSite,
           Addr_AddressId AS Address_Id, Addr_Address1 AS Address_Street1, Addr_City AS Address_City,
           Addr_Country AS Address_Country, Addr_PostCode AS Address_PostCode
    FROM person LEFT JOIN company ON Pers_CompanyId = Comp_CompanyId
         LEFT JOIN address ON Pers_PrimaryAddressId = Addr_AddressId
    WHERE Pers_PersonId IS NOT NULL"""
OPPORTUNITY_SQL = """
    SELECT Oppo_OpportunityId, Oppo_Description, Oppo_PrimaryCompanyId, Oppo_PrimaryPersonId,
           Oppo_Status, Oppo_Stage, CAST(Oppo_Forecast AS DOUBLE) AS Oppo_Forecast,
           CAST(Oppo_Certainty AS DOUBLE) AS Oppo_Certainty, Oppo_Priority, Oppo_TargetClose,
           CAST(oppo_cout AS DOUBLE) AS oppo_cout, Oppo_CreatedDate,
           Comp_Name AS Company_Name, Comp_WebSite AS Company_WebSite,
           Pers_FirstName AS Person_FirstName, Pers_LastName AS Person_LastName,
           Pers_EmailAddress AS Person_EmailAddress,
           CAST(Oppo_Forecast * Oppo_Certainty AS DOUBLE) AS Weighted_Forecast,
           CAST(Oppo_Forecast - oppo_cout AS DOUBLE) AS Net_Amount,
           CAST((Oppo_Forecast - oppo_cout) * Oppo_Certainty AS DOUBLE) AS Net_Weighted_Amount
    FROM opportunity LEFT JOIN company ON Oppo_PrimaryCompanyId = Comp_CompanyId
         LEFT JOIN person ON Oppo_PrimaryPersonId = Pers_PersonId
    WHERE Oppo_OpportunityId IS NOT NULL"""
CASE_SQL = """
    SELECT Case_CaseId, Case_PrimaryCompanyId, Case_PrimaryPersonId, Case_Description, Case_Status,
           Case_Priority, Case_Opened, Case_Closed, Comp_Name AS Company_Name,
           Comp_WebSite AS Company_WebSite, Pers_FirstName AS Person_FirstName,
           Pers_LastName AS Person_LastName, Emai_EmailAddress AS Person_EmailAddress
    FROM "case" LEFT JOIN company ON Case_PrimaryCompanyId = Comp_CompanyId
         LEFT JOIN person ON Case_PrimaryPersonId = Pers_PersonId
         LEFT JOIN (SELECT ELink_RecordID, arg_min(Emai_EmailAddress, Emai_EmailId) AS Emai_EmailAddress
                    FROM email_link WHERE ELink_EntityID = 13 GROUP BY ELink_RecordID) AS first_mail
              ON Case_PrimaryPersonId = ELink_RecordID"""


def entity(name, *tables):
    def run(spark, d):
        return project.project_entity(roles(spark, d, *tables), ENTITIES[name], missing="skip")

    return run


query("q_entity_company", COMPANY_SQL, "company", "address")(entity("Company", "company", "address"))
query("q_entity_person", PERSON_SQL, "person", "company", "address")(
    entity("Person", "person", "company", "address")
)
query("q_entity_opportunity", OPPORTUNITY_SQL, "opportunity", "company", "person")(
    entity("Opportunity", "opportunity", "company", "person")
)
query("q_entity_case", CASE_SQL, "case", "company", "person", "email_link")(
    entity("Case", "case", "company", "person", "email_link")
)
query(
    "q_entity_address",
    """SELECT Addr_AddressId, Addr_CompanyId, Addr_PersonId, Addr_Type, Addr_Address1, Addr_City, Addr_Country,
              Addr_PostCode
       FROM address WHERE Addr_AddressId IS NOT NULL""",
    "address",
)(entity("Address", "address"))


@query("q_entity_case_open", CASE_SQL + " WHERE Case_Status = 'Open'", "case", "company", "person", "email_link")
def _(spark, d):
    tables = roles(spark, d, "case", "company", "person", "email_link")
    return project.project_entity(tables, ENTITIES["Case"], "AND Case_Status = 'Open'", missing="skip")


@query(
    "q_entity_communication",
    """SELECT Comm_CommunicationId, Comm_OpportunityId, Comm_CaseId, Comm_Type, Comm_Action, Comm_Status,
              Comm_Priority, Comm_DateTime, Comm_Note, Comm_Subject, Comm_OriginalDateTime,
              Pers_PersonId AS Person_Id, Pers_FirstName AS Person_FirstName,
              Pers_LastName AS Person_LastName, Pers_EmailAddress AS Person_EmailAddress,
              Comp_CompanyId AS Company_Id, Comp_Name AS Company_Name
       FROM calendar WHERE Comm_CommunicationId IS NOT NULL""",
    "calendar",
)
def _(spark, d):
    tables = {"communication": role(spark, d, "calendar")}
    return project.project_entity(tables, ENTITIES["Communication"], missing="skip")


@query(
    "q_entity_social_network",
    """SELECT sone_networklink, Related_TableID, Related_RecordID, bord_caption, network_type, CreatedDate,
              Comp_Name AS Company_Name, Comp_WebSite AS Company_WebSite,
              Pers_FirstName AS Person_FirstName, Pers_LastName AS Person_LastName,
              CASE Related_TableID WHEN 5 THEN 'Company' WHEN 13 THEN 'Person' ELSE 'Unknown' END AS entity_type,
              CASE Related_TableID WHEN 5 THEN Comp_Name
                   WHEN 13 THEN coalesce(Pers_FirstName, '') || ' ' || coalesce(Pers_LastName, '')
                   ELSE 'Unknown' END AS entity_name
       FROM social_link
            LEFT JOIN company ON Related_TableID = 5 AND Related_RecordID = Comp_CompanyId
            LEFT JOIN person ON Related_TableID = 13 AND Related_RecordID = Pers_PersonId
       WHERE sone_networklink IS NOT NULL AND sone_networklink <> ''""",
    "social_link", "company", "person",
)
def _(spark, d):
    t = roles(spark, d, "social_link", "company", "person")
    t["party"] = project.party_lookup(t["company"], t["person"])
    return project.project_entity(t, ENTITIES["SocialNetwork"], missing="skip")


@query(
    "q_social_network",
    """SELECT sone_networklink, Related_TableID, Related_RecordID, Comp_Name, Comp_WebSite,
              Pers_FirstName, Pers_LastName,
              CASE Related_TableID WHEN 5 THEN 'Company' WHEN 13 THEN 'Person' ELSE 'Unknown' END AS entity_type,
              CASE Related_TableID WHEN 5 THEN Comp_Name
                   WHEN 13 THEN coalesce(Pers_FirstName, '') || ' ' || coalesce(Pers_LastName, '')
                   ELSE 'Unknown' END AS entity_name
       FROM social_link
            LEFT JOIN company ON Related_TableID = 5 AND Related_RecordID = Comp_CompanyId
            LEFT JOIN person ON Related_TableID = 13 AND Related_RecordID = Pers_PersonId
       WHERE sone_networklink <> ''""",
    "social_link", "company", "person",
)
def _(spark, d):
    t = roles(spark, d, "social_link", "company", "person")
    links = t["social_link"].select("sone_networklink", "Related_TableID", "Related_RecordID")
    return social_links(links, t["company"], t["person"])


# --------------------------------------------------------------------------
# Sources, previews, provenance

@query(
    "q_bronze_roundtrip",
    # A note with line breaks, quotes, commas and backslashes, as CRM notes have them.
    """SELECT Comp_CompanyId, Comp_Name, Comp_Type, Comp_WebSite, Comp_PhoneNumber, Comp_Revenue,
              'Says "' || Comp_Name || '",' || chr(10) || 'C:\\new' || chr(13) || chr(10) || ' end' AS Comp_Note
       FROM company""",
    "company",
)
def _(spark, d):
    columns = ["Comp_CompanyId", "Comp_Name", "Comp_Type", "Comp_WebSite", "Comp_PhoneNumber", "Comp_Revenue"]
    note = F.concat(F.lit('Says "'), "Comp_Name", F.lit('",\nC:\\new\r\n end'))
    company = role(spark, d, "company").select(*columns, note.alias("Comp_Note"))
    path = f"{shared_folder(spark)}/bronze-{uuid.uuid4().hex}"
    write_bronze(company, path, "csv")
    return read_csv(spark, path, company.schema, escaped=True)


@query(
    "q_sql_status_counts",
    """SELECT Case_Status AS status, count(*) AS n FROM "case"
       WHERE Case_Priority <> 'Low' GROUP BY Case_Status""",
    "case",
)
def _(spark, d):
    register({"crm_cases": role(spark, d, "case")})
    return run_sql(
        spark,
        """SELECT Case_Status AS status, count(*) AS n FROM crm_cases
           WHERE Case_Priority <> :ignored GROUP BY Case_Status""",
        ignored="Low",
    )


@query("q_preview", OPPORTUNITY_SQL + " ORDER BY Oppo_OpportunityId LIMIT 5", "opportunity", "company", "person")
def _(spark, d):
    tables = roles(spark, d, "opportunity", "company", "person")
    return project.project_entity(tables, ENTITIES["Opportunity"], limit=5, missing="skip")


@query(
    "q_sample_records",
    """SELECT CAST(to_json({'Comp_CompanyId': Comp_CompanyId, 'Comp_Name': Comp_Name, 'Comp_Type': Comp_Type})
                   AS STRING) AS record
       FROM company ORDER BY Comp_CompanyId LIMIT 3""",
    "company",
)
def _(spark, d):
    company = role(spark, d, "company").select("Comp_CompanyId", "Comp_Name", "Comp_Type")
    return project.sample_records(company, "Comp_CompanyId")


@query(
    "q_provenance",
    """SELECT Pers_PersonId, Pers_FirstName, TIMESTAMP '2024-02-01 00:00:00' AS bronze_extracted_at,
              'person' AS bronze_source_file, (SELECT count(*) FROM person) AS _record_count
       FROM person""",
    "person",
)
def _(spark, d):
    people = role(spark, d, "person").select("Pers_PersonId", "Pers_FirstName")
    return project.stamp_provenance(people, "2024-02-01 00:00:00", "person", record_count=True)


@query(
    "q_target_scan",
    """SELECT hs_object_id, name, domain, type, industry, city, country, annualrevenue, legacy_company_id
       FROM companies WHERE legacy_company_id IS NOT NULL""",
    "companies",
)
def _(spark, d):
    return project.scan_target(role(spark, d, "companies"), target_entity("companies"))


@query(
    "q_target_required",
    """SELECT hs_object_id, name, legacy_company_id, domain, city, country FROM companies""",
    "companies",
)
def _(spark, d):
    return project.select_properties(role(spark, d, "companies"), object_map("companies"), required_only=True)


@query(
    "q_recent_comms",
    """SELECT hs_object_id, hs_engagement_type, hs_timestamp, hs_engagement_subject, hs_note_body,
              associated_company_id, associated_contact_id, legacy_communication_id
       FROM engagements WHERE legacy_communication_id IS NOT NULL
       ORDER BY hs_timestamp DESC NULLS FIRST, hs_object_id LIMIT 100""",
    "engagements",
)
def _(spark, d):
    return project.scan_target(role(spark, d, "engagements"), target_entity("communications"), limit=100)


# --------------------------------------------------------------------------
# Names and renaming

@query(
    "q_rename_to_target",
    f"""SELECT Comp_CompanyId AS legacy_id, Comp_Name AS name, Comp_WebSite AS domain,
               Comp_WebSite AS website, Comp_PhoneNumber AS phone, Comp_Type AS type,
               Comp_Territory AS territory, Comp_Sector AS industry, Comp_Revenue AS annualrevenue,
               Address_City AS city, Address_Country AS country, Address_PostCode AS zip,
               Address_Street1 AS address
        FROM ({COMPANY_SQL}) AS extracted""",
    "company", "address",
)
def _(spark, d):
    legacy = entity("Company", "company", "address")(spark, d)
    return project.rename_to_target(legacy, object_map("companies"))


@query(
    "q_conform_schema",
    """SELECT Case_CaseId AS case_id, Case_Status AS status, Case_Opened AS opened,
              Case_PrimaryCompanyId AS primary_company_id, Case_Priority AS PRIORITY
       FROM "case" """,
    "case",
)
def _(spark, d):
    wanted = StructType.fromDDL(
        "case_id BIGINT, status STRING, opened TIMESTAMP_NTZ, primary_company_id BIGINT, PRIORITY STRING"
    )
    return conform(role(spark, d, "case"), wanted)


@query(
    "q_snake_names",
    """SELECT Case_CaseId AS case_id, Case_PrimaryCompanyId AS case_primary_company_id,
              Case_PrimaryPersonId AS case_primary_person_id, Case_Description AS case_description,
              Case_Status AS case_status, Case_Priority AS case_priority, Case_Opened AS case_opened,
              Case_Closed AS case_closed
       FROM "case" """,
    "case",
)
def _(spark, d):
    return with_snake_names(role(spark, d, "case"))


# --------------------------------------------------------------------------
# Filters and searches

@query(
    "q_any_crosswalk",
    """SELECT hs_object_id, legacy_contact_id, legacy_company_id FROM contacts
       WHERE legacy_contact_id IS NOT NULL OR legacy_company_id IS NOT NULL OR legacy_deal_id IS NOT NULL""",
    "contacts",
)
def _(spark, d):
    found = project.any_crosswalk(
        role(spark, d, "contacts"), ["legacy_contact_id", "legacy_company_id", "legacy_deal_id"]
    )
    return found.select("hs_object_id", "legacy_contact_id", "legacy_company_id")


@query(
    "q_search_contacts",
    """SELECT hs_object_id, firstname, lastname, email, company, associatedcompanyid, city, country,
              legacy_contact_id
       FROM contacts
       WHERE (lower(company) LIKE '%former%' OR email = 'p7@mail.example' OR legacy_contact_id = '9'
              OR (lower(firstname) LIKE '%suppl%' AND lower(lastname) LIKE '%00001%'))
         AND legacy_contact_id IS NOT NULL
       ORDER BY hs_object_id LIMIT 100""",
    "contacts",
)
def _(spark, d):
    return search.search(
        role(spark, d, "contacts"), "contacts", company="FORMER", email="p7@mail.example",
        legacy_contact_id="9", firstname="Suppl", lastname="00001",
    )


@query(
    "q_search_companies",
    """SELECT hs_object_id, name, domain, city, country, industry, annualrevenue, legacy_company_id
       FROM companies
       WHERE (contains(lower(name), 'customer#00000001') OR domain = 'www.customer-000000002.example')
         AND legacy_company_id IS NOT NULL
       ORDER BY hs_object_id LIMIT 100""",
    "companies",
)
def _(spark, d):
    return search.search(
        role(spark, d, "companies"), "companies", name="CUSTOMER#00000001",
        domain="www.customer-000000002.example", legacy_company_id="",
    )


@query(
    "q_search_deals",
    """SELECT hs_object_id, dealname, CAST(amount AS DOUBLE) AS amount, dealstage, createdate,
              associatedcompanyid, legacy_deal_id
       FROM deals WHERE (lower(dealname) LIKE '%order 77%' OR dealstage = '05 - LOW')
         AND legacy_deal_id IS NOT NULL
       ORDER BY hs_object_id LIMIT 100""",
    "deals",
)
def _(spark, d):
    return search.search(role(spark, d, "deals"), "deals", dealname="order 77", dealstage="05 - LOW")


@query(
    "q_search_comms",
    """SELECT hs_object_id, hs_engagement_subject, hs_note_body, hs_timestamp, hs_engagement_type,
              associated_company_id, associated_contact_id, legacy_communication_id
       FROM engagements WHERE (legacy_communication_id = '15' OR associated_company_id = 7)
         AND legacy_communication_id IS NOT NULL
       ORDER BY hs_object_id LIMIT 100""",
    "engagements",
)
def _(spark, d):
    return search.search(
        role(spark, d, "engagements"), "communications", legacy_communication_id="15", associated_company_id=7
    )


@query(
    "q_lookup_by_legacy_id",
    # An id that is padded and went through a float, and one that did not.
    """SELECT hs_object_id, name, city FROM companies
       WHERE nullif(regexp_replace(trim(legacy_company_id), '\\.0$', ''), '') IN ('3', '6')""",
    "companies",
)
def _(spark, d):
    companies = role(spark, d, "companies")
    found = [search.lookup_by_legacy_id(companies, "companies", i).select("hs_object_id", "name", "city") for i in (3, " 6.0")]
    return found[0].unionByName(found[1])


@query(
    "q_high_value",
    """SELECT hs_object_id, dealname, CAST(amount AS DOUBLE) AS amount, legacy_deal_id FROM deals
       WHERE amount > 100000 AND legacy_deal_id IS NOT NULL
       ORDER BY deals.amount DESC, hs_object_id LIMIT 50""",
    "deals",
)
def _(spark, d):
    return search.high_value(role(spark, d, "deals"), 100000)


@query(
    "q_recent_months",
    """SELECT Oppo_OpportunityId, Oppo_CreatedDate FROM opportunity
       WHERE Oppo_CreatedDate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 6 MONTH""",
    "opportunity",
)
def _(spark, d):
    df = role(spark, d, "opportunity").select("Oppo_OpportunityId", "Oppo_CreatedDate")
    return df.where(newer_than("Oppo_CreatedDate", "2001-08-01 00:00:00", months=6))


@query(
    "q_exists_filter",
    """SELECT hs_object_id, email, legacy_contact_id FROM contacts
       WHERE legacy_contact_id IS NOT NULL
          OR EXISTS (SELECT 1 FROM events WHERE user_id = associatedcompanyid AND event_type = 'purchase')""",
    "contacts",
)
def _(spark, d):
    tags = base(spark, d, "events").where("event_type = 'purchase'")
    found = search.linked_or_tagged(
        role(spark, d, "contacts"), tags, ("associatedcompanyid", "user_id"), "legacy_contact_id"
    )
    return found.select("hs_object_id", "email", "legacy_contact_id")


@query(
    "q_link_kind",
    "SELECT Emai_EmailId, ELink_RecordID, Emai_EmailAddress FROM email_link WHERE ELink_EntityID = 13",
    "email_link",
)
def _(spark, d):
    return project.of_kind(role(spark, d, "email_link"), "ELink_EntityID", 13).select(
        "Emai_EmailId", "ELink_RecordID", "Emai_EmailAddress"
    )


# --------------------------------------------------------------------------
# Processed views

_PERSON_NAME = "coalesce(Pers_FirstName, '') || ' ' || coalesce(Pers_LastName, '')"
VIEW_SQL = {
    "companies": (
        """SELECT DISTINCT Comp_CompanyId, Comp_Name, Comp_WebSite, Comp_Type, Comp_Status, Comp_Territory,
                  Comp_Sector, Comp_Revenue, Comp_EmailAddress, Comp_PhoneNumber, Addr_AddressId,
                  Addr_Address1 AS Addr_Street1, Addr_City, Addr_PostCode, Addr_Country
           FROM company LEFT JOIN address ON Comp_CompanyId = Addr_CompanyId
           WHERE Comp_CompanyId IS NOT NULL""",
        ("company", "address"),
    ),
    "persons": (
        """SELECT DISTINCT Pers_PersonId, Pers_FirstName, Pers_LastName, Pers_EmailAddress, Pers_PhoneNumber,
                  Pers_Territory, Pers_Status, Comp_CompanyId, Comp_Name AS Company_Name,
                  Comp_WebSite AS Company_Website, Addr_AddressId, Addr_Address1 AS Addr_Street1, Addr_City,
                  Addr_PostCode, Addr_Country
           FROM person LEFT JOIN company ON Pers_CompanyId = Comp_CompanyId
                LEFT JOIN address ON Pers_PersonId = Addr_PersonId
           WHERE Pers_PersonId IS NOT NULL""",
        ("person", "company", "address"),
    ),
    "opportunities": (
        """SELECT DISTINCT Oppo_OpportunityId, Oppo_Description, Oppo_Status, Oppo_Stage,
                  CAST(Oppo_Certainty AS DOUBLE) AS Oppo_Certainty, CAST(Oppo_Forecast AS DOUBLE) AS Oppo_Forecast,
                  CAST(Oppo_EstimatedRevenue AS DOUBLE) AS Oppo_EstimatedRevenue,
                  CAST(Oppo_DiscountPercent AS DOUBLE) AS Oppo_DiscountPercent, Oppo_CreatedDate,
                  Comp_CompanyId, Comp_Name AS Company_Name, Comp_WebSite AS Company_Website,
                  Pers_PersonId, Pers_FirstName AS Person_FirstName, Pers_LastName AS Person_LastName,
                  CAST(Oppo_Forecast * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) AS Weighted_Forecast,
                  CAST(Oppo_EstimatedRevenue * (1 - Oppo_DiscountPercent * CAST(0.01 AS DECIMAL(3,2))) AS DOUBLE)
                      AS Net_Amount
           FROM opportunity LEFT JOIN company ON Oppo_PrimaryCompanyId = Comp_CompanyId
                LEFT JOIN person ON Oppo_PrimaryPersonId = Pers_PersonId
           WHERE Oppo_OpportunityId IS NOT NULL""",
        ("opportunity", "company", "person"),
    ),
    "communications": (
        f"""SELECT DISTINCT Comm_CommunicationId, Comm_Type, Comm_Action, Comm_Status, Comm_Subject, Comm_Note,
                  Comm_OriginalDateTime, Comm_DateTime, Comm_Priority, Comp_CompanyId, Comp_Name AS Company_Name,
                  Pers_PersonId, CASE WHEN Pers_PersonId IS NOT NULL THEN {_PERSON_NAME} END AS Person_FullName,
                  Oppo_OpportunityId, Oppo_Description AS Opportunity_Description
           FROM communication LEFT JOIN company ON Comm_CompanyId = Comp_CompanyId
                LEFT JOIN person ON Comm_PersonId = Pers_PersonId
                LEFT JOIN opportunity ON Comm_OpportunityId = Oppo_OpportunityId
           WHERE Comm_CommunicationId IS NOT NULL""",
        ("communication", "company", "person", "opportunity"),
    ),
    "cases": (
        """SELECT DISTINCT Case_CaseId, Case_Status, Case_Priority, Case_Description,
                  Case_Opened AS Case_OpenedDate, Case_Closed AS Case_ClosedDate, Comp_CompanyId, Comp_Name AS Company_Name, Comp_WebSite AS Company_Website, Pers_PersonId,
                  Pers_FirstName AS Person_FirstName, Pers_LastName AS Person_LastName
           FROM "case" LEFT JOIN company ON Case_PrimaryCompanyId = Comp_CompanyId
                LEFT JOIN person ON Case_PrimaryPersonId = Pers_PersonId
           WHERE Case_CaseId IS NOT NULL""",
        ("case", "company", "person"),
    ),
    "social_networks": (
        """SELECT DISTINCT SoN_SocialNetworkId, SoN_Platform, SoN_ProfileURL, SoN_CreatedDate, Pers_PersonId,
                  Pers_FirstName AS Person_FirstName, Pers_LastName AS Person_LastName
           FROM social_network LEFT JOIN person ON SoN_PersonId = Pers_PersonId
           WHERE SoN_SocialNetworkId IS NOT NULL""",
        ("social_network", "person"),
    ),
    "addresses": (
        f"""SELECT DISTINCT Addr_AddressId, Addr_Type, Addr_Address1 AS Addr_Street1, Addr_City, Addr_PostCode, Addr_Country,
                  Comp_CompanyId, Comp_Name AS Company_Name, Pers_PersonId,
                  CASE WHEN Pers_PersonId IS NOT NULL THEN {_PERSON_NAME} END AS Person_FullName
           FROM address LEFT JOIN company ON Addr_CompanyId = Comp_CompanyId
                LEFT JOIN person ON Addr_PersonId = Pers_PersonId
           WHERE Addr_AddressId IS NOT NULL""",
        ("address", "company", "person"),
    ),
}


def _view(name, tables):
    return lambda spark, d: processed_view(roles(spark, d, *tables), name, missing="skip")


for _name, (_sql, _tables) in VIEW_SQL.items():
    query(f"q_view_{_name}", _sql, *_tables)(_view(_name, _tables))


@query(
    "q_view_threshold",
    f"""SELECT Oppo_OpportunityId, Oppo_Description, Company_Name, Oppo_Forecast, Weighted_Forecast, Net_Amount
        FROM ({VIEW_SQL["opportunities"][0]}) AS v
        WHERE Oppo_Stage = '02 - HIGH' AND Weighted_Forecast > 50000""",
    *VIEW_SQL["opportunities"][1],
)
def _(spark, d):
    view = _view("opportunities", VIEW_SQL["opportunities"][1])(spark, d)
    return project.filter_rows(view, "Oppo_Stage = '02 - HIGH' AND Weighted_Forecast > 50000").select(
        "Oppo_OpportunityId", "Oppo_Description", "Company_Name", "Oppo_Forecast", "Weighted_Forecast", "Net_Amount"
    )


@query(
    "q_view_active_in_country",
    f"""SELECT Comp_CompanyId, Comp_Name, Comp_WebSite, Addr_City, Addr_Country
        FROM ({VIEW_SQL["companies"][0]}) AS v WHERE Comp_Status = 'Active' AND Addr_Country = 'EUROPE'""",
    *VIEW_SQL["companies"][1],
)
def _(spark, d):
    view = _view("companies", VIEW_SQL["companies"][1])(spark, d)
    return project.filter_rows(view, "Comp_Status = 'Active' AND Addr_Country = 'EUROPE'").select(
        "Comp_CompanyId", "Comp_Name", "Comp_WebSite", "Addr_City", "Addr_Country"
    )


# --------------------------------------------------------------------------
# Joins and contact points

_FIRST_LINKS = """
    LEFT JOIN (SELECT PLink_RecordId, min(Phon_PhoneId) AS Phone_Id,
                      arg_min(Phon_FullNumber, Phon_PhoneId) AS Phone
               FROM phone_link WHERE PLink_Type = 'Business' GROUP BY PLink_RecordId) AS phones
         ON {key} = PLink_RecordId
    LEFT JOIN (SELECT ELink_RecordID, min(Emai_EmailId) AS Email_Id,
                      arg_min(Emai_EmailAddress, Emai_EmailId) AS Email
               FROM email_link WHERE ELink_Type = 'Business' GROUP BY ELink_RecordID) AS mails
         ON {key} = ELink_RecordID"""
CONTACT_COMPANY_SQL = f"""
    SELECT extracted.*, Phone AS Company_Phone, Phone_Id, Email AS Company_Email, Email_Id
    FROM ({COMPANY_SQL}) AS extracted {_FIRST_LINKS.format(key="Comp_CompanyId")}"""


def contact_company(spark, d):
    t = roles(spark, d, "phone_link", "email_link")
    return companies_with_contacts(
        entity("Company", "company", "address")(spark, d), t["phone_link"], t["email_link"]
    )


query("q_contact_company", CONTACT_COMPANY_SQL, "company", "address", "phone_link", "email_link")(contact_company)


@query(
    "q_contact_person",
    f"""SELECT extracted.*, Phone AS Person_Phone, Phone_Id, Email AS Person_Email, Email_Id
        FROM ({PERSON_SQL}) AS extracted {_FIRST_LINKS.format(key="Pers_PersonId")}""",
    "person", "company", "address", "phone_link", "email_link",
)
def _(spark, d):
    t = roles(spark, d, "phone_link", "email_link")
    people = entity("Person", "person", "company", "address")(spark, d)
    return persons_with_contacts(people, t["phone_link"], t["email_link"])


@query(
    "q_contact_fan_out",
    """SELECT Comp_CompanyId, Phon_FullNumber AS Company_Phone, Phon_PhoneId AS Phone_Id
       FROM company LEFT JOIN phone_link ON Comp_CompanyId = PLink_RecordId AND PLink_Type = 'Business'""",
    "company", "phone_link",
)
def _(spark, d):
    t = roles(spark, d, "company", "phone_link")
    return contact.with_contact(
        t["company"].select("Comp_CompanyId"), t["phone_link"], "Comp_CompanyId", "PLink_RecordId",
        ("PLink_Type", "Business"), "Phon_PhoneId",
        {"Company_Phone": "Phon_FullNumber", "Phone_Id": "Phon_PhoneId"}, fan_out=True,
    )


@query(
    "q_phone_pivot",
    """SELECT Pers_PersonId, Pers_FirstName, Pers_LastName,
              max(CASE WHEN PLink_Type = 'Business' THEN Phon_FullNumber END) AS Phone_Business,
              max(CASE WHEN PLink_Type = 'Mobile' THEN Phon_FullNumber END) AS Phone_Mobile,
              max(CASE WHEN PLink_Type = 'Home' THEN Phon_FullNumber END) AS Phone_Home,
              max(CASE WHEN PLink_Type = 'Fax' THEN Phon_FullNumber END) AS Phone_Fax
       FROM person LEFT JOIN phone_link ON Pers_PersonId = PLink_RecordId
       GROUP BY Pers_PersonId, Pers_FirstName, Pers_LastName""",
    "person", "phone_link",
)
def _(spark, d):
    t = roles(spark, d, "person", "phone_link")
    people = t["person"].select("Pers_PersonId", "Pers_FirstName", "Pers_LastName")
    kinds = ("Business", "Mobile", "Home", "Fax")
    return contact.with_pivoted_links(
        people, t["phone_link"], "Pers_PersonId", "PLink_RecordId", "PLink_Type", "Phon_FullNumber",
        {f"Phone_{k}": k for k in kinds},
    )


@query("q_link_types", "SELECT PLink_Type, count(*) AS n FROM phone_link GROUP BY PLink_Type", "phone_link")
def _(spark, d):
    return contact.link_types(role(spark, d, "phone_link"), "PLink_Type")


@query(
    "q_primary_phone",
    "SELECT PLink_RecordId, max(Phon_FullNumber) AS Primary_Phone FROM phone_link GROUP BY PLink_RecordId",
    "phone_link",
)
def _(spark, d):
    return contact.best_value(role(spark, d, "phone_link"), "PLink_RecordId", "Phon_FullNumber", "Primary_Phone")


@query(
    "q_contact_coverage",
    f"""WITH c AS ({CONTACT_COMPANY_SQL}),
             n AS (SELECT 'Company_Phone' AS column_name, count(*) AS rows, count(Company_Phone) AS filled FROM c
                   UNION ALL SELECT 'Company_Email', count(*), count(Company_Email) FROM c
                   UNION ALL SELECT 'Comp_WebSite', count(*), count(Comp_WebSite) FROM c)
        SELECT column_name, rows, filled,
               CAST(round(CAST(100 * filled AS DECIMAL(20,4)) / rows, 2) AS DOUBLE) AS percent FROM n""",
    "company", "address", "phone_link", "email_link",
)
def _(spark, d):
    return contact.coverage(contact_company(spark, d), ["Company_Phone", "Company_Email", "Comp_WebSite"])


@query(
    "q_status_category",
    """SELECT person.*, Comp_Name,
              CASE WHEN Pers_Status = 'Active' THEN 'Current' ELSE 'Inactive' END AS Status_Category
       FROM person LEFT JOIN company ON Pers_CompanyId = Comp_CompanyId""",
    "person", "company",
)
def _(spark, d):
    t = roles(spark, d, "person", "company")
    joined_names = left_lookup(
        t["person"], t["company"], [("Pers_CompanyId", "Comp_CompanyId")], {"Comp_Name": "Comp_Name"}
    )
    return joined_names.withColumn("Status_Category", status_category("Pers_Status"))


@query(
    "q_layered_opportunity",
    """SELECT Oppo_OpportunityId, Oppo_PrimaryCompanyId, CAST(Oppo_Forecast AS DOUBLE) AS Oppo_Forecast,
              c.Comp_Name, c.Comp_WebSite, p.Pers_FirstName, p.Pers_LastName, p.Pers_EmailAddress,
              CAST(Oppo_Forecast * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) AS Weighted_Forecast,
              CAST(Oppo_Forecast - oppo_cout AS DOUBLE) AS Net_Amount,
              CAST((Oppo_Forecast - oppo_cout) * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE)
                  AS Net_Weighted_Amount
       FROM opportunity LEFT JOIN company AS c ON Oppo_PrimaryCompanyId = c.Comp_CompanyId
            LEFT JOIN person AS p ON Oppo_PrimaryPersonId = p.Pers_PersonId""",
    "opportunity", "company", "person",
)
def _(spark, d):
    t = roles(spark, d, "opportunity", "company", "person", "address")
    return layered_opportunities(
        t["opportunity"], processed_view(t, "companies", "skip"), processed_view(t, "persons", "skip"), "percent"
    ).select(
        "Oppo_OpportunityId", "Oppo_PrimaryCompanyId", "Oppo_Forecast", "Comp_Name", "Comp_WebSite",
        "Pers_FirstName", "Pers_LastName", "Pers_EmailAddress", "Weighted_Forecast", "Net_Amount",
        "Net_Weighted_Amount",
    )


@query(
    "q_auto_join",
    """SELECT Oppo_OpportunityId, Oppo_Stage, Comp_Name AS company_Comp_Name, Comp_Type AS company_Comp_Type,
              Pers_LastName AS person_Pers_LastName
       FROM opportunity LEFT JOIN company ON Oppo_PrimaryCompanyId = Comp_CompanyId
            LEFT JOIN person ON Oppo_PrimaryPersonId = Pers_PersonId""",
    "opportunity", "company", "person",
)
def _(spark, d):
    return auto_join(
        roles(spark, d, "opportunity", "company", "person"), "opportunity",
        ["Oppo_OpportunityId", "Oppo_Stage", "company.Comp_Name", "company.Comp_Type", "person.Pers_LastName"],
        RELATIONSHIPS,
    )


@query(
    "q_window_count",
    """SELECT "case".*, Comp_Name, count(*) OVER (PARTITION BY Case_PrimaryCompanyId) AS total_cases
       FROM "case" LEFT JOIN company ON Case_PrimaryCompanyId = Comp_CompanyId""",
    "case", "company",
)
def _(spark, d):
    t = roles(spark, d, "case", "company")
    # Counted before the join: the name adds no rows.
    counted = with_group_count(t["case"], "Case_PrimaryCompanyId", "total_cases")
    return left_lookup(
        counted, t["company"], [("Case_PrimaryCompanyId", "Comp_CompanyId")], {"Comp_Name": "Comp_Name"},
    )


# --------------------------------------------------------------------------
# Row functions

@query(
    "q_computed_fraction",
    """WITH deals AS (
           SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
                  CAST(l_discount AS DECIMAL(5,2)) AS certainty,
                  CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(5,2)) AS cost FROM lineitem)
       SELECT l_orderkey, l_partkey, l_linenumber, CAST(amount AS DOUBLE) AS amount,
              CAST(certainty AS DOUBLE) AS certainty, CAST(cost AS DOUBLE) AS cost,
              CAST(amount * certainty AS DOUBLE) AS weighted_forecast, CAST(amount - cost AS DOUBLE) AS net_amount,
              CAST((amount - cost) * certainty AS DOUBLE) AS net_weighted_amount
       FROM deals""",
)
def _(spark, d):
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    deals = base(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", price.alias("amount"),
        F.col("l_discount").cast("decimal(5,2)").alias("certainty"),
        (price * F.col("l_tax").cast("decimal(5,2)")).alias("cost"),
    )
    return with_deal_amounts(deals)


@query(
    "q_computed_percent",
    """SELECT Oppo_OpportunityId,
              CAST(Oppo_Forecast * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) AS Weighted_Forecast,
              CAST(Oppo_Forecast - coalesce(oppo_cout, 0) AS DOUBLE) AS Net_Amount,
              CAST((Oppo_Forecast - coalesce(oppo_cout, 0)) * Oppo_Certainty * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE)
                  AS Net_Weighted_Amount
       FROM opportunity""",
    "opportunity",
)
def _(spark, d):
    net = net_amount("Oppo_Forecast", "oppo_cout", cost_default=0)
    return role(spark, d, "opportunity").select(
        "Oppo_OpportunityId",
        weighted_forecast("Oppo_Forecast", "Oppo_Certainty", "percent").alias("Weighted_Forecast"),
        net.alias("Net_Amount"),
        net_weighted_amount(net, "Oppo_Certainty", "percent").alias("Net_Weighted_Amount"),
    )


@query(
    "q_net_discount",
    """SELECT Oppo_OpportunityId,
              CAST(Oppo_EstimatedRevenue * (1 - Oppo_DiscountPercent * CAST(0.01 AS DECIMAL(3,2))) AS DOUBLE)
                  AS Net_Amount
       FROM opportunity""",
    "opportunity",
)
def _(spark, d):
    return role(spark, d, "opportunity").select(
        "Oppo_OpportunityId",
        net_after_discount("Oppo_EstimatedRevenue", "Oppo_DiscountPercent").alias("Net_Amount"),
    )


@query(
    "q_stage_map",
    """SELECT Oppo_OpportunityId, Oppo_Status,
              CASE WHEN Oppo_Status IN ('No-go', 'Abandonnée', 'Perdue') THEN 'Closed Lost'
                   WHEN Oppo_Status = 'Gagnée' THEN 'Closed Won' WHEN Oppo_Status = 'En cours' THEN 'In Progress'
                   ELSE 'Unknown' END AS final_stage
       FROM opportunity""",
    "opportunity",
)
def _(spark, d):
    return role(spark, d, "opportunity").select(
        "Oppo_OpportunityId", "Oppo_Status", final_stage("Oppo_Status").alias("final_stage")
    )


@query(
    "q_stage_number",
    """SELECT Oppo_OpportunityId, Oppo_Stage, CAST(substr(Oppo_Stage, 2, 1) AS INT) AS stage_number
       FROM opportunity""",
    "opportunity",
)
def _(spark, d):
    return role(spark, d, "opportunity").select(
        "Oppo_OpportunityId", "Oppo_Stage", stage_number("Oppo_Stage").alias("stage_number")
    )


@query("q_full_name", f"SELECT Pers_PersonId, {_PERSON_NAME} AS full_name FROM person", "person")
def _(spark, d):
    return role(spark, d, "person").select(
        "Pers_PersonId", joined("Pers_FirstName", "Pers_LastName").alias("full_name")
    )


@query(
    "q_priority_score",
    """SELECT Case_CaseId, Case_Priority,
              CASE Case_Priority WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS priority_score
       FROM "case" """,
    "case",
)
def _(spark, d):
    return role(spark, d, "case").select(
        "Case_CaseId", "Case_Priority", priority_score("Case_Priority").alias("priority_score")
    )


@query("q_sanitize", "SELECT doc_id, translate(text, 'éa', '-*') AS text FROM documents")
def _(spark, d):
    # The texts contain no symbol-font characters, so two letters are turned into them.
    text = F.replace(F.col("text"), F.lit("é"), F.lit("\uf02d"))
    text = F.replace(text, F.lit("a"), F.lit("\uf0a7"))
    return sanitize(base(spark, d, "documents").select("doc_id", text.alias("text")))


@query(
    "q_email_valid",
    """SELECT Emai_EmailId, regexp_matches(Emai_EmailAddress, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') AS email_valid
       FROM email_link""",
    "email_link",
)
def _(spark, d):
    return role(spark, d, "email_link").select("Emai_EmailId", email_valid("Emai_EmailAddress").alias("email_valid"))
