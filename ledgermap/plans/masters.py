"""Import datasets of master records: accounts, people, banks, customers, vendors, projects, codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.parse import code_tail, employee_names, parent_code, routing_number, vendor_contact
from ledgermap.functions.semantics import (
    blank_if_null,
    int_or_zero,
    iso,
    iso_or_blank,
    joined,
    joined_or_blank,
    tag,
)
from ledgermap.operators.documents import header_detail, unpivot_columns
from ledgermap.operators.lookup import base_account_targets, translate
from ledgermap.plans.common import SKIP, Tables, emit, first_line, folder_entities, included_jobs, look_up
from ledgermap.plans.seeds import accounts
from ledgermap.sources.tables import Params, lookup_1099, lookup_acct_type, lookup_state

c = F.col


def _state_names(df: DataFrame, column: str, out: str) -> DataFrame:
    return translate(df, F.broadcast(lookup_state(df.sparkSession)), {column: "state_id"}, {out: "state_name"})


def _tax_codes(df: DataFrame, out: str) -> DataFrame:
    forms = F.broadcast(lookup_1099(df.sparkSession))
    return translate(df, forms, {"Form_Type_1099": "form_type_1099_desc"}, {out: "form_type_1099_code"})


def import_gl_base_account(src: Tables, maps: Tables, params: Params) -> DataFrame:
    base = src["base_account"]
    columns = {n: n for n in ("acct_type", "normal_balance", "closeable")}
    df = translate(
        base, F.broadcast(lookup_acct_type(base.sparkSession)), {"Base_Account_Type": "base_account_type"}, columns
    )
    closes = c("Base_Account_Type").isin("Income", "Cost", "Expense", "Other income")
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("GL_LEGACY_ID", c("Base_Account")),
            ("ACCT_NO", c("Base_Account")),
            ("ACCT_NAME", c("Base_Account_Title")),
            ("ACCT_TYPE", c("acct_type")),
            ("NORMAL_BALANCE", c("normal_balance")),
            ("CLOSEABLE", c("closeable")),
            ("CLOSETOACCT_NO", F.when(closes, "Retained Earnings Account Here Later").otherwise("")),
            ("CATEGORY", ""),
            ("ACTIVE", "T"),
            (SKIP, c("Base_Account_Type")),
        ],
    )


def import_employees(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    df = look_up(employee_names(src["employee"]), maps, "employee", "Employee", {"_new": "new_employee_id"})
    df = folder_entities(df, maps, {"_entity": "new_entity_id"}, strict_keys)
    working = c("Termination_Date").isNull()
    middle = F.when(c("mi") == "", "").otherwise(joined(c("mi"), " "))
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, joined_or_blank("LEGACY_ID: ", c("Employee"))),
            (SKIP, joined_or_blank("LEGACY_NAME: ", c("Employee_Name"))),
            (SKIP, joined("LEGACY_STATUS: ", F.when(working, "Active").otherwise("Inactive"))),
            ("EMPLOYEE_ID", c("_new")),
            ("EMPLOYEE_TYPE", "Full Time"),
            ("LEGACY_EMPLOYEE_ID", joined(c("Data_Folder_Id"), " ", c("Employee"))),
            ("JOB_TITLE", c("Title")),
            ("SSNO", c("Social_Security_Number")),
            ("BIRTH_DATE", iso_or_blank(c("Birth_Date"))),
            ("START_DATE", iso_or_blank(F.coalesce("Rehire_Date", "Hire_Date"))),
            ("END_DATE", iso_or_blank(c("Termination_Date"))),
            ("LOCATION_ID", c("_entity")),
            ("CLASS_ID", ""),
            ("GENDER", c("Gender")),
            ("SUPERVISOR_ID", ""),
            ("CONTACT_NAME", F.replace("Employee_Name", F.lit(";"), F.lit(","))),
            ("ACTIVE", F.when(working, "T").otherwise("F")),
            ("FIRST_NAME", c("first_name")),
            ("LAST_NAME", c("last_name")),
            ("MI", c("mi")),
            ("COMPANY_NAME", c("Data_Folder_Id")),
            ("PRINT_AS", joined(c("first_name"), " ", middle, c("last_name"))),
            ("PHONE1", c("Phone_Number")),
            ("EMAIL1", c("Email_Address")),
            ("CELLPHONE", c("Mobile_Phone")),
            ("ADDRESS1", c("Address_1")),
            ("ADDRESS2", c("Address_2")),
            ("CITY", c("City")),
            ("STATE", c("State")),
            ("ZIP", c("ZIP_Code")),
            (SKIP, c("Department")),
            (SKIP, c("Certified_Class")),
            (SKIP, c("Union_ID")),
            (SKIP, c("Union_Local")),
            (SKIP, c("Union_Class")),
        ],
    )


def import_bank_accounts(src: Tables, maps: Tables, params: Params) -> DataFrame:
    chart = accounts(src).select("data_folder_id", "account", "baseaccount", "prefixa")
    targets = base_account_targets(chart, maps["base_account"])
    rows = targets.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), c("copies"))))
    df = translate(
        src["bank_account"],
        rows,
        {"General_Cash_Account": "account", "Data_Folder_Id": "data_folder_id"},
        {"_acct": "acct_no", "_prefix": "prefixa"},
        {"_acct": "(MISSING)"},
    )
    df = translate(
        df,
        maps["entity"],
        {"_prefix": "legacy_entity_id", "Data_Folder_Id": "data_folder_id"},
        {"_entity": "new_entity_id"},
    )
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, c("Account_Type")),
            ("ACCOUNT_ID", c("Bank_Account")),
            ("ACCOUNT_NUMBER", c("Account_Number")),
            ("BANK_NAME", c("Bank_Name")),
            (SKIP, c("Description")),
            ("ROUTING_NUMBER", ""),
            ("BRANCH_ID", c("Branch")),
            ("ADDRESS1", c("Address_1")),
            ("ADDRESS2", c("Address_2")),
            ("CITY", c("City")),
            ("STATE", c("State")),
            ("ZIP", c("ZIP")),
            ("COUNTRY", ""),
            ("PHONE_NUMBER", c("Phone_Number")),
            ("CURRENCY", ""),
            ("GL_ACCOUNT", c("_acct")),
            ("SERVICE_CHARGE_GLACCOUNT", ""),
            ("INTEREST_EARNED_GLACCOUNT", ""),
            ("LOCATION_ID", c("_entity")),
            (SKIP, tag("LGCY_GEN_ACCT:", c("General_Cash_Account"))),
            (SKIP, tag("LAST_RECON:", iso_or_blank(c("Last_Reconciled_Date")))),
        ],
    )


def import_open_cash(src: Tables, maps: Tables, params: Params) -> DataFrame:
    open_items = src["bank_register"].filter(c("Reconciliation_Status").isin("C", "O"))
    df = translate(
        open_items,
        src["bank_account"],
        {"Data_Folder_Id": "Data_Folder_Id", "Bank_Account": "Bank_Account"},
        {"_reconciled": "Last_Reconciled_Date", "_cash": "General_Cash_Account"},
    )
    paid = c("Subtraction") > 0
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, c("Bank_Account")),
            ("DATE", c("Accounting_Date")),
            ("DOC_NO", c("Check_No")),
            ("TYPE", F.when(paid, "checkdebit").otherwise("depositcredit")),
            ("AMOUNT", F.when(paid, c("Subtraction")).otherwise(c("Addition"))),
            ("PAYEE", c("Payee")),
            ("DESCRIPTION", c("Description")),
            (SKIP, tag("LAST_RECON:", iso_or_blank(c("_reconciled")))),
            (SKIP, c("Subtraction")),
            (SKIP, c("Addition")),
            (SKIP, c("_cash")),
            (SKIP, c("Reconcile_in_Progress")),
        ],
    )


def import_customers(src: Tables, maps: Tables, params: Params) -> DataFrame:
    included = {**maps, "customer": maps["customer"].filter(c("include_customer") == 1)}
    df = look_up(src["customer"], included, "customer", "Customer", {"_new": "new_customer_id"}, how="inner")
    df = _state_names(_state_names(df, "State", "_state"), "Billing_State", "_billing_state")
    days = c("Days_Before_Due")
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("CUSTOMER_ID", c("_new")),
            ("LEGACY_CUSTOMER", joined(c("Customer"), " | ", c("Data_Folder_Id"))),
            ("CUST_NAME", c("Name")),
            ("TAXGROUP", c("Tax_Group")),
            ("TERM_NAME", F.when(days == 0, "").otherwise(joined("Net ", days.cast("string")))),
            ("CREDIT_LIMIT", c("Credit_Limit")),
            ("ACTIVE", ""),
            ("CONTACT_NAME", c("Name")),
            ("PRINT_AS", c("Name")),
            ("PHONE1", c("Telephone")),
            ("FAX", c("Fax")),
            ("EMAIL1", c("Email_Address")),
            ("ADDRESS1", c("Address_1")),
            ("ADDRESS2", c("Address_2")),
            ("CITY", c("City")),
            ("STATE", c("_state")),
            ("ZIP", c("Zip_Code")),
            ("COUNTRY", ""),
            ("B_CONTACT_NAME", c("Billing_Contact")),
            ("B_EMAIL1", c("Billing_Email_Address")),
            ("B_ADDRESS1", c("Billing_Address_1")),
            ("B_ADDRESS2", c("Billing_Address_2")),
            ("B_CITY", c("Billing_City")),
            ("B_STATE", c("_billing_state")),
            ("B_ZIP", c("Billing_ZIP_Code")),
        ],
    )


def _payment(electronic: str, check: str) -> Column:
    kind = c("Default_Payment_Type")
    return F.when(kind == "Electronic", electronic).when(kind == "Check", check).otherwise("Unknown Type")


def _if_electronic(yes: str, no: str | None = None) -> Column:
    hit = F.when(c("Default_Payment_Type") == "Electronic", yes)
    return hit if no is None else hit.otherwise(no)


def _bank_kind() -> Column:
    return F.when(c("Account_Type") == "Checking", "Checking Account").otherwise("Savings Account")


def _included_vendors(src: Tables, maps: Tables) -> DataFrame:
    included = {**maps, "vendor": maps["vendor"].filter(c("include_vendor") == 1)}
    columns = {"_new": "new_vendor_id", "_legacy": "legacy_vendor_id"}
    return look_up(src["vendor"], included, "vendor", "Vendor", columns, how="inner")


def import_vendors(src: Tables, maps: Tables, params: Params) -> DataFrame:
    df = _state_names(_tax_codes(_included_vendors(src, maps), "_form"), "State", "_state")
    no_form = c("Receives_Form_1099") == 0
    pct, early, due = (c(n).cast("string") for n in ("Discount_Percent", "Discount_Days", "Payment_Days"))
    terms = (
        F.when(c("Discount_Days") > 0, joined(pct, "/", early, " net ", due))
        .when(c("Payment_Days") == 0, "Due Upon Receipt")
        .otherwise(joined("net ", due))
    )
    first, last = vendor_contact(c("Contact_1_Name"))
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("VENDOR_ID", c("_new")),
            ("LEGACY_VENDOR", c("_legacy")),
            ("NAME", c("Name")),
            ("VENDTYPE_NAME", c("Type")),
            ("TAX_ID", c("Recipient_ID")),
            ("VENDOR_ACCTNO", c("Customer_Number")),
            ("GL_ACCTNO", c("Expense_Account")),
            ("BILLING_TYPE", F.lit(0)),
            ("FORM1099TYPE", F.when(no_form, "").otherwise(c("_form"))),
            ("FORM1099BOX", F.when(no_form, "").otherwise("1")),
            ("NAME1099", c("Recipient_Tax_ID_Name")),
            ("CONTACT_NAME", c("Name")),
            ("PRINT_AS", c("Name")),
            ("PHONE1", c("Telephone")),
            ("FAX", c("Fax_Number")),
            ("EMAIL1", c("Contact_1_Email_Address")),
            ("EMAIL2", c("Contact_2_Email_Address")),
            ("URL1", ""),
            ("ADDRESS1", c("Address_1")),
            ("ADDRESS2", c("Address_2")),
            ("CITY", c("City")),
            ("STATE", c("_state")),
            ("ZIP", c("ZIP")),
            ("COUNTRY", c("Country_Code")),
            ("TERM_NAME", terms),
            (SKIP, c("Contact_1_Name")),
            ("FIRST_NAME", first),
            ("LAST_NAME", last),
            ("PAYMENT_METHOD", _payment("ACH", "Printed Check")),
            ("ACH_ENABLED", _payment("T", "F")),
            ("ACH_BANK_ROUTING_NUMBER", routing_number(c("Bank_ID"))),
            ("ACH_ACCOUNT_NUMBER", c("Bank_Account")),
            ("ACH_ACCOUNT_TYPE", _bank_kind()),
            ("ACH_SEC_CODE", _if_electronic("CCD")),
            ("PAYMENT_NOTIFICATION", _if_electronic("T", "F")),
            (SKIP, c("Vendor")),
            (SKIP, c("Name")),
            (SKIP, c("Account_Type")),
        ],
    )


def import_vendors_ach(src: Tables, maps: Tables, params: Params) -> DataFrame:
    enabled = _payment("T", "F")
    return emit(
        _included_vendors(src, maps).filter(enabled == "T"),
        [
            (SKIP, c("Data_Folder_Id")),
            ("VENDOR_ID", c("_new")),
            ("PAYMENT_METHOD", _payment("ACH", "Printed Check")),
            ("ACH_ENABLE", enabled),
            ("ACH_BANK_ROUTING_NUMBER", routing_number(c("Bank_ID"))),
            ("ACH_ACCOUNT_NUMBER", c("Bank_Account")),
            ("ACH_ACCOUNT_TYPE", _bank_kind()),
            ("ACH_SEC_CODE", blank_if_null(_if_electronic("CCD"))),
            ("PAYMENT_NOTIFICATION", _if_electronic("T", "F")),
            (SKIP, c("_legacy")),
        ],
    )


def import_vendor_1099(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    paid = src["vendor"].filter((c("Receives_Form_1099") == 1) & (c("Amt_Paid_This_Yr_1099") > 0))
    df = look_up(paid, maps, "vendor", "Vendor", {"_new": "new_vendor_id"})
    df = _tax_codes(folder_entities(df, maps, {"_entity": "new_entity_id"}, strict_keys), "_form")
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("VENDORID", c("_new")),
            ("VENDORNAME", c("Name")),
            ("ENTITY", c("_entity")),
            ("FORM1099TYPE", blank_if_null(c("_form"))),
            ("FORM1099BOX", "1"),
            ("AMOUNT", c("Amt_Paid_This_Yr_1099")),
            (SKIP, c("Form_Type_1099")),
            (SKIP, c("Receives_Form_1099")),
            (SKIP, tag("LG_VD|", c("Vendor"))),
        ],
    )


def import_projects(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    """One row per included job and included extra, repeated for each entity of the folder.

    The entity columns are not used, but the join decides how often a project appears; lookups
    that are unique by key and unused are left out.
    """
    new = {f"_{d}": f"new_{d}_id" for d in ("job", "customer", "pm", "entity", "department", "class")}
    df = look_up(
        src["job"], {"job": included_jobs(maps)}, "job", "Job", {**new, "_extra": "legacy_extra_id"}, how="inner"
    )
    df = folder_entities(df, maps, {"_any": "new_entity_id"}, strict_keys)
    plain = c("_extra").isNull() | (c("_extra") == "")
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("PROJECT_ID", c("_job")),
            ("PROJECT_NAME", c("Description")),
            ("LEGACY_PROJECT_ID", F.when(plain, c("Job")).otherwise(joined(c("Job"), " | Extra: ", c("_extra")))),
            ("PROJECT_CATEGORY", "Contract"),
            ("PRINT_AS", ""),
            ("STREET_ADDRESS_LINE_1", c("Address_1")),
            ("STREET_ADDRESS_LINE_2", c("Address_2")),
            ("CITY", c("City")),
            ("STATE", c("State")),
            ("ZIP", c("ZIP_Code")),
            ("BILLINGTYPE", "Fixed Fee"),
            ("PROJECT_STATUS", "Active"),
            ("CUSTOMER_ID", c("_customer")),
            ("PROJECT_MANAGER_ID", c("_pm")),
            ("BEGIN_DATE", iso_or_blank(c("Actual_Start_Date"))),
            ("END_DATE", iso_or_blank(c("Estimated_Comp_Date"))),
            ("LOCATION_ID", c("_entity")),
            ("DEPARTMENT_ID", c("_department")),
            ("CLASS_ID", c("_class")),
            (SKIP, c("AR_Customer")),
            (SKIP, c("Cost_Account_Prefix")),
            (SKIP, blank_if_null(iso(c("Last_Cost_Update")))),
            (SKIP, c("Billing_Method")),
        ],
    )


def import_standard_cost_types(src: Tables, maps: Tables, params: Params) -> DataFrame:
    df = look_up(src["std_category"], maps, "cost_type", "Category", {"_new": "new_cost_type_id"})
    df = translate(
        df,
        maps["base_account"],
        {"Cost_Account_A": "legacy_base_account", "Data_Folder_Id": "data_folder_id"},
        {"_account": "new_base_account"},
    )
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, tag("LGCY_CT|", c("Category"))),
            (SKIP, tag("LGCY_ACCT|", c("Cost_Account_A"))),
            ("STANDARDCOSTTYPE_ID", c("_new")),
            ("STANDARDCOSTTYPE_NAME", c("Description")),
            ("DESCRIPTION", ""),
            ("ACCUMULATIONTYPENAME", c("Accumulate_As")),
            ("COSTUNITDESCRIPTION", c("Cost_Unit_Description")),
            ("ACTIVE", "T"),
            ("ACCOUNTNO", blank_if_null(c("_account"))),
            ("PARENT_STANDARDCOSTTYPE", ""),
            ("ITEM_ID", c("Accumulate_As")),
            ("LEGACY_ID", c("Category")),
        ],
    )


def code_categories(codes: DataFrame) -> DataFrame:
    """One row per cost code and usable category: parents without, children with a category."""
    ids = ["Data_Folder_Id", "Cost_Code", "Description"]
    rows = unpivot_columns(codes, ids, [f"Category_{i}" for i in range(1, 13)], "_slot", "_category")
    number, category = int_or_zero(code_tail(c("Cost_Code"))), F.trim("_category")
    return rows.filter(((category != "") & (number != 0)) | ((category == "") & (number == 0))).drop("_slot")


def import_standard_cost_codes(
    src: Tables, maps: Tables, params: Params, sort_columns: bool = False
) -> DataFrame:
    df = look_up(code_categories(src["std_cost_code"]), maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id"})
    rows = df.select(
        "Data_Folder_Id",
        tag("LGCY_CC | ", c("Cost_Code")).alias("_legacy"),
        "_task",
        c("Description").alias("_name"),
        parent_code(c("Cost_Code")).alias("_parent"),
        "_category",
    ).distinct()
    order = ["Data_Folder_Id", "_legacy", "_name", "_parent", "_category"]
    lines = header_detail(rows, ["_task"], order, [], line="_line")

    return emit(
        lines,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, c("_legacy")),
            ("STANDARDTASK_ID", first_line(c("_task"))),
            ("STANDARDTASK_NAME", first_line(c("_name"))),
            ("DESCRIPTION", ""),
            ("ACTIVE", first_line("T")),
            ("ITEM_ID", first_line("T")),
            ("BILLABLE", first_line("T")),
            ("MILESTONE", ""),
            ("UTILIZED", ""),
            ("PRIORITY", ""),
            ("TIMETYPE_NAME", ""),
            ("WBS_CODE", ""),
            ("PARENT_STANDARDTASK_ID", c("_parent")),
            ("CLASS_ID", ""),
            ("PRODUCTIONUNITDESC", ""),
            ("STANDARDCOSTTYPES_STANDARDCOSTTYPEID", c("_category")),
        ],
        sort=["Data_Folder_Id", "_task", "_line"] if sort_columns else None,
    )


def import_cost_types(src: Tables, maps: Tables, params: Params) -> DataFrame:
    df = look_up(src["job_category"], {"job": included_jobs(maps)}, "job", "Job", {"_job": "new_job_id"}, how="inner")
    df = look_up(df, maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id"})
    df = look_up(df, maps, "cost_type", "Category", {"_type": "new_cost_type_id"})
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("PROJECT_ID", c("_job")),
            ("TASK_ID", F.coalesce("_task", "Cost_Code")),
            ("STANDARDCOSTTYPE_ID", c("_type")),
            (SKIP, tag("L_JOB | ", c("Job"))),
            (SKIP, tag("L_EXTRA | ", c("Extra"))),
            (SKIP, tag("L_CC | ", c("Cost_Code"))),
            (SKIP, tag("L_CT | ", c("Category"))),
        ],
    )


def import_cost_codes(src: Tables, maps: Tables, params: Params) -> DataFrame:
    df = look_up(src["job_cost_code"], {"job": included_jobs(maps)}, "job", "Job", {"_job": "new_job_id"}, how="inner")
    df = look_up(df, maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id", "_name": "new_cost_code_name"})
    standard = blank_if_null(c("_task"))
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("TASK_NAME", F.coalesce("_name", "Description")),
            ("PROJECT_ID", c("_job")),
            ("ITEM_ID", "Other"),
            ("BILLABLE", "T"),
            ("ACTIVE", "T"),
            ("STANDARDTASK_ID", standard),
            ("COSTTYPE_ID", ""),
            ("TASK_ID", F.when(standard == "", F.coalesce("_task", "Cost_Code")).otherwise("")),
            (SKIP, tag("LGCY_CC | ", c("Cost_Code"))),
            (SKIP, ""),
            (SKIP, ""),
            (SKIP, ""),
        ],
    )
