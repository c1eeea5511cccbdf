"""DuckDB SQL per query key."""

from __future__ import annotations

from checks.oracle import (
    BALANCE_END,
    CTES,
    DETAIL_START,
    DETAIL_STOP,
    MONTH_START,
    MONTH_STOP,
    NO_DAY,
    by,
    columns,
    head,
    iso,
    month,
    select,
    sql,
)

# The orders that number the lines of a document, written out so that the datasets can be wrong.
OPEN_AP_ORDER = [
    "Dist_Seq", "_entity", "Description", "_price", "_retained", "_project", "_task", "_type", "_package",
    "Job", "Extra", "_account_prefix", "Cost_Code", "Category", "Commitment", "_check", "_vendor",
]
OPEN_AR_ORDER = [
    "_entity", "_date", "_due", "Customer", "_price", "_net", "_project", "_name", "_held", "_rel", "_bil",
]
ACTIVITY_ORDER = [
    "_t02", "_t03", "_t04", "_t05", "_t06", "_t07", "_t08", "_t09", "_t10", "_t11", "_t12", "_t14", "_t15",
    "_legacy", "_date", "_due", "_price", "_retained", "_entity", "_project", "_memo",
]
ESTIMATE_ORDER = [
    "_branch", "_task", "_type", "Job", "Extra", "Cost_Code", "Category", "_entity", "Data_Folder_Id",
    "_amount", "_qty", "_production", "Cost_Account",
]
LEDGER_ORDER = [
    "_location", "_reference", "_memo_order", "_acct", "_account", "_department", "_document", "_memo",
    "_og_date", "_reference2", "_origin",
]
JOB_COST_ORDER = [
    "entry_offset", "_acct", "Data_Folder_Id", "Accounting_Date", "_entity", "_department", "_class",
    "_document", "_memo", "_job", "_task", "_type", "_vendor", "Job", "Extra", "Debit_Account",
    "Credit_Account", "Cost_Code", "Category", "Vendor", "debit", "credit",
]
JOB_COST_OFFSET_KEYS = [
    "Data_Folder_Id", "Accounting_Date", "_title", "_acct", "_entity", "_department", "_class", "_document",
    "_memo", "_job",
]
JOB_COST_ENTRY_KEYS = [
    "Data_Folder_Id", "Accounting_Date", "_title", "_acct", "_entity", "_department", "_class", "_document",
    "_memo", "_job", "_task", "_type", "_vendor", "Job", "Extra", "Debit_Account", "Credit_Account",
    "Cost_Code", "Category", "Vendor",
]
LEDGER_KEYS = [
    "_date", "_og_date", "_description", "_reference", "_acct", "_location", "_department", "_document",
    "_memo", "_memo_order", "_account", "_entity", "_reference2", "_origin",
]
ACTIVITY_TAGS = [
    "_t02", "_t03", "_t04", "_t05", "_t06", "_t07", "_t08", "_t09", "_t10", "_t11", "_t12", "_t14", "_t15",
]

EXPECTED: dict[str, str] = {}

# --- seeds and views -------------------------------------------------------------------------

for _name in (
    "data_folder job customer vendor cost_code cost_type base_account entity batch_combine employee location department"
).split():
    EXPECTED[f"seed_{_name}"] = sql(f"SELECT * FROM map_{_name}")
EXPECTED["account_segments"] = sql("SELECT * FROM chart")
EXPECTED["employee_names"] = sql("SELECT * FROM staff")

# --- master datasets -------------------------------------------------------------------------

EXPECTED["import_gl_base_account"] = select(
    """
    D: b.Data_Folder_Id
    GL_LEGACY_ID: b.Base_Account
    ACCT_NO: b.Base_Account
    ACCT_NAME: b.Base_Account_Title
    ACCT_TYPE: t.acct_type
    NORMAL_BALANCE: t.normal_balance
    CLOSEABLE: t.closeable
    CLOSETOACCT_NO: if(t.acct_type = 'I', 'Retained Earnings Account Here Later', '')
    CATEGORY: ''
    ACTIVE: 'T'
    D: b.Base_Account_Type
    """,
    "FROM fx_base_account b LEFT JOIN acct_types t ON t.base_account_type = b.Base_Account_Type",
)

EXPECTED["import_employees"] = select(
    f"""
    D: s.Data_Folder_Id
    D: 'LEGACY_ID: ' || coalesce(s.Employee, '')
    D: 'LEGACY_NAME: ' || coalesce(s.Employee_Name, '')
    D: 'LEGACY_STATUS: ' || m.legacy_employee_status
    EMPLOYEE_ID: m.new_employee_id
    EMPLOYEE_TYPE: 'Full Time'
    LEGACY_EMPLOYEE_ID: s.Data_Folder_Id || ' ' || s.Employee
    JOB_TITLE: CAST(NULL AS VARCHAR)
    SSNO: CAST(NULL AS VARCHAR)
    BIRTH_DATE: ''
    START_DATE: coalesce({iso('coalesce(s.Rehire_Date, s.Hire_Date)')}, '')
    END_DATE: coalesce({iso('s.Termination_Date')}, '')
    LOCATION_ID: e.new_entity_id
    CLASS_ID: ''
    GENDER: CAST(NULL AS VARCHAR)
    SUPERVISOR_ID: ''
    CONTACT_NAME: replace(s.Employee_Name, ';', ',')
    ACTIVE: if(s.Termination_Date IS NULL, 'T', 'F')
    FIRST_NAME: s.first_name
    LAST_NAME: s.last_name
    MI: s.mi
    COMPANY_NAME: s.Data_Folder_Id
    PRINT_AS: s.first_name || ' ' || if(s.mi = '', '', s.mi || ' ') || s.last_name
    PHONE1: CAST(NULL AS VARCHAR)
    EMAIL1: CAST(NULL AS VARCHAR)
    CELLPHONE: CAST(NULL AS VARCHAR)
    ADDRESS1: CAST(NULL AS VARCHAR)
    ADDRESS2: CAST(NULL AS VARCHAR)
    CITY: CAST(NULL AS VARCHAR)
    STATE: CAST(NULL AS VARCHAR)
    ZIP: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS VARCHAR)
    """,
    """FROM staff s
    LEFT JOIN map_employee m ON m.legacy_employee_id = s.Employee AND m.data_folder_id = s.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = s.Data_Folder_Id""",
)

EXPECTED["import_bank_accounts"] = select(
    f"""
    D: b.Data_Folder_Id
    D: b.Account_Type
    ACCOUNT_ID: b.Bank_Account
    ACCOUNT_NUMBER: CAST(NULL AS VARCHAR)
    BANK_NAME: b.Bank_Name
    D: b.Description
    ROUTING_NUMBER: ''
    BRANCH_ID: CAST(NULL AS VARCHAR)
    ADDRESS1: CAST(NULL AS VARCHAR)
    ADDRESS2: CAST(NULL AS VARCHAR)
    CITY: CAST(NULL AS VARCHAR)
    STATE: CAST(NULL AS VARCHAR)
    ZIP: CAST(NULL AS VARCHAR)
    COUNTRY: ''
    PHONE_NUMBER: CAST(NULL AS VARCHAR)
    CURRENCY: ''
    GL_ACCOUNT: coalesce(t.acct_no, '(MISSING)')
    SERVICE_CHARGE_GLACCOUNT: ''
    INTEREST_EARNED_GLACCOUNT: ''
    LOCATION_ID: e.new_entity_id
    D: 'LGCY_GEN_ACCT:' || b.General_Cash_Account
    D: 'LAST_RECON:' || coalesce({iso('b.Last_Reconciled_Date')}, '')
    """,
    """FROM fx_bank b
    LEFT JOIN targets t ON t.account = b.General_Cash_Account AND t.data_folder_id = b.Data_Folder_Id
    LEFT JOIN map_entity e ON e.legacy_entity_id = t.prefixa AND e.data_folder_id = b.Data_Folder_Id""",
)

_OPEN_CASH = columns(
    f"""
    D: r.Data_Folder_Id
    D: r.Bank_Account
    DATE: r.Accounting_Date
    DOC_NO: r.Check_No
    TYPE: if(r.Subtraction > 0, 'checkdebit', 'depositcredit')
    AMOUNT: if(r.Subtraction > 0, r.Subtraction, r.Addition)
    PAYEE: r.Payee
    DESCRIPTION: r.Description
    D: 'LAST_RECON:' || coalesce({iso('b.Last_Reconciled_Date')}, '')
    D: r.Subtraction
    D: r.Addition
    D: b.General_Cash_Account
    D: CAST(NULL AS VARCHAR)
    """,
    """FROM fx_bank_register r
    LEFT JOIN fx_bank b ON b.Data_Folder_Id = r.Data_Folder_Id AND b.Bank_Account = r.Bank_Account
    WHERE r.Reconciliation_Status IN ('C', 'O')""",
)
CTES["open_cash"] = _OPEN_CASH
EXPECTED["import_open_cash"] = sql("SELECT * FROM open_cash")

EXPECTED["import_customers"] = select(
    """
    D: k.Data_Folder_Id
    CUSTOMER_ID: m.new_customer_id
    LEGACY_CUSTOMER: k.Customer || ' | ' || k.Data_Folder_Id
    CUST_NAME: k.Name
    TAXGROUP: CAST(NULL AS VARCHAR)
    TERM_NAME: if(k.Days_Before_Due = 0, '', 'Net ' || CAST(k.Days_Before_Due AS VARCHAR))
    CREDIT_LIMIT: CAST(NULL AS DECIMAL(18,2))
    ACTIVE: ''
    CONTACT_NAME: k.Name
    PRINT_AS: k.Name
    PHONE1: CAST(NULL AS VARCHAR)
    FAX: CAST(NULL AS VARCHAR)
    EMAIL1: CAST(NULL AS VARCHAR)
    ADDRESS1: CAST(NULL AS VARCHAR)
    ADDRESS2: CAST(NULL AS VARCHAR)
    CITY: CAST(NULL AS VARCHAR)
    STATE: s1.state_name
    ZIP: CAST(NULL AS VARCHAR)
    COUNTRY: ''
    B_CONTACT_NAME: CAST(NULL AS VARCHAR)
    B_EMAIL1: CAST(NULL AS VARCHAR)
    B_ADDRESS1: CAST(NULL AS VARCHAR)
    B_ADDRESS2: CAST(NULL AS VARCHAR)
    B_CITY: CAST(NULL AS VARCHAR)
    B_STATE: s2.state_name
    B_ZIP: CAST(NULL AS VARCHAR)
    """,
    """FROM fx_customer k
    JOIN map_customer m ON m.legacy_customer_id = k.Customer AND m.data_folder_id = k.Data_Folder_Id
        AND m.include_customer = 1
    LEFT JOIN states s1 ON s1.state_id = k.State
    LEFT JOIN states s2 ON s2.state_id = k.Billing_State""",
)

_VENDORS = """FROM fx_vendor v
    JOIN map_vendor m ON m.legacy_vendor_id = v.Vendor AND m.data_folder_id = v.Data_Folder_Id
        AND m.include_vendor = 1
    LEFT JOIN tax_forms t ON t.form_type_1099_desc = v.Form_Type_1099
    LEFT JOIN states s ON s.state_id = v.State"""
_METHOD = "CASE v.Default_Payment_Type WHEN 'Electronic' THEN '{}' WHEN 'Check' THEN '{}' ELSE 'Unknown Type' END"
_ROUTING = "right('000000000' || v.Bank_ID, 9)"
_BANK_KIND = "if(v.Account_Type = 'Checking', 'Checking Account', 'Savings Account')"

EXPECTED["import_vendors"] = select(
    f"""
    D: v.Data_Folder_Id
    VENDOR_ID: m.new_vendor_id
    LEGACY_VENDOR: m.legacy_vendor_id
    NAME: v.Name
    VENDTYPE_NAME: v.Type
    TAX_ID: CAST(NULL AS VARCHAR)
    VENDOR_ACCTNO: CAST(NULL AS VARCHAR)
    GL_ACCTNO: CAST(NULL AS VARCHAR)
    BILLING_TYPE: 0
    FORM1099TYPE: if(v.Receives_Form_1099 = 0, '', t.form_type_1099_code)
    FORM1099BOX: if(v.Receives_Form_1099 = 0, '', '1')
    NAME1099: CAST(NULL AS VARCHAR)
    CONTACT_NAME: v.Name
    PRINT_AS: v.Name
    PHONE1: CAST(NULL AS VARCHAR)
    FAX: CAST(NULL AS VARCHAR)
    EMAIL1: CAST(NULL AS VARCHAR)
    EMAIL2: CAST(NULL AS VARCHAR)
    URL1: ''
    ADDRESS1: CAST(NULL AS VARCHAR)
    ADDRESS2: CAST(NULL AS VARCHAR)
    CITY: CAST(NULL AS VARCHAR)
    STATE: s.state_name
    ZIP: CAST(NULL AS VARCHAR)
    COUNTRY: CAST(NULL AS VARCHAR)
    TERM_NAME: CASE WHEN v.Discount_Days > 0 THEN format('{{}}/{{}} net {{}}', v.Discount_Percent, v.Discount_Days, v.Payment_Days) WHEN v.Payment_Days = 0 THEN 'Due Upon Receipt' ELSE format('net {{}}', v.Payment_Days) END
    D: v.Contact_1_Name
    FIRST_NAME: trim(left(v.Contact_1_Name, instr(v.Contact_1_Name, ' ')))
    LAST_NAME: substr(v.Contact_1_Name, instr(v.Contact_1_Name, ' ') + 1, 30)
    PAYMENT_METHOD: {_METHOD.format('ACH', 'Printed Check')}
    ACH_ENABLED: {_METHOD.format('T', 'F')}
    ACH_BANK_ROUTING_NUMBER: {_ROUTING}
    ACH_ACCOUNT_NUMBER: CAST(NULL AS VARCHAR)
    ACH_ACCOUNT_TYPE: {_BANK_KIND}
    ACH_SEC_CODE: if(v.Default_Payment_Type = 'Electronic', 'CCD', NULL)
    PAYMENT_NOTIFICATION: if(v.Default_Payment_Type = 'Electronic', 'T', 'F')
    D: v.Vendor
    D: v.Name
    D: v.Account_Type
    """,
    _VENDORS,
)
EXPECTED["import_vendors_ach"] = select(
    f"""
    D: v.Data_Folder_Id
    VENDOR_ID: m.new_vendor_id
    PAYMENT_METHOD: 'ACH'
    ACH_ENABLE: 'T'
    ACH_BANK_ROUTING_NUMBER: {_ROUTING}
    ACH_ACCOUNT_NUMBER: CAST(NULL AS VARCHAR)
    ACH_ACCOUNT_TYPE: {_BANK_KIND}
    ACH_SEC_CODE: 'CCD'
    PAYMENT_NOTIFICATION: 'T'
    D: m.legacy_vendor_id
    """,
    _VENDORS + " WHERE v.Default_Payment_Type = 'Electronic'",
)
EXPECTED["import_vendor_1099"] = select(
    """
    D: v.Data_Folder_Id
    VENDORID: m.new_vendor_id
    VENDORNAME: v.Name
    ENTITY: e.new_entity_id
    FORM1099TYPE: coalesce(t.form_type_1099_code, '')
    FORM1099BOX: '1'
    AMOUNT: v.Amt_Paid_This_Yr_1099
    D: v.Form_Type_1099
    D: v.Receives_Form_1099
    D: 'LG_VD|' || v.Vendor
    """,
    """FROM fx_vendor v
    LEFT JOIN map_vendor m ON m.legacy_vendor_id = v.Vendor AND m.data_folder_id = v.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = v.Data_Folder_Id
    LEFT JOIN tax_forms t ON t.form_type_1099_desc = v.Form_Type_1099
    WHERE v.Receives_Form_1099 = 1 AND v.Amt_Paid_This_Yr_1099 > 0""",
)

EXPECTED["import_projects"] = select(
    f"""
    D: j.Data_Folder_Id
    PROJECT_ID: m.new_job_id
    PROJECT_NAME: j.Description
    LEGACY_PROJECT_ID: j.Job || if(coalesce(m.legacy_extra_id, '') = '', '', ' | Extra: ' || m.legacy_extra_id)
    PROJECT_CATEGORY: 'Contract'
    PRINT_AS: ''
    STREET_ADDRESS_LINE_1: CAST(NULL AS VARCHAR)
    STREET_ADDRESS_LINE_2: CAST(NULL AS VARCHAR)
    CITY: CAST(NULL AS VARCHAR)
    STATE: CAST(NULL AS VARCHAR)
    ZIP: CAST(NULL AS VARCHAR)
    BILLINGTYPE: 'Fixed Fee'
    PROJECT_STATUS: 'Active'
    CUSTOMER_ID: m.new_customer_id
    PROJECT_MANAGER_ID: m.new_pm_id
    BEGIN_DATE: coalesce({iso('j.Actual_Start_Date')}, '')
    END_DATE: coalesce({iso('j.Estimated_Comp_Date')}, '')
    LOCATION_ID: m.new_entity_id
    DEPARTMENT_ID: m.new_department_id
    CLASS_ID: m.new_class_id
    D: j.AR_Customer
    D: j.Cost_Account_Prefix
    D: coalesce({iso('j.Last_Cost_Update')}, '')
    D: CAST(NULL AS VARCHAR)
    """,
    """FROM fx_job j
    JOIN jobs_in m ON m.legacy_job_id = j.Job AND m.data_folder_id = j.Data_Folder_Id
    LEFT JOIN map_customer k ON k.legacy_customer_id = j.AR_Customer AND k.data_folder_id = j.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = j.Data_Folder_Id
    LEFT JOIN map_department d ON d.legacy_department_id = j.Cost_Account_Prefix
        AND d.data_folder_id = j.Data_Folder_Id""",
)

EXPECTED["import_standard_cost_types"] = select(
    """
    D: g.Data_Folder_Id
    D: 'LGCY_CT|' || g.Category
    D: 'LGCY_ACCT|' || g.Cost_Account_A
    STANDARDCOSTTYPE_ID: m.new_cost_type_id
    STANDARDCOSTTYPE_NAME: g.Description
    DESCRIPTION: ''
    ACCUMULATIONTYPENAME: g.Accumulate_As
    COSTUNITDESCRIPTION: g.Cost_Unit_Description
    ACTIVE: 'T'
    ACCOUNTNO: coalesce(b.new_base_account, '')
    PARENT_STANDARDCOSTTYPE: ''
    ITEM_ID: g.Accumulate_As
    LEGACY_ID: g.Category
    """,
    """FROM fx_std_category g
    LEFT JOIN map_cost_type m ON m.legacy_cost_type_id = g.Category AND m.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_base_account b ON b.legacy_base_account = g.Cost_Account_A
        AND b.data_folder_id = g.Data_Folder_Id""",
)

CTES["code_slots"] = """
    SELECT Data_Folder_Id, Cost_Code, Description, unnest([Category_1, Category_2, Category_3]) AS cat,
        coalesce(TRY_CAST(nullif(trim(right(Cost_Code, length(Cost_Code) - instr(Cost_Code, '-'))), '') AS INT), 0)
            AS num
    FROM fx_std_cost_code
"""
CTES["code_parents"] = """
    SELECT Cost_Code, CASE WHEN instr(Cost_Code, '-') = 0 THEN NULL
        WHEN CAST(split_part(Cost_Code, '-', 2) AS INT) = 0 THEN ''
        ELSE split_part(Cost_Code, '-', 1) || '-' || repeat('0', length(split_part(Cost_Code, '-', 2))) END AS parent
    FROM (SELECT DISTINCT Cost_Code FROM fx_std_cost_code)
"""
CTES["code_rows"] = """
    SELECT DISTINCT s.Data_Folder_Id AS folder, 'LGCY_CC | ' || s.Cost_Code AS legacy, m.new_cost_code_id AS task,
        s.Description AS name, p.parent, s.cat
    FROM code_slots s JOIN code_parents p ON p.Cost_Code = s.Cost_Code
    LEFT JOIN map_cost_code m ON m.legacy_cost_code_id = s.Cost_Code AND m.data_folder_id = s.Data_Folder_Id
    WHERE (trim(s.cat) <> '' AND s.num <> 0) OR (trim(s.cat) = '' AND s.num = 0)
"""
EXPECTED["import_standard_cost_codes"] = select(
    f"""
    D: folder
    D: legacy
    STANDARDTASK_ID: {head('task')}
    STANDARDTASK_NAME: {head('name')}
    DESCRIPTION: ''
    ACTIVE: {head("'T'")}
    ITEM_ID: {head("'T'")}
    BILLABLE: {head("'T'")}
    MILESTONE: ''
    UTILIZED: ''
    PRIORITY: ''
    TIMETYPE_NAME: ''
    WBS_CODE: ''
    PARENT_STANDARDTASK_ID: parent
    CLASS_ID: ''
    PRODUCTIONUNITDESC: ''
    STANDARDCOSTTYPES_STANDARDCOSTTYPEID: cat
    """,
    f"""FROM (SELECT *, row_number() OVER (PARTITION BY task
        ORDER BY {by('folder', 'legacy', 'name', 'parent', 'cat')}) AS line FROM code_rows)""",
)

_CATEGORY_MAPS = """FROM fx_job_category g
    JOIN jobs_in j ON j.legacy_job_id = g.Job AND j.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_cost_code m ON m.legacy_cost_code_id = g.Cost_Code AND m.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_cost_type t ON t.legacy_cost_type_id = g.Category AND t.data_folder_id = g.Data_Folder_Id"""
EXPECTED["import_cost_types"] = select(
    """
    D: g.Data_Folder_Id
    PROJECT_ID: j.new_job_id
    TASK_ID: coalesce(m.new_cost_code_id, g.Cost_Code)
    STANDARDCOSTTYPE_ID: t.new_cost_type_id
    D: 'L_JOB | ' || g.Job
    D: 'L_EXTRA | ' || g.Extra
    D: 'L_CC | ' || g.Cost_Code
    D: 'L_CT | ' || g.Category
    """,
    _CATEGORY_MAPS,
)
EXPECTED["import_cost_codes"] = select(
    """
    D: g.Data_Folder_Id
    TASK_NAME: ifnull(m.new_cost_code_name, g.Description)
    PROJECT_ID: j.new_job_id
    ITEM_ID: 'Other'
    BILLABLE: 'T'
    ACTIVE: 'T'
    STANDARDTASK_ID: ifnull(m.new_cost_code_id, '')
    COSTTYPE_ID: ''
    TASK_ID: CASE WHEN m.new_cost_code_id IS NULL THEN g.Cost_Code ELSE '' END
    D: 'LGCY_CC | ' || g.Cost_Code
    D: ''
    D: ''
    D: ''
    """,
    """FROM fx_job_cost_code g
    JOIN jobs_in j ON j.legacy_job_id = g.Job AND j.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_cost_code m ON m.legacy_cost_code_id = g.Cost_Code AND m.data_folder_id = g.Data_Folder_Id""",
)

# --- payables --------------------------------------------------------------------------------

CTES["ap_rows"] = f"""
    SELECT d.Data_Folder_Id, d.Vendor, d.Invoice, d.Dist_Seq, d.Description,
        CASE WHEN e.pkg_npc_commit = 0 OR (e.pkg_npc_commit = 1 AND (d.Job = '' OR j.include_job = 0)) THEN ''
            ELSE '#NPC' END AS _package,
        i.Data_Folder_Id AS _folder, coalesce({iso('i.Invoice_Date')}, '') AS _date,
        coalesce({iso('i.Accounting_Date')}, '') AS _posting, coalesce({iso('i.Payment_Date')}, '') AS _due,
        m.new_vendor_id AS _vendor, i.Invoice AS _invoice,
        CASE WHEN j.include_job = 1 THEN coalesce(j.new_job_id, '') ELSE '' END AS _project,
        d.Amount - d.Amount_Paid AS _price, d.Retainage - d.Retainage_Paid AS _retained, e.new_entity_id AS _entity,
        coalesce(k.new_cost_code_id, '') AS _task, coalesce(t.new_cost_type_id, '') AS _type,
        i.Vendor AS inv_vendor, v.Name AS vendor_name, d.Job, d.Extra,
        left(d.Expense_Account, f.Account_Prefix_A_Length) AS _account_prefix, d.Cost_Code, d.Category, d.Commitment,
        if(m.include_vendor = 1, 'ok', 'Missing Vendor') AS _check
    FROM fx_ap_distribution d
    LEFT JOIN fx_ap_invoice i ON i.Data_Folder_Id = d.Data_Folder_Id AND i.Vendor = d.Vendor AND i.Invoice = d.Invoice
    LEFT JOIN fx_vendor v ON v.Vendor = d.Vendor AND v.Data_Folder_Id = d.Data_Folder_Id
    LEFT JOIN map_vendor m ON m.legacy_vendor_id = d.Vendor AND m.data_folder_id = d.Data_Folder_Id
    LEFT JOIN map_cost_code k ON k.legacy_cost_code_id = d.Cost_Code AND k.data_folder_id = d.Data_Folder_Id
    LEFT JOIN map_cost_type t ON t.legacy_cost_type_id = d.Category AND t.data_folder_id = d.Data_Folder_Id
    LEFT JOIN fx_account_format f ON f.Data_Folder_Id = d.Data_Folder_Id
    LEFT JOIN jobs_plain j ON j.legacy_job_id = d.Job AND j.data_folder_id = d.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = d.Data_Folder_Id
    WHERE (i.Status = 'Open' AND d.Amount - d.Amount_Paid <> 0) OR d.Retainage - d.Retainage_Paid <> 0
"""
EXPECTED["import_open_ap"] = select(
    f"""
    D: _package
    D: _folder
    TRANSACTIONTYPE: {head("'Startup AP'")}
    DATE: {head('_date')}
    GLPOSTINGDATE: {head('_posting')}
    VENDOR_ID: {head('_vendor')}
    VENDORDNOCNO: {head('_invoice')}
    DOCUMENTNO: {head('_invoice')}
    REFERENCENO: {head('_invoice')}
    DATEDUE: {head('_due')}
    PROJECTID: {head('_project')}
    STATE: {head("'Closed'")}
    LINE: line
    ITEMID: 'Beginning Balance'
    ITEMDESC: Description
    QUANTITY: '1'
    UNIT: 'Each'
    CONVERSIONTYPE: 'Price'
    PRICE: _price
    LOCATIONID: _entity
    DEPARTMENTID: ''
    PODOCUMENTENTRY_PROJECTID: _project
    PODOCUMENTENTRY_TRX_AMOUNTRETAINED: _retained
    PODOCUMENTENTRY_TASKID: _task
    PODOCUMENTENTRY_COSTTYPEID: _type
    PODOCUMENTENTRY_VENDORID: _vendor
    MEMO: Description
    D: _price
    D: 'LG_VEND_ID|' || inv_vendor
    D: 'LG_VEND_NAME|' || vendor_name
    D: 'LG_JOB|' || Job
    D: 'LG_EXTRA|' || Extra
    D: 'GL_PREF|' || _account_prefix
    D: 'LG_CC|' || Cost_Code
    D: 'LG_DESC|' || Description
    D: 'LG_CT|' || Category
    D: 'LG_COMMIT|' || Commitment
    D: 'VND_CHK|' || _check
    """,
    f"""FROM (SELECT *, row_number() OVER (PARTITION BY Data_Folder_Id, Vendor, Invoice
        ORDER BY {by(*OPEN_AP_ORDER)}) AS line FROM ap_rows)""",
)

# --- receivables -----------------------------------------------------------------------------

_STATUS = "Customer, Status_Type, Status_Date, Status_Seq, Data_Folder_Id"
CTES["ar_sums"] = f"""
    SELECT {_STATUS}, CAST(sum(Amount + Retainage) AS DECIMAL(38,2)) AS net_amount,
        min(coalesce(Due_Date, {NO_DAY})) AS due_date, min(coalesce(Accounting_Date, {NO_DAY})) AS accounting_date,
        max(Job) AS job
    FROM fx_art
    WHERE Amount_Type <> 'Retainage released' AND coalesce(Accounting_Date, {NO_DAY}) <= {DETAIL_STOP}
    GROUP BY ALL
"""
CTES["ar_held"] = f"""
    SELECT {_STATUS}, CAST(sum(Retainage_Held) AS DECIMAL(38,2)) AS ret_net,
        CAST(sum(if(Activity_Type = 'Invoice', Retainage_Held, 0)) AS DECIMAL(38,2)) AS ret_held,
        CAST(sum(if(Activity_Type = 'Retainage released', Retainage_Held, 0)) AS DECIMAL(38,2)) AS ret_rel,
        CAST(sum(Retainage_Billed) AS DECIMAL(38,2)) AS ret_bil
    FROM fx_ara_activity GROUP BY ALL
"""
CTES["ar_open"] = f"""
    SELECT a.*, s.Invoice AS invoice, s.Status AS status,
        coalesce(h.ret_net, 0.00) AS net, coalesce(h.ret_held, 0.00) AS held, coalesce(h.ret_rel, 0.00) AS rel,
        coalesce(h.ret_bil, 0.00) AS bil, coalesce(c.Name, '') AS _name, coalesce(m.new_customer_id, '') AS customer_id
    FROM ar_sums a JOIN fx_ara_status s USING ({_STATUS})
    LEFT JOIN ar_held h USING ({_STATUS})
    LEFT JOIN fx_customer c ON c.Customer = a.Customer AND c.Data_Folder_Id = a.Data_Folder_Id
    LEFT JOIN map_customer m ON m.legacy_customer_id = a.Customer AND m.data_folder_id = a.Data_Folder_Id
    WHERE a.net_amount <> 0 OR coalesce(h.ret_net, 0) <> 0
"""
CTES["ar_rows"] = f"""
    SELECT a.Data_Folder_Id AS folder, a.Customer, {iso('a.Status_Date')} AS _date,
        {iso(f'nullif(a.accounting_date, {NO_DAY})')} AS _posting, a.invoice AS _document, customer_id AS _customer,
        {iso(f'nullif(a.due_date, {NO_DAY})')} AS _due, CAST(net_amount AS DECIMAL(38,2)) AS _price,
        coalesce(e.new_entity_id, '') AS _entity,
        CASE WHEN j.include_job = 1 THEN coalesce(j.new_job_id, '') ELSE '' END AS _project, _name,
        net AS _net, held AS _held, rel AS _rel, bil AS _bil
    FROM ar_open a
    LEFT JOIN map_entity e ON e.data_folder_id = a.Data_Folder_Id
    LEFT JOIN jobs_plain j ON j.data_folder_id = a.Data_Folder_Id AND j.legacy_job_id = a.job
"""


def _open_ar(project: str, numbered: bool) -> str:
    def top(value: str) -> str:
        return head(value) if numbered else value

    line = (
        f"row_number() OVER (PARTITION BY folder, _customer, _document, _posting "
        f"ORDER BY {by(*OPEN_AR_ORDER)})"
        if numbered
        else "CAST(1 AS BIGINT)"
    )
    startup, pending = top("'Startup AR'"), top("'Pending'")
    return select(
        f"""
        D: folder
        D: 'LG_CUST | ' || Customer
        TRANSACTIONTYPE: {startup}
        DATE: {top('_date')}
        GLPOSTINGDATE: {top('_posting')}
        DOCUMENTNO: {top('_document')}
        CUSTOMER_ID: {top('_customer')}
        TERMNAME: ''
        DATEDUE: {top('_due')}
        STATE: {pending}
        LINE_NO: line
        ITEMID: 'Revenue'
        QUANTITY: 1
        UNIT: 'Each'
        PRICE: _price
        LOCATIONID: _entity
        DEPARTMENTID: ''
        SODOCUMENTENTRY_CLASSID: ''
        SODOCUMENTENTRY_PROJECTID: {project}
        PROJECTID: {project}
        SODOCUMENTENTRY_CUSTOMERID: _customer
        MEMO: _name
        CONVERSIONTYPE: 'Price'
        SODOCUMENTENTRY_RETAINAGEPERCENTAGE: ''
        SODOCUMENTENTRY_AMOUNTRETAINED: CAST(-_net AS DECIMAL(38,2))
        D: 'LG_RET_NET | ' || CAST(_net AS VARCHAR)
        D: 'LG_RET_HELD | ' || CAST(_held AS VARCHAR)
        D: 'LG_RET_REL | ' || CAST(_rel AS VARCHAR)
        D: 'LG_RET_BIL | ' || CAST(_bil AS VARCHAR)
        D: 'LG_CUST_NME | ' || _name
        """,
        f"FROM (SELECT *, {line} AS line FROM ar_rows)",
    )


EXPECTED["import_open_ar"] = _open_ar("_project", True)
EXPECTED["open_ar_flat"] = _open_ar("''", False)
EXPECTED["open_ar_project"] = _open_ar("_project", False)
EXPECTED["ar_status_balance"] = sql("SELECT * FROM ar_sums")
EXPECTED["ar_retainage_balance"] = sql("SELECT * FROM ar_held")

CTES["aging"] = f"""
    SELECT Customer, _name AS Customer_Name, invoice AS Invoice, {iso('Status_Date')} AS Invoice_Date,
        {iso(f'nullif(due_date, {NO_DAY})')} AS Due_Date, status AS Status, net_amount AS Amount,
        CAST(net AS DECIMAL(38,2)) AS Ret_Net, CAST(held AS DECIMAL(38,2)) AS Ret_Held,
        CAST(rel AS DECIMAL(38,2)) AS Ret_Rel, CAST(bil AS DECIMAL(38,2)) AS Ret_Bil,
        CAST(net_amount + net AS DECIMAL(38,2)) AS Total_Outstanding, customer_id AS New_Customer_ID
    FROM ar_open
"""
_SUMS = ", ".join(
    f"CAST(sum({n}) AS DECIMAL(38,2)) AS {n}"
    for n in ("Amount", "Ret_Net", "Ret_Held", "Ret_Rel", "Ret_Bil", "Total_Outstanding")
)
EXPECTED["report_open_ar_aging"] = sql(
    f"""SELECT *, 0 AS is_total FROM aging UNION ALL BY NAME
    SELECT '~~~~ TOTALS ~~~~' AS Customer, '' AS Customer_Name, '' AS Invoice, '' AS Invoice_Date, '' AS Due_Date,
        '' AS Status, {_SUMS}, '' AS New_Customer_ID, 1 AS is_total FROM aging"""
)

_LABEL = """CASE
    WHEN a.Transaction_Type IN ('Issued invoice', 'Invoice') THEN
        CASE a.Amount_Type WHEN 'Retainage released' THEN 'Ret. Released' ELSE 'Invoice' END
    WHEN a.Transaction_Type = 'Invoice adjustment' THEN {adjustment}
    ELSE a.Transaction_Type END"""
CTES["activity_rows"] = f"""
    SELECT a.Data_Folder_Id AS folder, 'LG_CUST | ' || a.Customer AS _legacy,
        CASE WHEN a.Amount_Type IN ('Retainage billed', 'Retainage released') THEN CAST(NULL AS DATE)
            ELSE r.Status_Date END AS raw_date,
        a.Accounting_Date AS raw_posting,
        CASE WHEN a.Transaction_Type <> 'Invoice' THEN ''
            WHEN a.Amount_Type = 'Retainage released' THEN 'RetBill: ' || coalesce(a.Invoice, '')
            ELSE coalesce(a.Invoice, '') END AS _document,
        m.new_customer_id AS raw_customer, a.Due_Date AS raw_due, e.new_entity_id AS _entity,
        CASE WHEN j.include_job = 1 THEN coalesce(j.new_job_id, '') ELSE '' END AS _project,
        CAST(NULL AS VARCHAR) AS memo,
        CASE WHEN a.Amount_Type = 'Retainage released' THEN 0 ELSE a.Amount + a.Retainage END
            + CASE WHEN a.Amount_Type = 'Retainage billed' THEN 0 ELSE -a.Retainage END AS price,
        -a.Retainage AS retained,
        'LG_JOB_ID | ' || a.Job AS _t02, 'LG_JOB_DESC | ' || w.Description AS _t03,
        'LG_TRANS_TYPE | ' || {_LABEL.format(adjustment='NULL')} AS _t04, 'LG_STS_TYP | ' || a.Status_Type AS _t05,
        'LG_TRN_TYP | ' || a.Transaction_Type AS _t06, 'LG_AMT_TYP | ' || a.Amount_Type AS _t07,
        CAST(NULL AS VARCHAR) AS _t08, 'LG_ACT_TYP | ' || r.Activity_Type AS _t09, 'LG_EXTRA | ' || a.Extra AS _t10,
        CAST(NULL AS VARCHAR) AS _t11, 'LG_TRAN_TYPE | ' || {_LABEL.format(adjustment="''")} AS _t12,
        'LG_CUST_NME | ' || c.Name AS _t14, CAST(NULL AS VARCHAR) AS _t15
    FROM fx_art a
    LEFT JOIN fx_customer c ON c.Customer = a.Customer AND c.Data_Folder_Id = a.Data_Folder_Id
    LEFT JOIN fx_ara_activity r ON r.Customer = a.Customer AND r.Status_Type = a.Status_Type
        AND r.Status_Date = a.Status_Date AND r.Status_Seq = a.Status_Seq AND r.Actvty_Seq = a.Actvty_Seq
        AND r.Data_Folder_Id = a.Data_Folder_Id
    LEFT JOIN fx_job w ON w.Job = a.Job AND w.Data_Folder_Id = a.Data_Folder_Id
    LEFT JOIN map_job j ON j.legacy_job_id = a.Job AND j.data_folder_id = a.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = a.Data_Folder_Id
    LEFT JOIN map_customer m ON m.legacy_customer_id = a.Customer AND m.data_folder_id = a.Data_Folder_Id
    WHERE coalesce(a.Accounting_Date, {NO_DAY}) <= {DETAIL_STOP}
        AND a.Amount_Type NOT IN ('NSF Bank charge', 'Stored materals')
"""
_ACTIVITY_KEYS = ", ".join(
    ["folder", "_legacy", "raw_date", "raw_posting", "_document", "raw_customer", "raw_due", "_entity", "_project"]
    + ACTIVITY_TAGS
)
CTES["activity_sums"] = f"""
    SELECT {_ACTIVITY_KEYS}, coalesce({iso('coalesce(raw_date, raw_posting)')}, '') AS _date,
        coalesce({iso('raw_posting')}, '') AS _posting, coalesce(raw_customer, '') AS _customer,
        coalesce({iso('raw_due')}, '') AS _due, CAST(sum(price) AS DECIMAL(38,2)) AS _price,
        CAST(sum(retained) AS DECIMAL(38,2)) AS _retained, max(memo) AS _memo
    FROM activity_rows GROUP BY {_ACTIVITY_KEYS}
"""
EXPECTED["ar_activity_by_basis"] = select(
    f"""
    D: folder
    D: _legacy
    TRANSACTIONTYPE: {head("'Startup AR'")}
    DATE: {head('_date')}
    GLPOSTINGDAT: {head('_posting')}
    DOCUMENTNO: {head('_document')}
    CUSTOMER_ID: {head('_customer')}
    TERMNAME: ''
    DATEDUE: {head('_due')}
    STATE: {head("'Pending'")}
    LINE_NO: line
    ITEMID: 'Revenue'
    QUANTITY: '1'
    UNIT: 'Each'
    PRICE: _price
    LOCATIONID: _entity
    DEPARTMENTID: ''
    SODOCUMENTENTRY_CLASSID: ''
    SODOCUMENTENTRY_PROJECTID: _project
    PROJECTID: _project
    SODOCUMENTENTRY_CUSTOMERID: _customer
    MEMO: _memo
    CONVERSIONTYPE: 'Price'
    SODOCUMENTENTRY_RETAINAGEPERCENTAGE: ''
    SODOCUMENTENTRY_AMOUNTRETAINED: _retained
    """
    + "\n".join(f"D: coalesce({t}, '')" for t in ACTIVITY_TAGS),
    f"""FROM (SELECT *, row_number() OVER (PARTITION BY folder, _customer, _document, _posting
        ORDER BY {by(*ACTIVITY_ORDER)}) AS line FROM activity_sums)""",
)

# --- contracts and estimates -----------------------------------------------------------------

CTES["rebased"] = """
    SELECT i.*, j.new_job_id AS job_id, c.Contract AS contract_id, c.Data_Folder_Id AS contract_folder,
        c.Description AS contract_name, coalesce(c.Contract_Date, c.Date_Stamp) AS contract_day,
        CASE WHEN instr(c.Contract, '-') > 0 AND instr(j.new_job_id, '-') > 0
            THEN split_part(j.new_job_id, '-', 1) || substr(c.Contract, instr(c.Contract, '-'))
            ELSE c.Contract END AS rebased_id,
        m.new_customer_id AS customer_id
    FROM fx_contract_item i
    JOIN jobs_in j ON j.data_folder_id = i.Data_Folder_Id AND j.legacy_job_id = i.Job
    LEFT JOIN fx_contract c ON c.Data_Folder_Id = i.Data_Folder_Id AND c.Contract = i.Contract
    LEFT JOIN map_customer m ON m.data_folder_id = i.Data_Folder_Id AND m.legacy_customer_id = i.Customer
"""
CTES["contract_heads"] = """
    SELECT DISTINCT r.Data_Folder_Id AS folder, contract_id, rebased_id, contract_name, job_id, customer_id,
        contract_day, if(Billing_Type IN ('Progress Billing', 'Lump Sum'), 'Fixed Price', 'TM') AS kind,
        d.Revised_Contract AS revised
    FROM rebased r
    LEFT JOIN fx_contract_derived d ON d.Data_Folder_Id = contract_folder AND d.Contract = contract_id
"""
EXPECTED["import_contract_header"] = select(
    """
    D: folder
    D: contract_id
    PROJECTCONTRACTID: rebased_id
    NAME: contract_name
    PROJECTID: job_id
    CUSTOMERID: customer_id
    DATE: contract_day
    DESCRIPTION: ''
    PROJECTCONTRACTTYPE: kind
    ARCHITECT: ''
    BILLABLE: 'true'
    STATUS: 'active'
    POSTED: 'true'
    POSTEDTO: contract_day
    ORIGINALGLBUDGETID: 'Original Contract'
    REVISIONGLBUDGETID: 'Revision Contract'
    APPROVEDGLBUDGETID: 'Approved CO Contract'
    PENDINGGLBUDGETID: 'Pending CO Contract'
    FORECASTGLBUDGETID: 'Forecast Contract'
    OTHERGLBUDGETID: 'Other Contract'
    D: revised
    """
    + "\n".join(["D: CAST(NULL AS DECIMAL(18,2))"] * 5),
    "FROM contract_heads",
)

CTES["contract_split"] = """
    SELECT r.*, d.Revised_Contract AS revised, d.Approved_Contract_Changes AS changes,
        if(Original_Contract_Total >= 0, 'original', '') AS wf, 'Contract Item' AS item,
        Original_Contract_Total AS price
    FROM rebased r LEFT JOIN fx_contract_item_derived d ON d.Data_Folder_Id = r.Data_Folder_Id
        AND d.Contract = r.Contract AND d.Contract_Item = r.Contract_Item
    WHERE Original_Contract_Total <> 0
    UNION ALL
    SELECT r.*, d.Revised_Contract, d.Approved_Contract_Changes, 'revision', 'Contract CO Item',
        d.Approved_Contract_Changes
    FROM rebased r JOIN fx_contract_item_derived d ON d.Data_Folder_Id = r.Data_Folder_Id
        AND d.Contract = r.Contract AND d.Contract_Item = r.Contract_Item
    WHERE d.Approved_Contract_Changes <> 0
"""
EXPECTED["import_contract_lines"] = select(
    """
    D: s.Data_Folder_Id
    PROJECTCONTRACTID: rebased_id
    PROJECTCONTRACTLINEID: Contract_Item
    NAME: Description
    PROJECTID: job_id
    ITEMID: ''
    DESCRIPTION: Description
    CONTRACTLINEDATE: coalesce(Approval_Date, Date_Stamp)
    GLACCOUNTID: CAST(NULL AS VARCHAR)
    RETAINAGEPERCENTAGE: CAST(NULL AS DECIMAL(18,2))
    BILLABLE: 'true'
    STATUS: 'active'
    BILLINGTYPE: CASE WHEN Billing_Type IS NULL THEN '' WHEN Billing_Type = 'Progress Billing' THEN 'Progress' ELSE 'TM' END
    MAXIMUMBILLING: CASE Billing_Type WHEN 'Cost Plus to Maximum' THEN 'Specified amount' WHEN 'Time & Materials' THEN 'No maximum' ELSE '' END
    MAXIMUMBILLINGAMOUNT: CAST(CASE WHEN Billing_Type = 'Cost Plus to Maximum' THEN coalesce(revised, 0) ELSE 0 END AS DECIMAL(18,2))
    DEFAULTRATETABLEID: CAST(NULL AS VARCHAR)
    TSRATETABLEID: CAST(NULL AS VARCHAR)
    PORATETABLEID: CAST(NULL AS VARCHAR)
    APRATETABLEID: CAST(NULL AS VARCHAR)
    GLRATETABLEID: CAST(NULL AS VARCHAR)
    CCRATETABLEID: CAST(NULL AS VARCHAR)
    DEPARTMENTID: ''
    ENTRY_WFTYPE: wf
    ENTRY_PROJECTID: job_id
    ENTRY_TASKID: ''
    ENTRY_COSTTYPEID: ''
    ENTRY_ITEMID: item
    ENTRY_PRICE: price
    ENTRY_PRICEEFFECTIVEDATE: coalesce(Approval_Date, Date_Stamp)
    ENTRY_MEMO: ''
    ENTRY_DEPARTMENTID: ''
    TASKID: ''
    COSTTYPEID: ''
    ENTRY_CUSTOMERID: customer_id
    D: 'LG_PROJECT|' || Job
    D: 'LG_CUST|' || Customer
    D: revised
    D: changes
    D: CAST(NULL AS DECIMAL(18,2))
    D: CAST(NULL AS DECIMAL(18,2))
    D: CAST(NULL AS DECIMAL(18,2))
    D: CAST(NULL AS DECIMAL(18,2))
    D: CAST(NULL AS VARCHAR)
    D: CAST(NULL AS DECIMAL(18,2))
    D: Date_Stamp
    D: CAST(NULL AS INT)
    """,
    "FROM contract_split s LEFT JOIN map_entity e ON e.data_folder_id = s.Data_Folder_Id",
)

CTES["estimate_rows"] = """
    SELECT g.Data_Folder_Id, g.Job, g.Extra, g.Cost_Code, g.Category, g.Cost_Unit_Description, g.Cost_Account,
        j.new_job_id AS _job, m.new_cost_code_id AS _task, t.new_cost_type_id AS _type, e.new_entity_id AS _entity,
        d.new_department_id AS department, w.Last_Cost_Update AS updated, b._branch,
        if(b._branch = 'A', 'original', 'approved change') AS wf,
        if(b._branch = 'A', g.Original_Estimate_Units, g.Approved_Est_Unit_Changes) AS _qty,
        if(b._branch = 'A', g.Original_Estimate, g.Approved_Estimate_Changes) AS _amount,
        if(b._branch = 'A', k.Orig_Production_Units_Est, k.Apprvd_Prodctn_Unit_Chgs) AS _production
    FROM fx_job_category g JOIN (VALUES ('A'), ('B')) AS b(_branch) ON TRUE
    JOIN jobs_in j ON j.legacy_job_id = g.Job AND j.data_folder_id = g.Data_Folder_Id
    LEFT JOIN fx_job w ON w.Job = g.Job AND w.Data_Folder_Id = g.Data_Folder_Id
    LEFT JOIN fx_job_cost_code k ON k.Job = g.Job AND k.Extra = g.Extra AND k.Cost_Code = g.Cost_Code
        AND k.Data_Folder_Id = g.Data_Folder_Id
    LEFT JOIN map_cost_code m ON m.legacy_cost_code_id = g.Cost_Code AND m.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_cost_type t ON t.legacy_cost_type_id = g.Category AND t.data_folder_id = g.Data_Folder_Id
    LEFT JOIN map_department d ON d.legacy_department_id = w.Cost_Account_Prefix AND d.data_folder_id = w.Data_Folder_Id
    LEFT JOIN map_entity e ON e.data_folder_id = g.Data_Folder_Id
"""
EXPECTED["import_project_estimates"] = select(
    f"""
    D: Data_Folder_Id
    PJESTIMATEID: {head('_job')}
    DESCRIPTION: {head("_job || ' Estimate'")}
    STATUS: {head("'active'")}
    ISPRIMARY: {head("'true'")}
    PJESTIMATETYPENAME: {head("'Current Estimate'")}
    POSTED: {head("'TRUE'")}
    GLBUDGETID: {head("'Project Estimate'")}
    POSTTO: {head("'Estimate date'")}
    ESTIMATEDATE: {head("'2000-11-30'")}
    PROJECTID: {head('_job')}
    PJESTIMATEENTRY_LINENO: line
    PJESTIMATEENTRY_WFTYPE: wf
    PJESTIMATEENTRY_TASKID: _task
    PJESTIMATEENTRY_COSTTYPEID: _type
    PJESTIMATEENTRY_ITEMID: 'Beginning Balance'
    PJESTIMATEENRY_UNITCOST: ''
    PJESTIMATEENTRY_QTY: _qty
    PJESTIMATEENTRY_AMOUNT: _amount
    PJESTIMATEENTRY_EUOM: Cost_Unit_Description
    PJESTIMATEENTRY_PRODUCTIONUNITS: _production
    PJESTIMATEENTRY_ACCOUNTNO: CASE Category WHEN 'L' THEN '5100' WHEN 'S' THEN '5120' WHEN 'M' THEN '5110' ELSE '5130' END
    PJESTIMATEENTRY_EFFECTIVEDATE: {DETAIL_STOP}
    PJESTIMATEENTRY_LOCATIONID: _entity
    PJESTIMATEENTRY_PROJECTID: _job
    PJESTIMATEENTRY_DEPARTMENTID: department
    PJESTIMATEENTRY_CLASSID: ''
    DONOTIMPORT2: Job
    DONOTIMPORT3: Extra
    DONOTIMPORT4: Cost_Code
    DONOTIMPORT5: Category
    DONOTIMPORT6: Cost_Account
    DONOTIMPORT9: updated
    """,
    f"""FROM (SELECT *, row_number() OVER (PARTITION BY _job ORDER BY {by(*ESTIMATE_ORDER)}) AS line
        FROM estimate_rows WHERE _amount <> 0)""",
)

# --- general ledger --------------------------------------------------------------------------

CTES["newest"] = """
    SELECT Data_Folder_Id, Batch, Accounting_Date AS ad, Application_of_Origin FROM fx_glt
    QUALIFY row_number() OVER (PARTITION BY Data_Folder_Id, Batch
        ORDER BY Accounting_Date DESC NULLS LAST, Application_of_Origin DESC NULLS LAST) = 1
"""
CTES["gl_joined"] = """
    SELECT t.*, k.prefixa, coalesce(k.acct_no, '(MISSING)') AS acct_no, coalesce(l.new_location_id, '') AS loc,
        coalesce(d.new_department_id, '') AS dept, b.to_batch_alias AS alias, x.Application_of_Origin AS cx_origin,
        x.ad AS cx_ad
    FROM fx_glt t
    LEFT JOIN targets k ON k.account = t.Account AND k.data_folder_id = t.Data_Folder_Id
    LEFT JOIN (SELECT * FROM map_department WHERE legacy_department_id <> '' AND new_department_id <> '') d
        ON d.legacy_department_id = k.prefixabc AND d.data_folder_id = k.data_folder_id
    LEFT JOIN (SELECT * FROM map_location WHERE legacy_location_id <> '' AND new_location_id <> '') l
        ON l.legacy_location_id = k.prefixabc AND l.data_folder_id = k.data_folder_id
    LEFT JOIN map_batch_combine b ON b.source_batch = t.Batch
    LEFT JOIN newest x ON x.Batch = b.to_batch_id
    WHERE t.Accrual_or_Cash = 'Accrual'
"""


def _coarse(name: str, window: str, day: str, label: str) -> None:
    title = f"'Entity: ' || e.new_entity_id || ' | {label}: ' || {month(day)}"
    CTES[name] = f"""
        SELECT {day} AS _date, {day} AS _og_date, {title} AS _description, '' AS _reference, acct_no AS _acct,
            loc AS _location, dept AS _department, '' AS _document, {title} AS _memo, 1 AS _memo_order,
            t.Account AS _account, e.new_entity_id AS _entity, '' AS _reference2, '' AS _origin, Debit AS debit,
            Credit AS credit
        FROM gl_joined t LEFT JOIN map_entity e ON e.data_folder_id = t.Data_Folder_Id
        WHERE t.Accounting_Date BETWEEN {window}
    """


_coarse("gl_opening", f"DATE '1980-01-01' AND {BALANCE_END}", f"last_day({BALANCE_END})", "Starting_Balance")
_coarse("gl_month", f"{MONTH_START} AND {MONTH_STOP}", "last_day(t.Accounting_Date)", "Month_End")
_WHEN = month("coalesce(cx_ad, t.Accounting_Date)")
CTES["gl_detail"] = f"""
    SELECT last_day(t.Accounting_Date) AS _date, t.Accounting_Date AS _og_date,
        'Entity: ' || e.new_entity_id || ' | Origin: ' || coalesce(cx_origin, t.Application_of_Origin) || ' | Batch: '
            || coalesce(alias, t.Batch) || ' | Batch Date: ' || {_WHEN} || ' | Acct Date: ' || {_WHEN} AS _description,
        Reference_1 AS _reference, acct_no AS _acct, loc AS _location, dept AS _department, t.Batch AS _document,
        replace(Transaction_Desc, ',', '') || ' | Actg Date: ' || strftime(t.Accounting_Date, '%m-%d-%Y')
            || if(Vendor <> '', ' | Vendor ID: ' || Vendor, '') || if(AP_Invoice <> '', ' | AP Inv ID: ' || AP_Invoice, '')
            || if(Job <> '', ' | Job ID: ' || Job, '') || if(Customer <> '', ' | Customer ID: ' || Customer, '')
            || if(AR_Invoice <> '', ' | Cust Inv ID: ' || AR_Invoice, '') AS _memo,
        if(replace(Transaction_Desc, ',', '') = 'Summary Entry', 1, 2) AS _memo_order, t.Account AS _account,
        e.new_entity_id AS _entity, Reference_2 AS _reference2, t.Application_of_Origin AS _origin, Debit AS debit,
        Credit AS credit
    FROM gl_joined t
    LEFT JOIN map_entity e ON e.legacy_entity_id = t.prefixa AND e.data_folder_id = t.Data_Folder_Id
    WHERE t.Accounting_Date BETWEEN {DETAIL_START} AND {DETAIL_STOP}
"""


def _journal(rows: str, coarse: bool, repeat: bool = False) -> str:
    keys = ", ".join(LEDGER_KEYS)

    def top(value: str) -> str:
        return value if repeat else head(value)

    tags = """
        D: 'S300_ACCT|' || _account
        D: 'S300_ACCT_DATE|' || strftime(_og_date, '%Y-%m-%d')
        D: 'S300_REF1|' || _reference
        D: 'S300_REF2|' || _reference2
    """
    if coarse:
        tail = f"STATUS: 'POSTED'\n{tags}\nD: 'SI_ENT|' || _entity\nD: _description\nD: net"
    else:
        tail = f"D: net\nSTATUS: 'POSTED'\n{tags}\nD: 'S300_APP|' || _origin\nD: _description"
    journal, day = top("'OBJ'"), top(iso("_date"))
    return select(
        f"""
        D: 'Entity: ' || _entity
        JOURNAL: {journal}
        DATE: {day}
        DESCRIPTION: {top('_description')}
        REFERENCE: _reference
        LINE_NO: line
        ACCT_NO: _acct
        LOCATION_ID: _location
        DEPT_ID: _department
        CLASS_ID: ''
        DOCUMENT: _document
        MEMO: _memo
        DEBIT: if(net > 0, CAST(net AS VARCHAR), '')
        CREDIT: if(net < 0, CAST(-net AS VARCHAR), '')
        {tail}
        """,
        f"""FROM (
            SELECT *, row_number() OVER (PARTITION BY _entity, _date, _description ORDER BY {by(*LEDGER_ORDER)}) AS line
            FROM (SELECT {keys}, CAST(sum(debit) + sum(credit) AS DECIMAL(38,2)) AS net FROM {rows}
                GROUP BY {keys} HAVING round(sum(debit) + sum(credit), 2) <> 0))""",
    )


EXPECTED["import_gl_opening"] = _journal("gl_opening", True)
EXPECTED["import_gl_monthly"] = _journal("gl_month", True)
EXPECTED["import_gl_detail"] = _journal("gl_detail", False)
EXPECTED["gl_detail_flat"] = _journal("gl_detail", False, repeat=True)

# --- job cost --------------------------------------------------------------------------------

CTES["cost_live"] = f"""
    SELECT t.* FROM fx_jct t
    WHERE t.Commitment = '' AND t.Accounting_Date <= {DETAIL_STOP} AND t.Debit_Account <> ''
        AND t.Transaction_Type IN ('AP cost', 'EQ cost', 'JC cost', 'PR cost', 'IV cost', 'SM cost')
        AND EXISTS (SELECT 1 FROM fx_job_cost_code k WHERE k.Cost_Code = t.Cost_Code AND k.Job = t.Job
            AND k.Extra = t.Extra AND k.Data_Folder_Id = t.Data_Folder_Id)
"""
CTES["cost_base"] = """
    SELECT t.*, coalesce(j.new_job_id, '') || ' | Acct Date: '
            || coalesce(strftime(t.Accounting_Date, '%Y-%m-%d'), '') || ' | Application of Origin: '
            || coalesce(t.Application_of_Origin, '') || ' | Batch: ' || coalesce(t.Batch, '') AS _title,
        y.new_gl_account AS _acct, coalesce(j.new_entity_id, '') AS _entity,
        coalesce(j.new_department_id, '') AS _department, coalesce(j.new_class_id, '') AS _class,
        if(t.Application_of_Origin = 'AP', t.Invoice, t.AR_Invoice) AS _document,
        coalesce(replace(t.Description, ',', ''), '') || if(coalesce(t.Vendor, '') = '', '', ' Vendor ID: ' || t.Vendor)
            || if(coalesce(t.Invoice, '') = '', '', ' AP Inv ID: ' || t.Invoice)
            || if(coalesce(t.Job, '') = '', '', ' Job ID: ' || t.Job)
            || if(coalesce(t.Customer, '') = '', '', ' Customer ID: ' || t.Customer)
            || if(coalesce(t.AR_Invoice, '') = '', '', ' Cust Inv ID: ' || t.AR_Invoice) AS _memo,
        j.new_job_id AS _job, coalesce(x.new_cost_code_id, t.Cost_Code, '') AS _task,
        coalesce(y.new_cost_type_id, t.Category, '') AS _type, coalesce(v.new_vendor_id, '') AS _vendor,
        greatest(t.Amount, 0) AS up, greatest(-t.Amount, 0) AS down
    FROM cost_live t
    JOIN jobs_in j ON j.legacy_job_id = t.Job AND j.legacy_extra_id = t.Extra AND j.data_folder_id = t.Data_Folder_Id
    LEFT JOIN targets k ON k.account = t.Debit_Account AND k.data_folder_id = t.Data_Folder_Id
    LEFT JOIN map_cost_code x ON x.legacy_cost_code_id = t.Cost_Code AND x.data_folder_id = t.Data_Folder_Id
    LEFT JOIN map_cost_type y ON y.legacy_cost_type_id = t.Category AND y.data_folder_id = t.Data_Folder_Id
    LEFT JOIN map_vendor v ON v.legacy_vendor_id = t.Vendor AND v.data_folder_id = t.Data_Folder_Id
"""


_ENTRY = ", ".join(JOB_COST_ENTRY_KEYS)
_OFFSET = ", ".join(JOB_COST_OFFSET_KEYS)
CTES["cost_entries"] = f"""
    SELECT {_ENTRY}, CAST(sum(up) AS DECIMAL(38,2)) AS debit, CAST(sum(down) AS DECIMAL(38,2)) AS credit,
        '0' AS entry_offset
    FROM cost_base GROUP BY {_ENTRY}
    UNION ALL BY NAME
    SELECT {_OFFSET}, CAST(sum(down) AS DECIMAL(38,2)) AS debit, CAST(sum(up) AS DECIMAL(38,2)) AS credit,
        '1' AS entry_offset
    FROM cost_base GROUP BY {_OFFSET}
"""
CTES["cost_lines"] = f"""
    SELECT *, debit - credit AS net, row_number() OVER (PARTITION BY _title ORDER BY {by(*JOB_COST_ORDER)}) AS line
    FROM cost_entries
"""
CTES["cost_packed"] = """
    SELECT title, CAST(floor(coalesce(sum(n) OVER (ORDER BY title ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        / 5000) + 1 AS BIGINT) AS batch
    FROM (SELECT _title AS title, count(*) AS n FROM cost_lines GROUP BY _title)
"""


def _job_cost(repeat: bool) -> str:
    def top(value: str) -> str:
        return value if repeat else head(value)

    def entry(value: str) -> str:
        return f"CASE WHEN entry_offset = '0' THEN {value} ELSE '' END"

    return select(
        "\n".join(
            [
                "D: batch",
                "D: ''",
                f"JOURNAL: {top(chr(39) + 'OBJ' + chr(39))}",
                f"DATE: {top(iso('Accounting_Date'))}",
                "DESCRIPTION: " + top("'Cost Entry | ' || _title"),
                "REFERENCE_NO: ''",
                "LINE_NO: line",
                "ACCT_NO: _acct",
                "LOCATION_ID: _entity",
                "DEPT_ID: _department",
                "CLASS_ID: _class",
                f"DOCUMENT: {entry('_document')}",
                f"MEMO: {entry('_memo')}",
                "DEBIT: if(net >= 0, CAST(CAST(net AS DECIMAL(38,2)) AS VARCHAR), '')",
                "CREDIT: if(net < 0, CAST(CAST(-net AS DECIMAL(38,2)) AS VARCHAR), '')",
                "D: CAST(net AS DECIMAL(38,2))",
                "STATUS: 'POSTED'",
                f"GLENTRY_PROJECTID: {entry('_job')}",
                f"GLENTRY_TASKID: {entry('_task')}",
                f"GLENTRY_COSTTYPEID: {entry('_type')}",
                f"GLENTRY_VENDORID: {entry('_vendor')}",
                f"D: {entry('_vendor')}",
                "D: 'PROJECT_ID | ' || _job",
                "D: " + entry("'LGY_JOB | ' || Job"),
                "D: " + entry("'LGY_EXTRA | ' || Extra"),
                "D: " + entry("'LGY_DB_ACCT | ' || Debit_Account"),
                "D: _title",
                "D: " + entry("'LGY_COST_CODE | ' || Cost_Code"),
                "D: " + entry("'LGY_COST_TYPE | ' || Category"),
            ]
        ),
        "FROM cost_lines JOIN cost_packed ON title = _title WHERE net <> 0",
    )


EXPECTED["import_jtd_cost"] = _job_cost(False)
EXPECTED["api_jtd_cost"] = _job_cost(True)

# --- reports ---------------------------------------------------------------------------------

EXPECTED["report_gl_batch_outage"] = sql(
    """SELECT Data_Folder_Id, Batch, last_day(Accounting_Date) AS Period, Application_of_Origin,
        CAST(sum(Debit) AS DECIMAL(38,2)) AS DEBIT_AMT, CAST(-sum(Credit) AS DECIMAL(38,2)) AS CREDIT_AMT,
        CAST(sum(Debit + Credit) AS DECIMAL(38,2)) AS NET_AMT
    FROM fx_glt WHERE Accrual_or_Cash = 'Accrual' AND Accounting_Date <= DATE '2023-12-31'
    GROUP BY 1, 2, 3, 4 HAVING sum(Debit + Credit) <> 0"""
)
_MISSING_TOTALS = ", ".join(
    f"CAST(NULL AS DECIMAL(18,2)) AS {n}"
    for n in (
        "JTD_Aprvd_Contract_Chgs Revised_Contract_Amount JTD_Cost Extras_JTD_Cost Original_Estimate "
        "JTD_Aprvd_Estimate_Chgs Total_Estimate Extras_Total_Estimate JTD_Work_Billed Extras_JTD_Work_Billed "
        "Original_Commitment Revised_Commitment Commitment_Invoiced Extras_JTD_Aprvd_Cntrc_Chgs "
        "Extras_Orig_Contract_Amount Extra_Revised_Contract_Amt JTD_Retainage_Held"
    ).split()
)
EXPECTED["report_job_summary"] = sql(
    f"""SELECT j.Data_Folder_Id AS DATA_FOLDER_ID, j.Job AS LEGACY_JOB_ID, m.new_job_id AS JOB_ID, j.Description,
        j.Cost_Account_Prefix, j.Original_Contract_Amount, {_MISSING_TOTALS}
    FROM fx_job j JOIN jobs_in m ON m.legacy_job_id = j.Job AND m.data_folder_id = j.Data_Folder_Id"""
)

# --- sheets ----------------------------------------------------------------------------------

EXPECTED["export_entity"] = sql(
    """SELECT e.data_folder_id, d.legacy_data_folder_name, e.new_entity_id, 'False' AS pkg_base,
        'False' AS pkg_constr_sum, 'False' AS pkg_constr_det, '' AS pkg_payroll, 'False' AS pkg_npc_commit,
        'False' AS pkg_pc_commit
    FROM map_entity e LEFT JOIN map_data_folder d ON d.legacy_data_folder_id = e.data_folder_id"""
)
EXPECTED["export_job"] = sql(
    """SELECT data_folder_id, legacy_job_id, legacy_extra_id, legacy_job_name,
        if(include_job = 1, 'Yes', 'No') AS include_job, new_job_id, new_entity_id, new_department_id, new_class_id,
        new_customer_id, new_pm_id FROM map_job"""
)
EXPECTED["export_gl_account"] = sql("SELECT * FROM map_base_account")
for _name in ("location", "department"):
    EXPECTED[f"export_{_name}"] = sql(
        f"SELECT data_folder_id, legacy_{_name}_id, '' AS description, new_{_name}_id FROM map_{_name}"
    )
for _name in ("vendor", "customer"):
    EXPECTED[f"export_{_name}"] = sql(
        f"""SELECT data_folder_id, legacy_{_name}_id, legacy_{_name}_name, legacy_{_name}_status, new_{_name}_id
        FROM map_{_name}"""
    )
EXPECTED["export_cost_code"] = sql("SELECT * EXCLUDE (new_cost_code_name) FROM map_cost_code")
EXPECTED["export_cost_type"] = sql("SELECT * FROM map_cost_type")
EXPECTED["export_employee"] = sql(
    "SELECT data_folder_id, legacy_employee_id, legacy_employee_name, new_employee_id FROM map_employee"
)

CTES["customer_numbers"] = "SELECT *, CAST(substr(legacy_customer_id, 2, 6) AS INT) AS no FROM map_customer"
CTES["customer_edits"] = """
    SELECT 1 AS part, no, if(no % 11 = 0, '', data_folder_id) AS data_folder_id, legacy_customer_id,
        if(no % 5 = 0, '', 'N' || new_customer_id) AS new_customer_id, no % 7 = 0 OR no % 11 = 0 AS skipped
    FROM customer_numbers
    UNION ALL
    SELECT 2, no, data_folder_id, legacy_customer_id, 'Z' || new_customer_id, FALSE
    FROM customer_numbers WHERE no % 3 = 0
"""
CTES["customer_last"] = """
    SELECT * FROM customer_edits WHERE NOT skipped
    QUALIFY row_number() OVER (PARTITION BY data_folder_id, legacy_customer_id ORDER BY part DESC, no DESC) = 1
"""
EXPECTED["sheet_clean"] = sql(
    "SELECT data_folder_id, legacy_customer_id, new_customer_id FROM customer_edits WHERE NOT skipped"
)
EXPECTED["apply_simple_map"] = sql(
    """SELECT m.* REPLACE (if(e.no IS NULL, m.new_customer_id, e.new_customer_id) AS new_customer_id)
    FROM map_customer m LEFT JOIN customer_last e ON e.data_folder_id = m.data_folder_id
        AND e.legacy_customer_id = m.legacy_customer_id"""
)
EXPECTED["apply_audit"] = sql(
    """SELECT (SELECT count(*) FROM customer_edits WHERE NOT skipped) AS rows_read,
        (SELECT count(*) FROM customer_edits WHERE skipped) AS rows_skipped,
        (SELECT count(*) FROM map_customer m JOIN customer_last e ON e.data_folder_id = m.data_folder_id
            AND e.legacy_customer_id = m.legacy_customer_id) AS rows_updated, CAST(0 AS BIGINT) AS rows_errors"""
)
CTES["vendor_edits"] = """
    SELECT data_folder_id, legacy_vendor_id, 'W' || legacy_vendor_id AS new_vendor_id, no % 7 = 0 AS skipped,
        no % 7 <> 0 AND no % 13 = 0 AS wrong
    FROM (SELECT *, CAST(substr(legacy_vendor_id, 2, 5) AS INT) AS no FROM map_vendor)
"""
EXPECTED["apply_audit_errors"] = sql(
    """SELECT (SELECT count(*) FROM vendor_edits WHERE NOT skipped AND NOT wrong) AS rows_read,
        (SELECT count(*) FROM vendor_edits WHERE skipped) AS rows_skipped,
        (SELECT count(*) FROM map_vendor m WHERE EXISTS (SELECT 1 FROM vendor_edits e WHERE NOT skipped AND NOT wrong
            AND e.data_folder_id = m.data_folder_id AND e.legacy_vendor_id = m.legacy_vendor_id)) AS rows_updated,
        (SELECT count(*) FROM vendor_edits WHERE wrong) AS rows_errors"""
)
EXPECTED["sheet_errors"] = sql(
    "SELECT data_folder_id, legacy_vendor_id, 'too long: new_vendor_id' AS reason FROM vendor_edits WHERE wrong"
)
EXPECTED["apply_beside_errors"] = sql(
    """SELECT m.* REPLACE (coalesce(e.new_vendor_id, m.new_vendor_id) AS new_vendor_id)
    FROM map_vendor m LEFT JOIN (SELECT DISTINCT * FROM vendor_edits WHERE NOT skipped AND NOT wrong) e
        ON e.data_folder_id = m.data_folder_id AND e.legacy_vendor_id = m.legacy_vendor_id"""
)
EXPECTED["controls_checked"] = sql(
    """SELECT 'GL_STOP_' || Data_Folder_Id AS field_name,
        if(Data_Folder_Id IN ('F1', 'F3'), '', CAST(max(Accounting_Date) AS VARCHAR)) AS field_value,
        if(Data_Folder_Id IN ('F1', 'F3'), 'not readable: field_value', '') AS reason
    FROM fx_glt GROUP BY Data_Folder_Id"""
)
EXPECTED["apply_entity"] = sql(
    """SELECT m.* REPLACE (w.new_entity_id AS new_entity_id, 1 AS pkg_base, 0 AS pkg_npc_commit)
    FROM map_entity m JOIN (SELECT data_folder_id, max(new_entity_id) AS new_entity_id FROM map_entity GROUP BY 1) w
        ON w.data_folder_id = m.data_folder_id"""
)
CTES["job_edits"] = """
    SELECT data_folder_id, legacy_job_id, legacy_extra_id,
        CASE no % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE include_job END AS include_job
    FROM (SELECT *, CAST(substr(legacy_job_id, 4, 6) AS INT) AS no FROM map_job) WHERE no % 2 <> 0
"""
EXPECTED["apply_job"] = sql(
    """SELECT m.* REPLACE (coalesce(e.include_job, 0) AS include_job,
        if(e.legacy_job_id IS NULL, m.new_job_id, 'P-' || m.legacy_job_id) AS new_job_id,
        if(e.legacy_job_id IS NULL, m.new_entity_id, coalesce(m.new_entity_id, '')) AS new_entity_id,
        if(e.legacy_job_id IS NULL, m.new_department_id, coalesce(m.new_department_id, '')) AS new_department_id,
        if(e.legacy_job_id IS NULL, m.new_class_id, coalesce(m.new_class_id, '')) AS new_class_id,
        if(e.legacy_job_id IS NULL, m.new_customer_id, coalesce(m.new_customer_id, '')) AS new_customer_id,
        if(e.legacy_job_id IS NULL, m.new_pm_id, 'PM') AS new_pm_id)
    FROM map_job m LEFT JOIN job_edits e ON e.data_folder_id = m.data_folder_id
        AND e.legacy_job_id = m.legacy_job_id AND e.legacy_extra_id = m.legacy_extra_id"""
)
EXPECTED["apply_gl_account"] = sql(
    """SELECT m.* REPLACE ('9' || m.legacy_base_account AS new_base_account,
        if(w.fin_stmt = 'BS', 'Create', 'Merge') AS cmo, w.note AS category)
    FROM map_base_account m JOIN (SELECT data_folder_id, legacy_base_account, max(note) AS note,
            max(fin_stmt) AS fin_stmt FROM map_base_account GROUP BY 1, 2) w
        ON w.data_folder_id = m.data_folder_id AND w.legacy_base_account = m.legacy_base_account"""
)
_FIELDS = [
    ("COMPANY_ID", "(SELECT CAST(date_diff('day', DATE '1899-12-30', max(Accounting_Date)) AS VARCHAR) FROM fx_glt)"),
    ("DEFAULT_GL_OUTAGE_ACCOUNT", "'XXXX'"),
    ("GL01_BALANCE_END", "'1998-12-31'"),
    ("GL02_MONTHLY_START", "'1999-01-01'"),
    ("GL02_MONTHLY_STOP", "'1999-12-31'"),
    ("GL03_DETAIL_START", "(SELECT CAST(min(Accounting_Date) AS VARCHAR) FROM fx_glt)"),
    ("GL03_DETAIL_STOP", "(SELECT CAST(max(Accounting_Date) AS VARCHAR) FROM fx_glt)"),
]
EXPECTED["apply_controls"] = sql(
    " UNION ALL ".join(f"SELECT '{n}' AS field_name, {v} AS field_value" for n, v in _FIELDS)
)
EXPECTED["import_text_form"] = sql(
    "SELECT coalesce(CAST(COLUMNS(*) AS VARCHAR), '') FROM open_cash"
)

# --- lookups and operators -------------------------------------------------------------------

EXPECTED["lookup_acct_type"] = sql(
    """SELECT b.Data_Folder_Id, b.Base_Account, b.Base_Account_Type, t.acct_type, t.normal_balance, t.closeable
    FROM fx_base_account b LEFT JOIN acct_types t ON t.base_account_type = b.Base_Account_Type"""
)
EXPECTED["lookup_state"] = sql(
    """SELECT c.Data_Folder_Id, c.Customer, c.State, s.state_name
    FROM fx_customer c LEFT JOIN states s ON s.state_id = c.State"""
)
EXPECTED["lookup_1099"] = sql(
    """SELECT v.Data_Folder_Id, v.Vendor, v.Form_Type_1099, t.form_type_1099_code AS form_code
    FROM fx_vendor v LEFT JOIN tax_forms t ON t.form_type_1099_desc = v.Form_Type_1099"""
)
_DATES = {
    "GL01_BALANCE_END": BALANCE_END,
    "GL02_MONTHLY_START": MONTH_START,
    "GL02_MONTHLY_STOP": MONTH_STOP,
    "GL03_DETAIL_START": DETAIL_START,
    "GL03_DETAIL_STOP": DETAIL_STOP,
}
EXPECTED["param_dates"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{n}' AS field_name, {d} AS field_date, count(*) AS rows_until,
        CAST(sum(Debit + Credit) AS DECIMAL(38,2)) AS net_until
        FROM fx_glt WHERE Accrual_or_Cash = 'Accrual' AND Accounting_Date <= {d}"""
        for n, d in _DATES.items()
    )
)
EXPECTED["translate_lookup"] = sql(
    """SELECT t.Data_Folder_Id, t.Job, t.Cost_Code, t.Category, t.Amount,
        coalesce(m.new_cost_type_id, t.Category) AS new_cost_type_id
    FROM fx_jct t LEFT JOIN map_cost_type m ON m.legacy_cost_type_id = t.Category
        AND m.data_folder_id = t.Data_Folder_Id"""
)
EXPECTED["two_tier_account"] = sql(
    "SELECT data_folder_id AS Data_Folder_Id, account AS Account, acct_no FROM targets"
)
EXPECTED["header_detail"] = sql(
    f"""SELECT * REPLACE (if(line_no = 1, document, '') AS document) FROM (
        SELECT Data_Folder_Id, Vendor, Invoice, Invoice AS document, Dist_Seq, Description, Amount, Cost_Code, Category,
            row_number() OVER (PARTITION BY Data_Folder_Id, Vendor, Invoice
                ORDER BY {by('Dist_Seq', 'Cost_Code', 'Category', 'Description', 'Amount')}) AS line_no
        FROM fx_ap_distribution)"""
)
EXPECTED["net_sides"] = sql(
    """SELECT Data_Folder_Id, Account, Batch, CAST(greatest(sum(Debit) + sum(Credit), 0) AS DECIMAL(38,2)) AS debit,
        CAST(greatest(-(sum(Debit) + sum(Credit)), 0) AS DECIMAL(38,2)) AS credit
    FROM fx_glt GROUP BY 1, 2, 3 HAVING round(sum(Debit) + sum(Credit), 2) <> 0"""
)
EXPECTED["double_entry"] = sql(
    """SELECT Data_Folder_Id, Job, Batch, Cost_Code, Category,
        CAST(sum(greatest(Amount, 0)) AS DECIMAL(38,2)) AS debit,
        CAST(sum(greatest(-Amount, 0)) AS DECIMAL(38,2)) AS credit, '0' AS entry_offset
    FROM fx_jct GROUP BY 1, 2, 3, 4, 5
    UNION ALL
    SELECT Data_Folder_Id, Job, Batch, NULL, NULL, CAST(sum(greatest(-Amount, 0)) AS DECIMAL(38,2)),
        CAST(sum(greatest(Amount, 0)) AS DECIMAL(38,2)), '1'
    FROM fx_jct GROUP BY 1, 2, 3"""
)
EXPECTED["pack_batches"] = sql(
    """SELECT t.Job, t.Cost_Code, t.Category, t.Amount, b.batch_num FROM fx_jct t JOIN (
        SELECT Job, CAST(floor(coalesce(sum(n) OVER (ORDER BY Job ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) / 1000) + 1 AS BIGINT) AS batch_num
        FROM (SELECT Job, count(*) AS n FROM fx_jct GROUP BY Job)) b ON b.Job = t.Job"""
)
EXPECTED["latest_per_batch"] = sql("SELECT * FROM newest")
EXPECTED["anti_join_accounts"] = sql(
    """SELECT a.Data_Folder_Id, a.Account FROM fx_gl_account a
    LEFT JOIN (SELECT DISTINCT Data_Folder_Id, General_Cash_Account FROM fx_bank) b
        ON b.Data_Folder_Id = a.Data_Folder_Id AND b.General_Cash_Account = a.Account
    WHERE b.General_Cash_Account IS NULL"""
)
EXPECTED["semi_join_cost_code"] = sql(
    """SELECT Data_Folder_Id, Job, Extra, Cost_Code, Amount
    FROM fx_jct SEMI JOIN fx_job_cost_code USING (Data_Folder_Id, Job, Extra, Cost_Code)"""
)
_SLOTS = " UNION ALL ".join(
    f"SELECT Data_Folder_Id, Cost_Code, 'Category_{i}' AS slot, "
    + (f"Category_{i}" if i <= 3 else "CAST(NULL AS VARCHAR)")
    + " AS category FROM fx_std_cost_code"
    for i in range(1, 13)
)
EXPECTED["unpivot_categories"] = sql(_SLOTS)
EXPECTED["parent_code"] = sql(
    """SELECT Data_Folder_Id, Job, Extra, Cost_Code,
        CASE WHEN CAST(split_part(Cost_Code, '-', 2) AS INT) = 0 THEN ''
            ELSE split_part(Cost_Code, '-', 1) || '-000' END AS parent
    FROM fx_job_cost_code"""
)
CTES["batch_sums"] = """
    SELECT Data_Folder_Id, Batch, CAST(sum(Debit) AS DECIMAL(38,2)) AS debit,
        CAST(sum(Credit) AS DECIMAL(38,2)) AS credit FROM fx_glt GROUP BY 1, 2
"""
EXPECTED["with_total"] = sql(
    """SELECT *, 0 AS is_total FROM batch_sums UNION ALL
    SELECT '', 'TOTAL', CAST(sum(debit) AS DECIMAL(38,2)), CAST(sum(credit) AS DECIMAL(38,2)), 1 FROM batch_sums"""
)
EXPECTED["split_measures"] = sql(
    """SELECT Data_Folder_Id, Job, Extra, Cost_Code, Category, 'A' AS branch, 'original' AS kind,
        Original_Estimate_Units AS qty, Original_Estimate AS amount FROM fx_job_category WHERE Original_Estimate <> 0
    UNION ALL
    SELECT Data_Folder_Id, Job, Extra, Cost_Code, Category, 'B', 'approved change', Approved_Est_Unit_Changes,
        Approved_Estimate_Changes FROM fx_job_category WHERE Approved_Estimate_Changes <> 0"""
)
EXPECTED["month_end_rollup"] = sql(
    """SELECT Data_Folder_Id, last_day(Accounting_Date) AS period, strftime(Accounting_Date, '%Y-%m') AS month,
        CAST(sum(Debit) AS DECIMAL(38,2)) AS debit, count(*) AS entries
    FROM fx_glt GROUP BY 1, 2, 3"""
)
EXPECTED["compose_memo"] = sql(
    """SELECT Data_Folder_Id, concat(replace(Transaction_Desc, ',', ''), ' | Actg Date: ',
        strftime(Accounting_Date, '%m-%d-%Y'), ' | Vendor ID: ' || nullif(Vendor, ''),
        ' | AP Inv ID: ' || nullif(AP_Invoice, ''), ' | Job ID: ' || nullif(Job, ''),
        ' | Customer ID: ' || nullif(Customer, ''), ' | Cust Inv ID: ' || nullif(AR_Invoice, '')) AS memo
    FROM fx_glt
    UNION ALL
    SELECT Data_Folder_Id, concat(replace(Description, ',', ''), ' Vendor ID: ' || nullif(Vendor, ''),
        ' AP Inv ID: ' || nullif(Invoice, ''), ' Job ID: ' || nullif(Job, ''),
        ' Customer ID: ' || nullif(Customer, ''), ' Cust Inv ID: ' || nullif(AR_Invoice, ''))
    FROM fx_jct"""
)
EXPECTED["fanout_audit"] = sql(
    """SELECT data_folder_id, legacy_base_account, count(*) AS matches FROM map_base_account
    GROUP BY 1, 2 HAVING count(*) > 1"""
)
EXPECTED["missing_translation"] = sql(
    """SELECT t.Data_Folder_Id, t.Job, t.Category, t.Amount, CAST(NULL AS VARCHAR) AS new_cost_type_id FROM fx_jct t
    WHERE NOT EXISTS (SELECT 1 FROM map_cost_type m WHERE m.legacy_cost_type_id = t.Category
        AND m.data_folder_id = t.Data_Folder_Id)"""
)
EXPECTED["rebase_contract"] = sql(
    """SELECT c.Data_Folder_Id, c.Contract, 'N' || j.new_job_id AS job_id,
        if(j.new_job_id IS NULL, c.Contract, 'N' || j.new_job_id) AS contract_id
    FROM fx_contract c LEFT JOIN jobs_in j ON j.legacy_job_id = c.Contract AND j.data_folder_id = c.Data_Folder_Id"""
)

# --- uneven keys, shared work, forecasts -------------------------------------------------------

EXPECTED["translate_spread"] = EXPECTED["translate_lookup"]
EXPECTED["translate_spread_blank"] = sql(
    """SELECT t.Data_Folder_Id, t.Account, t.Batch, nullif(t.Vendor, '') AS Vendor, t.Debit, m.new_vendor_id
    FROM fx_glt t LEFT JOIN map_vendor m ON m.legacy_vendor_id = nullif(t.Vendor, '')
        AND m.data_folder_id = t.Data_Folder_Id"""
)
EXPECTED["open_ap_spread"] = EXPECTED["import_open_ap"]
EXPECTED["heavy_vendor_keys"] = sql(
    """SELECT Data_Folder_Id, Vendor, count(*) AS rows FROM fx_glt GROUP BY 1, 2
    HAVING count(*) >= CAST(0.01 AS DOUBLE) * (SELECT count(*) FROM fx_glt)"""
)
_BORDERS = [1980, 1999, 2000, 2024]
_STRETCH = " + ".join(
    f"CAST(Accounting_Date >= DATE '{d}' AS INT)" for d in [*(f"{y}-01-01" for y in _BORDERS), "1999-12-01"]
)
EXPECTED["ledger_summary"] = sql(
    f"""SELECT Data_Folder_Id, Account, Batch, Application_of_Origin, Accrual_or_Cash,
        max(Accounting_Date) AS Accounting_Date, CAST(sum(Debit) AS DECIMAL(28,2)) AS Debit,
        CAST(sum(Credit) AS DECIMAL(28,2)) AS Credit, count(*) AS entries
    FROM fx_glt GROUP BY 1, 2, 3, 4, 5, last_day(Accounting_Date), {_STRETCH}"""
)
for _name in ("import_gl_opening", "import_gl_monthly", "import_gl_detail", "report_gl_batch_outage"):
    EXPECTED[f"shared_{_name}"] = EXPECTED[_name]
for _name in ("seed_batch_combine", "latest_per_batch"):
    EXPECTED[f"shared_{_name}"] = EXPECTED[_name]
CTES["ap_open"] = """
    SELECT d.*, d.Amount - d.Amount_Paid AS _price
    FROM fx_ap_distribution d
    LEFT JOIN fx_ap_invoice i ON i.Data_Folder_Id = d.Data_Folder_Id AND i.Vendor = d.Vendor AND i.Invoice = d.Invoice
    WHERE (i.Status = 'Open' AND d.Amount - d.Amount_Paid <> 0) OR d.Retainage - d.Retainage_Paid <> 0
"""
EXPECTED["open_ap_forecast"] = sql(
    "SELECT (SELECT count(*) FROM ap_open) AS rows_in, (SELECT count(*) FROM ap_rows) AS rows_out"
)
EXPECTED["open_ar_forecast"] = sql(
    f"""SELECT (SELECT count(*) FROM ar_sums a JOIN fx_ara_status s USING ({_STATUS}) LEFT JOIN ar_held h USING ({_STATUS})
        WHERE a.net_amount <> 0 OR coalesce(h.ret_net, 0) <> 0) AS rows_in,
        (SELECT count(*) FROM ar_rows) AS rows_out"""
)
EXPECTED["gl_detail_forecast"] = sql(
    f"""SELECT (SELECT count(*) FROM fx_glt WHERE Accrual_or_Cash = 'Accrual'
        AND Accounting_Date BETWEEN {DETAIL_START} AND {DETAIL_STOP}) AS rows_in,
        (SELECT count(*) FROM gl_detail) AS rows_out"""
)
_MISSING = {
    "vendor": ("d.Vendor || ' | ' || d.Data_Folder_Id", "map_vendor m", "m.legacy_vendor_id = d.Vendor AND "),
    "cost code": ("d.Cost_Code || ' | ' || d.Data_Folder_Id", "map_cost_code m", "m.legacy_cost_code_id = d.Cost_Code AND "),
    "cost type": ("d.Category || ' | ' || d.Data_Folder_Id", "map_cost_type m", "m.legacy_cost_type_id = d.Category AND "),
    "job": ("d.Job || ' | ' || d.Data_Folder_Id", "jobs_plain m", "m.legacy_job_id = d.Job AND "),
    "entity": ("d.Data_Folder_Id", "map_entity m", ""),
}
EXPECTED["open_ap_missing"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{label}' AS lookup, {key} AS legacy_key, count(*) AS rows, CAST(sum(_price) AS DECIMAL(38,2)) AS amount
        FROM ap_open d WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {same}m.data_folder_id = d.Data_Folder_Id)
        GROUP BY 2"""
        for label, (key, table, same) in _MISSING.items()
    )
)
EXPECTED["split_reads"] = sql(
    """SELECT Data_Folder_Id, count(*) AS entries, CAST(sum(Debit) AS DECIMAL(38,2)) AS debit
    FROM fx_glt GROUP BY Data_Folder_Id"""
)
