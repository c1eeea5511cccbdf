"""Column contracts of the landed source tables and of the translation tables.

Only the columns that a dataset reads are listed. ``conform`` adds the ones a landed table lacks,
so an extract that leaves out a copied-through column still works; one that leaves out a key, a
filter or an amount is refused, since its datasets would come out empty or wrong without a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SourceTable:
    physical: str
    text: str = ""
    dates: str = ""
    amounts: str = ""
    ints: str = ""

    def columns(self) -> dict[str, str]:
        typed = {"Data_Folder_Id": "string"}
        for names, kind in (
            (self.text, "string"),
            (self.dates, "date"),
            (self.amounts, "decimal(18,2)"),
            (self.ints, "int"),
        ):
            typed.update({name: kind for name in names.split()})
        return typed

    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in self.columns().items()))


# Physical names and columns of the legacy system's tables.
SOURCES: dict[str, SourceTable] = {
    "ap_distribution": SourceTable(
        "APM_MASTER__DISTRIBUTION",
        "Vendor Invoice Job Extra Cost_Code Category Commitment Description Expense_Account",
        amounts="Amount Amount_Paid Retainage Retainage_Paid",
        ints="Dist_Seq",
    ),
    "ap_invoice": SourceTable(
        "APM_MASTER__INVOICE", "Vendor Invoice Status", "Invoice_Date Accounting_Date Payment_Date"
    ),
    "vendor": SourceTable(
        "APM_MASTER__VENDOR",
        "Vendor Name Type Contact_1_Name Default_Payment_Type Bank_ID Account_Type Form_Type_1099 State "
        "Recipient_ID Customer_Number Expense_Account Recipient_Tax_ID_Name Telephone Fax_Number "
        "Contact_1_Email_Address Contact_2_Email_Address Address_1 Address_2 City ZIP Country_Code Bank_Account",
        amounts="Discount_Percent Amt_Paid_This_Yr_1099",
        ints="Inactive Receives_Form_1099 Discount_Days Payment_Days",
    ),
    "ar_activity": SourceTable(
        "ARA_ACTIVITY__ACTIVITY",
        "Customer Status_Type Activity_Type",
        "Status_Date Due_Date",
        "Retainage_Held Retainage_Billed",
        "Status_Seq Actvty_Seq",
    ),
    "ar_status": SourceTable(
        "ARA_ACTIVITY__STATUS", "Customer Status_Type Invoice Status", "Status_Date", ints="Status_Seq"
    ),
    "customer": SourceTable(
        "ARM_MASTER__CUSTOMER",
        "Customer Name Status Customer_Type Tax_Group Telephone Fax Email_Address Address_1 Address_2 City State "
        "Zip_Code Billing_Contact Billing_Email_Address Billing_Address_1 Billing_Address_2 Billing_City "
        "Billing_State Billing_ZIP_Code",
        amounts="Credit_Limit",
        ints="Days_Before_Due",
    ),
    "ar_transaction": SourceTable(
        "ART_CURRENT__TRANSACTION",
        "Customer Status_Type Amount_Type Transaction_Type Job Extra Invoice Draw Edit_Type Adjustment "
        "Cash_Receipt Description Adjustment_Type Credit_Account__Accrual Contract Contract_Item",
        "Status_Date Due_Date Accounting_Date Related_Status_Date Deposit_Date Reference_Date",
        "Amount Retainage",
        "Status_Seq Actvty_Seq",
    ),
    "bank_account": SourceTable(
        "CMM_MASTER__BANK_ACCOUNT",
        "Bank_Account General_Cash_Account Account_Type Description Bank_Name Account_Number Branch Address_1 "
        "Address_2 City State ZIP Phone_Number",
        "Last_Reconciled_Date",
    ),
    "bank_register": SourceTable(
        "CMT_REGISTER__TRANSACTION",
        "Bank_Account Check_No Payee Description Reconcile_in_Progress Reconciliation_Status",
        "Accounting_Date",
        "Subtraction Addition",
    ),
    "contract_derived": SourceTable(
        "CNA_ACTIVE__CONTRACT_DERIVED",
        "Contract",
        amounts="Revised_Contract Total_Billed Cash_Receipt Receivable_Adjustment Retainage_Held Retainage_Billed",
    ),
    "contract_item_derived": SourceTable(
        "CNA_ACTIVE__CONTRACT_ITEM_DERIVED",
        "Contract Contract_Item",
        amounts="Revised_Contract Approved_Contract_Changes Total_Billed Receivable_Adjustment Retainage_Held "
        "Retainage_Billed Cash_Receipt",
    ),
    "contract": SourceTable("CNC_ACTIVE__CONTRACT", "Contract Description", "Contract_Date Date_Stamp"),
    "contract_item": SourceTable(
        "CNC_ACTIVE__CONTRACT_ITEM",
        "Contract Contract_Item Customer Job Billing_Type Description Default_Revenue_Account Markup_Table "
        "Rate_Table_Labor Rate_Table_Subcontract Rate_Table_Material Rate_Table_Equipment Rate_Table_Other Format",
        "Approval_Date Date_Stamp",
        "Retainage_Percent Original_Contract_Total",
        "Row_ID",
    ),
    "gl_account": SourceTable("GLM_MASTER__ACCOUNT", "Account Account_Title Account_Type"),
    "account_format": SourceTable(
        "GLM_MASTER__ACCOUNT_FORMAT",
        ints="Suffix_Length Base_Account_Length Account_Prefix_A_Length Account_Prefix_AB_Length "
        "Account_Prefix_ABC_Length",
    ),
    "prefix_a": SourceTable("GLM_MASTER__ACCOUNT_PREFIX_A", "Account_Prefix Description"),
    "base_account": SourceTable("GLM_MASTER__BASE_ACCOUNT", "Base_Account Base_Account_Title Base_Account_Type"),
    "gl_transaction": SourceTable(
        "GLT_CURRENT__TRANSACTION",
        "Account Batch Application_of_Origin Accrual_or_Cash Transaction_Desc Reference_1 Reference_2 Vendor "
        "AP_Invoice Job Customer AR_Invoice",
        "Accounting_Date",
        "Debit Credit",
    ),
    "job_category": SourceTable(
        "JCM_MASTER__CATEGORY",
        "Job Extra Cost_Code Category Cost_Unit_Description Cost_Account",
        amounts="Original_Estimate_Units Original_Estimate Approved_Est_Unit_Changes Approved_Estimate_Changes",
    ),
    "job_cost_code": SourceTable(
        "JCM_MASTER__COST_CODE",
        "Job Extra Cost_Code Description",
        amounts="Orig_Production_Units_Est Apprvd_Prodctn_Unit_Chgs",
    ),
    "extra": SourceTable("JCM_MASTER__EXTRA", "Job Extra Description"),
    "job": SourceTable(
        "JCM_MASTER__JOB",
        "Job Description Status Cost_Account_Prefix Address_1 Address_2 City State ZIP_Code AR_Customer "
        "Billing_Method",
        "Actual_Start_Date Estimated_Comp_Date Last_Cost_Update",
        "Original_Contract_Amount JTD_Aprvd_Contract_Chgs Revised_Contract_Amount JTD_Cost Extras_JTD_Cost "
        "Original_Estimate JTD_Aprvd_Estimate_Chgs Total_Estimate Extras_Total_Estimate JTD_Work_Billed "
        "Extras_JTD_Work_Billed Original_Commitment Revised_Commitment Commitment_Invoiced "
        "Extras_JTD_Aprvd_Cntrc_Chgs Extras_Orig_Contract_Amount Extras_Revised_Contract_Amt JTD_Retainage_Held",
    ),
    "std_category": SourceTable(
        "JCM_MASTER__STANDARD_CATEGORY", "Category Description Accumulate_As Cost_Unit_Description Cost_Account_A"
    ),
    "std_cost_code": SourceTable(
        "JCM_MASTER__STANDARD_COST_CODE",
        "Cost_Code Description " + " ".join(f"Category_{i}" for i in range(1, 13)),
    ),
    "jc_transaction": SourceTable(
        "JCT_CURRENT__TRANSACTION",
        "Job Extra Cost_Code Category Vendor Customer Application_of_Origin Batch Invoice AR_Invoice Description "
        "Debit_Account Credit_Account Commitment Transaction_Type",
        "Accounting_Date",
        "Amount",
    ),
    "employee": SourceTable(
        "PRM_MASTER__EMPLOYEE",
        "Employee Employee_Name Title Social_Security_Number Gender Phone_Number Email_Address Mobile_Phone "
        "Address_1 Address_2 City State ZIP_Code Department Certified_Class Union_ID Union_Local Union_Class",
        "Termination_Date Birth_Date Rehire_Date Hire_Date",
    ),
    "data_folder": SourceTable("LOAD_LOG", "Section_Id"),
}

# Columns of the translation tables.
MAPPINGS: dict[str, str] = {
    "data_folder": "legacy_data_folder_id string, legacy_data_folder_name string, new_id string, new_name string, "
    "destination string, include_data_folder int",
    "job": "legacy_job_id string, legacy_job_name string, legacy_job_status string, new_job_id string, "
    "new_job_name string, legacy_data_folder_id string, include_job int, data_folder_id string, "
    "legacy_extra_id string, new_entity_id string, new_department_id string, new_class_id string, "
    "new_customer_id string, new_pm_id string",
    "customer": "data_folder_id string, legacy_customer_id string, legacy_customer_name string, "
    "legacy_customer_status string, legacy_customer_type string, new_customer_id string, "
    "new_customer_type string, include_customer int, on_open_ar string, on_open_oe string, on_open_other string",
    "vendor": "data_folder_id string, legacy_vendor_id string, legacy_vendor_name string, "
    "legacy_vendor_status string, legacy_vendor_type string, new_vendor_id string, new_vendor_type string, "
    "include_vendor int, on_open_ap int, on_open_commitment int, on_open_other int",
    "cost_code": "legacy_cost_code_id string, legacy_cost_code_name string, new_cost_code_id string, "
    "new_cost_code_name string, new_item_id string, data_folder_id string",
    "cost_type": "legacy_cost_type_id string, legacy_cost_type_name string, new_cost_type_id string, "
    "new_item_id string, new_gl_account string, data_folder_id string",
    "base_account": "data_folder_id string, legacy_base_account string, note string, fin_stmt string, "
    "balance string, closeable string, acct_type string, acct_match_type string, required string, "
    "new_base_account string, cmo string, category string",
    "entity": "data_folder_id string, legacy_entity_id string, legacy_entity_name string, new_entity_id string, "
    "include_entity int, pkg_base int, pkg_constr_sum int, pkg_constr_det int, pkg_npc_commit int, "
    "pkg_pc_commit int",
    "batch_combine": "source_batch string, period date, batch_per string, debit decimal(38,2), "
    "credit decimal(38,2), net decimal(38,2), net_abs decimal(38,2), to_batch_alias string, to_batch_id string",
    "employee": "legacy_employee_id string, legacy_employee_name string, legacy_employee_status string, "
    "new_employee_id string, include_employee int, data_folder_id string",
    "location": "data_folder_id string, legacy_location_id string, new_location_id string",
    "department": "data_folder_id string, legacy_department_id string, new_department_id string",
    "class": "data_folder_id string, legacy_class_id string, new_class_id string",
    "item": "data_folder_id string, legacy_item_id string, new_item_id string",
    "warehouse": "data_folder_id string, legacy_warehouse_id string, new_warehouse_id string",
    "useful_fields": "field_name string, field_value string",
}


def mapping_schema(name: str) -> StructType:
    return StructType.fromDDL(MAPPINGS[name])


#: Keys, filters and amounts, without which a table is refused; the folder is one of every table.
REQUIRED: dict[str, str] = {
    "ap_distribution": "Vendor Invoice Amount Amount_Paid Retainage",
    "ap_invoice": "Vendor Invoice Status",
    "vendor": "Vendor",
    "ar_activity": "Customer Status_Type Status_Date Status_Seq Activity_Type Retainage_Held Retainage_Billed",
    "ar_status": "Customer Status_Type Status_Date Status_Seq Status",
    "ar_transaction": "Customer Status_Type Status_Date Status_Seq Amount Retainage Amount_Type Transaction_Type "
    "Accounting_Date",
    "customer": "Customer",
    "bank_account": "Bank_Account",
    "bank_register": "Bank_Account Subtraction Addition",
    "contract": "Contract",
    "contract_item": "Contract Contract_Item Job",
    "gl_account": "Account",
    "base_account": "Base_Account",
    "gl_transaction": "Account Accounting_Date Batch Accrual_or_Cash Debit Credit",
    "job": "Job",
    "job_category": "Job Extra Cost_Code Category",
    "job_cost_code": "Job Extra Cost_Code",
    "std_category": "Category",
    "std_cost_code": "Cost_Code",
    "jc_transaction": "Job Extra Cost_Code Category Accounting_Date Transaction_Type Commitment Amount Debit_Account",
    "employee": "Employee",
}


def _add_missing(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    present = {c.lower() for c in df.columns}
    return df.withColumns({n: F.lit(None).cast(k) for n, k in wanted.items() if n.lower() not in present})


def conform(df: DataFrame, name: str) -> DataFrame:
    """Add the columns of source table ``name`` that ``df`` lacks, as NULL; amounts become DECIMAL.

    A table without one of its ``REQUIRED`` columns is refused.
    """
    present = {c.lower(): c for c in df.columns}
    lacking = [n for n in ("Data_Folder_Id", *REQUIRED.get(name, "").split()) if n.lower() not in present]
    if lacking:
        raise ValueError(f"{SOURCES[name].physical} lacks {', '.join(lacking)}")
    amounts = {n: k for n, k in SOURCES[name].columns().items() if k.startswith("decimal")}
    inexact = {
        present[n.lower()]: F.col(present[n.lower()]).cast(k)
        for n, k in amounts.items()
        if n.lower() in present and dict(df.dtypes)[present[n.lower()]] in ("double", "float")
    }
    return _add_missing(df.withColumns(inexact), SOURCES[name].columns())


def conform_mapping(df: DataFrame, name: str) -> DataFrame:
    """Add late columns of translation table ``name`` that an older version of it lacks."""
    return _add_missing(df, {f.name: f.dataType.simpleString() for f in mapping_schema(name)})
