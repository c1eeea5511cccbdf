"""Adapter views: each landed source table is projected from the driver's star-schema tables.

The text is accepted unchanged by Spark SQL and DuckDB, so both engines read the same rows.
Money is cast to DECIMAL before any sum, because sums of doubles depend on row order.
"""

ADAPTERS: dict[str, str] = {
    "fx_data_folder": """
        SELECT 'F'||CAST(r_regionkey AS STRING) AS Data_Folder_Id, r_name AS Section_Id
        FROM region
    """,
    "fx_geo": """
        SELECT n_nationkey, 'F'||CAST(n_regionkey AS STRING) AS Data_Folder_Id,
            lpad(CAST(n_nationkey AS STRING),2,'0') AS Prefix_A, n_name
        FROM nation
    """,
    "fx_prefix_a": """
        SELECT Data_Folder_Id, Prefix_A AS Account_Prefix, n_name AS Description
        FROM fx_geo
    """,
    "fx_account_format": """
        SELECT Data_Folder_Id, 3 AS Account_Prefix_A_Length, 6 AS Account_Prefix_AB_Length,
            CASE WHEN Data_Folder_Id IN ('F0','F1') THEN 9 ELSE 6 END AS Account_Prefix_ABC_Length,
            5 AS Base_Account_Length, 3 AS Suffix_Length
        FROM fx_data_folder
    """,
    "fx_line": """
        SELECT l.*, o.o_custkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS o_date, g.Data_Folder_Id,
            g.Prefix_A, CAST(l.l_shipdate AS DATE) AS d, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amt,
            'C'||lpad(CAST(o.o_custkey AS STRING),6,'0') AS Customer,
            'V'||lpad(CAST(l.l_suppkey AS STRING),5,'0') AS Vendor,
            g.Prefix_A||'-'||lpad(CAST(o.o_custkey AS STRING),6,'0') AS Job,
            CASE WHEN l.l_linenumber > 5 THEN 'X1' ELSE '' END AS Extra,
            lpad(CAST(l.l_partkey % 40 AS STRING),2,'0')||'-'||lpad(CAST(l.l_partkey % 4 AS STRING),3,'0') AS Cost_Code,
            CASE l.l_partkey % 5 WHEN 0 THEN 'L' WHEN 1 THEN 'M' WHEN 2 THEN 'S' WHEN 3 THEN 'E' ELSE 'O' END AS Category
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN fx_geo g ON c.c_nationkey = g.n_nationkey
    """,
    "fx_glt": """
        SELECT Data_Folder_Id,
            Prefix_A||'-'||lpad(CAST(l_suppkey % 10 AS STRING),2,'0')||'-'||CASE WHEN Data_Folder_Id IN ('F0','F1') THEN lpad(CAST(l_suppkey % 3 AS STRING),2,'0')||'-' ELSE '' END||CAST(10000 + l_partkey % 50 AS STRING)||CASE WHEN l_linenumber % 2 = 0 THEN '.'||lpad(CAST(l_linenumber AS STRING),3,'0') ELSE '' END AS Account,
            d AS Accounting_Date, 'B'||lpad(CAST(l_orderkey % 400 AS STRING),4,'0') AS Batch,
            CASE l_suppkey % 4 WHEN 0 THEN 'AP' WHEN 1 THEN 'AR' WHEN 2 THEN 'JC' ELSE 'GL' END AS Application_of_Origin,
            CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,2)) ELSE amt END AS Debit,
            CASE WHEN l_returnflag = 'R' THEN CAST(-amt AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS Credit,
            CASE WHEN l_linestatus = 'O' THEN 'Accrual' ELSE 'Cash' END AS Accrual_or_Cash,
            CASE WHEN l_linenumber = 1 THEN 'Summary Entry' ELSE 'Line, '||CAST(l_linenumber AS STRING) END AS Transaction_Desc,
            'R'||CAST(l_orderkey AS STRING) AS Reference_1, 'S'||CAST(l_suppkey AS STRING) AS Reference_2,
            CASE WHEN l_suppkey % 4 = 0 THEN Vendor ELSE '' END AS Vendor,
            CASE WHEN l_suppkey % 4 = 0 THEN 'I'||CAST(l_orderkey AS STRING) ELSE '' END AS AP_Invoice,
            CASE WHEN l_suppkey % 4 = 2 THEN Job ELSE '' END AS Job,
            CASE WHEN l_suppkey % 4 = 1 THEN Customer ELSE '' END AS Customer,
            CASE WHEN l_suppkey % 4 = 1 THEN 'I'||CAST(l_orderkey AS STRING) ELSE '' END AS AR_Invoice
        FROM fx_line
    """,
    "fx_gl_account": """
        SELECT DISTINCT Data_Folder_Id, Account, 'Acct '||substring(Account,1,2) AS Account_Title, 'Posting' AS Account_Type
        FROM fx_glt
    """,
    "fx_base_account": """
        SELECT DISTINCT Data_Folder_Id, CAST(10000 + l_partkey % 50 AS STRING) AS Base_Account,
            'Base '||CAST(l_partkey % 50 AS STRING) AS Base_Account_Title,
            CASE l_partkey % 10 WHEN 0 THEN 'Current assets' WHEN 1 THEN 'Noncurrent assets'
                WHEN 2 THEN 'Current liab' WHEN 3 THEN 'Equity' WHEN 4 THEN 'Retained earnings'
                WHEN 5 THEN 'Income' WHEN 6 THEN 'Cost' WHEN 7 THEN 'Expense' WHEN 8 THEN 'Other income'
                ELSE 'Unlisted type' END AS Base_Account_Type
        FROM fx_line
    """,
    "fx_bank": """
        SELECT g.Data_Folder_Id, 'BK'||g.Prefix_A AS Bank_Account, a.Account AS General_Cash_Account,
            CASE WHEN g.n_nationkey % 2 = 0 THEN 'Checking' ELSE 'Savings' END AS Account_Type,
            g.n_name||' operating' AS Description, g.n_name AS Bank_Name,
            CASE WHEN g.n_nationkey % 3 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2000-06-30' END AS Last_Reconciled_Date
        FROM fx_geo g LEFT JOIN (SELECT Data_Folder_Id, substring(Account,1,2) AS p, min(Account) AS Account
        FROM fx_gl_account
        GROUP BY Data_Folder_Id, substring(Account,1,2)) a ON g.Data_Folder_Id = a.Data_Folder_Id AND g.Prefix_A = a.p
    """,
    "fx_bank_register": """
        SELECT g.Data_Folder_Id, 'BK'||g.Prefix_A AS Bank_Account, CAST(e.ts AS DATE) AS Accounting_Date,
            CAST(e.event_id AS STRING) AS Check_No,
            CASE WHEN e.event_id % 2 = 0 THEN CAST(e.value AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS Subtraction,
            CASE WHEN e.event_id % 2 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(e.value AS DECIMAL(18,2)) END AS Addition,
            'U'||CAST(e.user_id AS STRING) AS Payee, e.event_type AS Description,
            CASE e.event_type WHEN 'purchase' THEN 'C' WHEN 'view' THEN 'O' ELSE 'R' END AS Reconciliation_Status
        FROM events e JOIN fx_geo g ON e.user_id % 25 = g.n_nationkey
    """,
    "fx_customer": """
        SELECT g.Data_Folder_Id, 'C'||lpad(CAST(c.c_custkey AS STRING),6,'0') AS Customer, c.c_name AS Name,
            CASE WHEN c.c_acctbal >= 0 THEN 'Active' ELSE 'Inactive' END AS Status, c.c_mktsegment AS Customer_Type,
            CAST(c.c_custkey % 4 * 15 AS INT) AS Days_Before_Due,
            CASE c.c_nationkey % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'ZZ' ELSE '' END AS State,
            CASE c.c_nationkey % 3 WHEN 0 THEN 'NY' WHEN 1 THEN CAST(NULL AS STRING) ELSE 'ON' END AS Billing_State
        FROM customer c JOIN fx_geo g ON c.c_nationkey = g.n_nationkey
    """,
    "fx_vendor": """
        SELECT g.Data_Folder_Id, 'V'||lpad(CAST(s.s_suppkey AS STRING),5,'0') AS Vendor, s.s_name AS Name,
            CASE WHEN s.s_acctbal < 0 THEN 1 ELSE 0 END AS Inactive,
            CASE WHEN s.s_suppkey % 2 = 0 THEN 'Subcontractor' ELSE 'Supplier' END AS Type,
            CASE WHEN s.s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS Receives_Form_1099,
            CASE s.s_suppkey % 5 WHEN 0 THEN 'Non-employee comp' WHEN 1 THEN 'Rents' WHEN 2 THEN 'Interest' WHEN 3 THEN '' ELSE 'Other form' END AS Form_Type_1099,
            CAST(s.s_acctbal AS DECIMAL(18,2)) AS Amt_Paid_This_Yr_1099,
            CAST(s.s_suppkey % 3 * 5 AS INT) AS Discount_Days, 2 AS Discount_Percent,
            CAST(s.s_suppkey % 4 * 15 AS INT) AS Payment_Days,
            CASE s.s_suppkey % 3 WHEN 0 THEN 'Electronic' WHEN 1 THEN 'Check' ELSE 'Wire' END AS Default_Payment_Type,
            CAST(s.s_suppkey * 1000003 AS STRING) AS Bank_ID,
            CASE WHEN s.s_suppkey % 2 = 0 THEN 'Checking' ELSE 'Savings' END AS Account_Type,
            CASE WHEN s.s_suppkey % 4 = 0 THEN 'Solo' ELSE 'First Last'||CAST(s.s_suppkey AS STRING) END AS Contact_1_Name,
            CASE WHEN s.s_nationkey % 2 = 0 THEN 'WA' ELSE '' END AS State
        FROM supplier s JOIN fx_geo g ON s.s_nationkey = g.n_nationkey
    """,
    "fx_ap_distribution": """
        SELECT Data_Folder_Id, Vendor, 'I'||CAST(l_orderkey AS STRING) AS Invoice, l_linenumber AS Dist_Seq,
            'Dist '||CAST(l_linenumber AS STRING) AS Description, amt AS Amount,
            CASE WHEN l_partkey % 3 = 0 THEN amt ELSE CAST(0 AS DECIMAL(18,2)) END AS Amount_Paid,
            CASE WHEN l_partkey % 7 = 0 THEN CAST(100 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS Retainage,
            CAST(0 AS DECIMAL(18,2)) AS Retainage_Paid, CASE WHEN l_partkey % 2 = 0 THEN Job ELSE '' END AS Job,
            Extra, Prefix_A||'-00-10000' AS Expense_Account, Cost_Code, Category, '' AS Commitment
        FROM fx_line
    """,
    "fx_ap_invoice": """
        SELECT DISTINCT Data_Folder_Id, Vendor, 'I'||CAST(l_orderkey AS STRING) AS Invoice, o_date AS Invoice_Date,
            o_date AS Accounting_Date, CAST(o_date + INTERVAL 30 DAY AS DATE) AS Payment_Date,
            CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Paid' END AS Status
        FROM fx_line
    """,
    "fx_art": """
        SELECT Data_Folder_Id, Customer, 'Invoice' AS Status_Type, o_date AS Status_Date,
            CAST(l_orderkey AS INT) AS Status_Seq, CAST(l_linenumber AS INT) AS Actvty_Seq,
            CASE WHEN l_returnflag = 'R' THEN CAST(-amt AS DECIMAL(18,2)) ELSE amt END AS Amount,
            CASE WHEN l_partkey % 4 = 0 THEN CAST(-50 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS Retainage,
            CASE l_linenumber % 3 WHEN 0 THEN 'Retainage released' WHEN 1 THEN 'Amount' ELSE 'Retainage billed' END AS Amount_Type,
            CASE WHEN l_linenumber % 5 = 0 THEN 'Invoice adjustment' ELSE 'Invoice' END AS Transaction_Type,
            CASE WHEN l_linenumber % 4 = 0 THEN CAST(NULL AS DATE) ELSE o_date END AS Accounting_Date,
            CASE WHEN l_linenumber % 4 = 1 THEN CAST(NULL AS DATE) ELSE CAST(o_date + INTERVAL 30 DAY AS DATE) END AS Due_Date,
            Job, Extra, 'I'||CAST(l_orderkey AS STRING) AS Invoice
        FROM fx_line
    """,
    "fx_ara_status": """
        SELECT DISTINCT Data_Folder_Id, Customer, Status_Type, Status_Date,
            CASE WHEN Status_Seq % 10 = 9 THEN -Status_Seq ELSE Status_Seq END AS Status_Seq, Invoice, 'Open' AS Status
        FROM fx_art
    """,
    "fx_ara_activity": """
        SELECT Data_Folder_Id, Customer, Status_Type, Status_Date,
            CASE WHEN Status_Seq % 4 = 0 THEN -Status_Seq ELSE Status_Seq END AS Status_Seq, Actvty_Seq,
            CASE WHEN Amount_Type = 'Retainage released' THEN 'Retainage released' ELSE 'Invoice' END AS Activity_Type,
            CASE WHEN Amount_Type = 'Retainage released' THEN CAST(-Retainage AS DECIMAL(18,2)) ELSE Retainage END AS Retainage_Held,
            CASE WHEN Amount_Type = 'Retainage billed' THEN Retainage ELSE CAST(0 AS DECIMAL(18,2)) END AS Retainage_Billed
        FROM fx_art
    """,
    "fx_job": """
        SELECT g.Data_Folder_Id, g.Prefix_A||'-'||lpad(CAST(c.c_custkey AS STRING),6,'0') AS Job,
            c.c_name||' job' AS Description,
            CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'Closed' ELSE 'In progress' END AS Status,
            g.Prefix_A AS Cost_Account_Prefix, 'C'||lpad(CAST(c.c_custkey AS STRING),6,'0') AS AR_Customer,
            CAST(c.c_acctbal AS DECIMAL(18,2)) AS Original_Contract_Amount,
            CASE WHEN c.c_custkey % 3 = 0 THEN CAST(NULL AS DATE) ELSE DATE '1999-01-15' END AS Actual_Start_Date,
            CAST(NULL AS DATE) AS Estimated_Comp_Date, DATE '2000-10-31' AS Last_Cost_Update
        FROM customer c JOIN fx_geo g ON c.c_nationkey = g.n_nationkey
    """,
    "fx_extra": """
        SELECT Data_Folder_Id, Job||CASE WHEN CAST(substring(Job,4,6) AS INT) % 2 = 0 THEN '' ELSE 'N' END AS Job,
            'X1' AS Extra, Description||' extra' AS Description
        FROM fx_job
    """,
    "fx_jct": """
        SELECT Data_Folder_Id, Job, Extra, Cost_Code, Category, Vendor, Customer, d AS Accounting_Date,
            CASE l_suppkey % 4 WHEN 0 THEN 'AP' WHEN 1 THEN 'PR' ELSE 'JC' END AS Application_of_Origin,
            'B'||lpad(CAST(l_orderkey % 400 AS STRING),4,'0') AS Batch, 'I'||CAST(l_orderkey AS STRING) AS Invoice,
            '' AS AR_Invoice, 'Cost, '||l_linestatus AS Description,
            CASE WHEN l_returnflag = 'R' THEN CAST(-amt AS DECIMAL(18,2)) ELSE amt END AS Amount,
            CASE WHEN l_partkey % 11 = 0 THEN '' ELSE Prefix_A||'-00-10000' END AS Debit_Account,
            Prefix_A||'-00-10001' AS Credit_Account,
            CASE WHEN l_partkey % 13 = 0 THEN 'PO1' ELSE '' END AS Commitment,
            CASE l_linenumber % 4 WHEN 0 THEN 'AP cost' WHEN 1 THEN 'JC cost' WHEN 2 THEN 'PR cost' ELSE 'Estimate' END AS Transaction_Type
        FROM fx_line
    """,
    "fx_job_cost_code": """
        SELECT DISTINCT Data_Folder_Id, Job, Extra,
            CASE WHEN Cost_Code LIKE '3%' THEN '7'||substring(Cost_Code,2) ELSE Cost_Code END AS Cost_Code, 'Code '||Cost_Code AS Description,
            CAST(10 AS DECIMAL(18,2)) AS Orig_Production_Units_Est,
            CAST(1 AS DECIMAL(18,2)) AS Apprvd_Prodctn_Unit_Chgs
        FROM fx_jct
    """,
    "fx_job_category": """
        SELECT Data_Folder_Id, Job, Extra, Cost_Code, Category,
            CAST(sum(CASE WHEN Amount > 0 THEN Amount ELSE 0 END) AS DECIMAL(18,2)) AS Original_Estimate,
            CAST(sum(CASE WHEN Amount < 0 THEN Amount ELSE 0 END) AS DECIMAL(18,2)) AS Approved_Estimate_Changes,
            CAST(count(*) AS DECIMAL(18,2)) AS Original_Estimate_Units,
            CAST(1 AS DECIMAL(18,2)) AS Approved_Est_Unit_Changes, 'EA' AS Cost_Unit_Description,
            min(Debit_Account) AS Cost_Account
        FROM fx_jct
        GROUP BY Data_Folder_Id, Job, Extra, Cost_Code, Category
    """,
    "fx_std_cost_code": """
        SELECT DISTINCT Data_Folder_Id, Cost_Code, 'Code '||Cost_Code AS Description,
            CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'L' END AS Category_1,
            CASE WHEN l_partkey % 4 = 0 THEN '' WHEN l_partkey % 4 = 1 THEN 'M' ELSE ' ' END AS Category_2,
            CASE WHEN l_partkey % 4 = 3 THEN 'S' ELSE CAST(NULL AS STRING) END AS Category_3
        FROM fx_line
    """,
    "fx_std_category": """
        SELECT DISTINCT Data_Folder_Id, CASE WHEN Category = 'O' THEN 'OX' ELSE Category END AS Category,
            CASE Category WHEN 'L' THEN 'Labor' WHEN 'M' THEN 'Material' WHEN 'S' THEN 'Subcontract'
                ELSE 'Equipment' END AS Description,
            CASE Category WHEN 'L' THEN 'Labor' WHEN 'M' THEN 'Material' WHEN 'S' THEN 'Subcontract'
                ELSE 'Equipment' END AS Accumulate_As,
            CASE Category WHEN 'L' THEN '10000' WHEN 'M' THEN '10001' WHEN 'S' THEN '10002'
                ELSE '99999' END AS Cost_Account_A, 'EA' AS Cost_Unit_Description
        FROM fx_line
    """,
    "fx_contract": """
        SELECT Data_Folder_Id, Job AS Contract, Description,
            CASE WHEN Status = 'Closed' THEN CAST(NULL AS DATE) ELSE DATE '1999-02-01' END AS Contract_Date,
            DATE '1999-01-01' AS Date_Stamp
        FROM fx_job
    """,
    "fx_contract_item": """
        SELECT DISTINCT Data_Folder_Id, Job AS Contract, CAST(l_linenumber AS STRING) AS Contract_Item, Job,
            Customer, 'Item '||CAST(l_linenumber AS STRING) AS Description,
            CASE l_linenumber % 4 WHEN 0 THEN 'Progress Billing' WHEN 1 THEN 'Cost Plus to Maximum' WHEN 2 THEN 'Time & Materials' ELSE CAST(NULL AS STRING) END AS Billing_Type,
            CASE WHEN l_linenumber % 2 = 0 THEN CAST(NULL AS DATE) ELSE DATE '1999-03-01' END AS Approval_Date,
            DATE '1999-01-01' AS Date_Stamp,
            CAST(l_linenumber * 1000 - 3000 AS DECIMAL(18,2)) AS Original_Contract_Total
        FROM fx_line
    """,
    "fx_contract_item_derived": """
        SELECT Data_Folder_Id, Contract, Contract_Item,
            CAST(CASE WHEN Contract_Item IN ('2','4') THEN 250 ELSE 0 END AS DECIMAL(18,2)) AS Approved_Contract_Changes,
            CAST(Original_Contract_Total + 250 AS DECIMAL(18,2)) AS Revised_Contract
        FROM fx_contract_item
    """,
    "fx_contract_derived": """
        SELECT Data_Folder_Id, Contract, CAST(sum(Original_Contract_Total) AS DECIMAL(18,2)) AS Revised_Contract
        FROM fx_contract_item
        GROUP BY Data_Folder_Id, Contract
    """,
    "fx_employee": """
        SELECT g.Data_Folder_Id, 'E'||CAST(c.c_custkey AS STRING) AS Employee,
            CASE c.c_custkey % 5 WHEN 0 THEN 'Last'||CAST(c.c_custkey AS STRING)||'; First M' WHEN 1 THEN 'Last'||CAST(c.c_custkey AS STRING)||', First' WHEN 2 THEN 'Mono'||CAST(c.c_custkey AS STRING) WHEN 3 THEN ' ; First' ELSE 'A, B; C D E' END AS Employee_Name,
            CASE WHEN c.c_acctbal < 0 THEN DATE '2000-05-31' ELSE CAST(NULL AS DATE) END AS Termination_Date,
            DATE '1995-01-02' AS Hire_Date,
            CASE WHEN c.c_custkey % 6 = 0 THEN DATE '1998-03-04' ELSE CAST(NULL AS DATE) END AS Rehire_Date
        FROM customer c JOIN fx_geo g ON c.c_nationkey = g.n_nationkey
    """,
}
