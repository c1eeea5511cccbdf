"""The expected result of each query as DuckDB SQL over the driver's tables.

``sql(text)`` puts the common table expressions that a query names, directly or through others, in
front of it. Line numbers use the same tie-breaking columns as the Spark builders, so results are
comparable row by row.
"""

from __future__ import annotations

import re

from checks.fixtures import ADAPTERS

# Account type -> statement type, normal balance, closeable.
ACCOUNT_TYPES = [
    ("Current assets", "N", "DB", "N"),
    ("Noncurrent assets", "N", "DB", "N"),
    ("Current liab", "N", "CR", "N"),
    ("Noncurrent liab", "N", "CR", "N"),
    ("Equity", "N", "CR", "N"),
    ("Retained earnings", "N", "CR", "R"),
    ("Income", "I", "CR", "C"),
    ("Cost", "I", "DB", "C"),
    ("Expense", "I", "DB", "C"),
    ("Other income", "I", "CR", "C"),
]

# State and province codes.
STATES = [
    ("AB", "Alberta"), ("AK", "Alaska"), ("AL", "Alabama"), ("AR", "Arkansas"), ("AS", "American Samoa"),
    ("AZ", "Arizona"), ("BA", "Bahamas"), ("BC", "British Columbia"), ("CA", "California"), ("CO", "Colorado"),
    ("CT", "Connecticut"), ("DC", "District of Columbia"), ("DE", "Delaware"), ("FL", "Florida"), ("GA", "Georgia"),
    ("GU", "Guam"), ("HI", "Hawaii"), ("IA", "Iowa"), ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"),
    ("KS", "Kansas"), ("KY", "Kentucky"), ("LA", "Louisiana"), ("MA", "Massachusetts"), ("MB", "Manitoba"),
    ("MD", "Maryland"), ("ME", "Maine"), ("MI", "Michigan"), ("MN", "Minnesota"), ("MO", "Missouri"),
    ("MS", "Mississippi"), ("MT", "Montana"), ("NB", "New Brunswick"), ("NC", "North Carolina"),
    ("ND", "North Dakota"), ("NE", "Nebraska"), ("NH", "New Hampshire"), ("NJ", "New Jersey"),
    ("NL", "Newfoundland"), ("NM", "New Mexico"), ("NS", "Nova Scotia"), ("NT", "Northwest Territory"),
    ("NU", "Nunavut"), ("NV", "Nevada"), ("NY", "New York"), ("OH", "Ohio"), ("OK", "Oklahoma"), ("ON", "Ontario"),
    ("OR", "Oregon"), ("PA", "Pennsylvania"), ("PE", "Prince Edward Island"), ("PR", "Puerto Rico"),
    ("QC", "Province of Quebec"), ("RI", "Rhode Island"), ("SC", "South Carolina"), ("SD", "South Dakota"),
    ("SK", "Saskatchewan"), ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"), ("VA", "Virginia"),
    ("VI", "Virgin Islands"), ("VT", "Vermont"), ("WA", "Washington"), ("WI", "Wisconsin"), ("WV", "West Virginia"),
    ("WY", "Wyoming"), ("YT", "Yukon Territory"), ("", ""),
]

# Tax form description -> code.
TAX_FORMS = [("Non-employee comp", "NEC"), ("Rents", "R"), ("Interest", "INT"), ("Dividends", "DIV"), ("", "")]

BALANCE_END, MONTH_START, MONTH_STOP = "DATE '1998-12-31'", "DATE '1999-01-01'", "DATE '1999-12-31'"
DETAIL_START, DETAIL_STOP = "DATE '2000-01-01'", "DATE '2000-11-30'"
NO_DAY = "DATE '1900-01-01'"


def _values(rows: list[tuple[str, ...]], *names: str) -> str:
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(names)})"


def by(*names: str) -> str:
    """An ORDER BY list that sorts NULLs first, as Spark does."""
    return ", ".join(f"{n} NULLS FIRST" for n in names)


def iso(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


def month(date: str) -> str:
    return f"strftime({date}, '%Y-%m')"


CTES: dict[str, str] = dict(ADAPTERS)

CTES["acct_types"] = _values(ACCOUNT_TYPES, "base_account_type", "acct_type", "normal_balance", "closeable")
CTES["states"] = _values(STATES, "state_id", "state_name")
CTES["tax_forms"] = _values(TAX_FORMS, "form_type_1099_desc", "form_type_1099_code")

CTES["chart_cut"] = """
    SELECT a.*, f.Account_Prefix_A_Length AS n_a, f.Account_Prefix_AB_Length AS n_ab,
        f.Account_Prefix_ABC_Length AS n_abc, f.Base_Account_Length AS n_base, f.Suffix_Length AS n_suffix,
        split_part(a.Account, '.', 1) AS lhs,
        CASE WHEN instr(a.Account, '.') > 0 THEN substr(a.Account, instr(a.Account, '.') + 1) ELSE '' END AS rhs
    FROM fx_gl_account a JOIN fx_account_format f ON a.Data_Folder_Id = f.Data_Folder_Id
"""
CTES["chart_base"] = """
    SELECT *, right(rhs, n_suffix) AS suffix, right(lhs, n_base) AS baseaccount,
        left(lhs, greatest(length(rtrim(lhs)) - n_base, 0)) AS pre
    FROM chart_cut
"""
CTES["chart_c"] = """
    SELECT *, CASE WHEN n_abc > n_ab THEN right(pre, n_abc - n_ab) ELSE '' END AS raw_c FROM chart_base
"""
CTES["chart_c2"] = """
    SELECT *, CASE WHEN n_abc = 0 THEN pre
        ELSE left(pre, greatest(length(rtrim(pre)) - length(rtrim(raw_c)), 0)) END AS pre2
    FROM chart_c
"""
CTES["chart_b"] = """
    SELECT *, CASE WHEN n_ab > n_a THEN right(pre2, n_ab - n_a) ELSE '' END AS raw_b FROM chart_c2
"""
CTES["chart_a"] = """
    SELECT *, rtrim(replace(left(pre2, greatest(length(rtrim(pre2)) - length(rtrim(raw_b)), 0)), '-', '')) AS prefixa,
        rtrim(replace(raw_b, '-', '')) AS prefixb, rtrim(replace(raw_c, '-', '')) AS prefixc
    FROM chart_b
"""
CTES["chart"] = """
    SELECT Data_Folder_Id AS data_folder_id, Account AS account, Account_Title AS account_title,
        Account_Type AS account_type, prefixa, prefixb, prefixc,
        CASE WHEN raw_b = '' THEN prefixa ELSE prefixa || '-' || prefixb END AS prefixab,
        CASE WHEN raw_c <> '' THEN prefixa || '-' || prefixb || '-' || prefixc
            WHEN raw_b = '' THEN prefixa ELSE prefixa || '-' || prefixb END AS prefixabc,
        baseaccount, suffix,
        CASE WHEN suffix = '' THEN baseaccount ELSE baseaccount || '.' || suffix END AS acct
    FROM chart_a
"""
CTES["names_cut"] = """
    SELECT *, CASE WHEN instr(Employee_Name, ';') > 0 THEN instr(Employee_Name, ';')
        ELSE instr(Employee_Name, ',') END AS cut
    FROM fx_employee
"""
CTES["names_rest"] = """
    SELECT *, CASE WHEN cut > 0 THEN trim(substr(Employee_Name, cut + 1)) ELSE '' END AS rest FROM names_cut
"""
CTES["staff"] = """
    SELECT Data_Folder_Id, Employee, Employee_Name, Termination_Date, Hire_Date, Rehire_Date,
        nullif(trim(CASE WHEN cut > 0 THEN left(Employee_Name, cut - 1) ELSE Employee_Name END), '') AS last_name,
        split_part(rest, ' ', 1) AS first_name,
        CASE WHEN instr(rest, ' ') > 0 THEN trim(substr(rest, instr(rest, ' ') + 1)) ELSE '' END AS mi
    FROM names_rest
"""

CTES["map_data_folder"] = """
    SELECT DISTINCT Data_Folder_Id AS legacy_data_folder_id, Section_Id AS legacy_data_folder_name,
        Data_Folder_Id AS new_id, Section_Id AS new_name, 'ENTITY' AS destination, 1 AS include_data_folder
    FROM fx_data_folder
"""
CTES["map_job"] = f"""
    SELECT Job AS legacy_job_id, Description AS legacy_job_name, Status AS legacy_job_status, Job AS new_job_id,
        Description AS new_job_name, Data_Folder_Id AS legacy_data_folder_id,
        CASE WHEN Status = 'Closed' THEN 0 WHEN Status IS NULL THEN 0 ELSE 1 END AS include_job,
        Data_Folder_Id AS data_folder_id, '' AS legacy_extra_id, '' AS new_entity_id, '' AS new_department_id,
        '' AS new_class_id, '' AS new_customer_id, '' AS new_pm_id
    FROM fx_job
    UNION ALL
    SELECT Job, Description, NULL, NULL, Description, Data_Folder_Id, 0, Data_Folder_Id, Extra, NULL, NULL, NULL,
        NULL, NULL
    FROM fx_extra
"""
CTES["map_customer"] = """
    SELECT Data_Folder_Id AS data_folder_id, Customer AS legacy_customer_id, Name AS legacy_customer_name,
        Status AS legacy_customer_status, Customer_Type AS legacy_customer_type, Customer AS new_customer_id,
        Customer_Type AS new_customer_type, CAST(coalesce(Status = 'Active', FALSE) AS INT) AS include_customer,
        '-' AS on_open_ar, '-' AS on_open_oe, '-' AS on_open_other
    FROM fx_customer
"""
CTES["map_vendor"] = """
    SELECT Data_Folder_Id AS data_folder_id, Vendor AS legacy_vendor_id, Name AS legacy_vendor_name,
        CASE Inactive WHEN 1 THEN 'INACTIVE' ELSE 'ACTIVE' END AS legacy_vendor_status, Type AS legacy_vendor_type,
        Vendor AS new_vendor_id, Type AS new_vendor_type, CASE Inactive WHEN 1 THEN 0 ELSE 1 END AS include_vendor,
        0 AS on_open_ap, 0 AS on_open_commitment, 0 AS on_open_other
    FROM fx_vendor
"""
CTES["map_cost_code"] = """
    SELECT Cost_Code AS legacy_cost_code_id, Description AS legacy_cost_code_name, Cost_Code AS new_cost_code_id,
        Description AS new_cost_code_name, Cost_Code AS new_item_id, Data_Folder_Id AS data_folder_id
    FROM fx_std_cost_code
"""
CTES["map_cost_type"] = """
    SELECT Category AS legacy_cost_type_id, Description AS legacy_cost_type_name, Category AS new_cost_type_id,
        Accumulate_As AS new_item_id, Cost_Account_A AS new_gl_account, Data_Folder_Id AS data_folder_id
    FROM fx_std_category
"""
CTES["base_candidates"] = """
    SELECT DISTINCT data_folder_id AS folder, baseaccount AS legacy, account_title AS note, 'BASE' AS kind,
        baseaccount AS fresh, baseaccount AS base
    FROM chart
    WHERE NOT EXISTS (SELECT 1 FROM fx_bank b
        WHERE b.Data_Folder_Id = chart.data_folder_id AND b.General_Cash_Account = chart.account)
    UNION ALL
    SELECT b.Data_Folder_Id, b.General_Cash_Account,
        b.Account_Type || ' | ' || b.Description || ' | ' || b.Bank_Name || ' | ' || b.Bank_Account, 'FULL',
        '(New GL Account Needed)', k.baseaccount
    FROM fx_bank b LEFT JOIN chart k ON k.data_folder_id = b.Data_Folder_Id AND k.account = b.General_Cash_Account
"""
CTES["map_base_account"] = """
    SELECT n.folder AS data_folder_id, n.legacy AS legacy_base_account, n.note,
        CASE WHEN t.acct_type = 'N' THEN 'BS' ELSE 'IS' END AS fin_stmt, t.normal_balance AS balance, t.closeable,
        t.base_account_type AS acct_type, n.kind AS acct_match_type, '1' AS required, n.fresh AS new_base_account,
        '' AS cmo, '' AS category
    FROM base_candidates n
    LEFT JOIN fx_base_account m ON m.Data_Folder_Id = n.folder AND m.Base_Account = n.base
    LEFT JOIN acct_types t ON t.base_account_type = m.Base_Account_Type
"""
CTES["map_entity"] = """
    SELECT Data_Folder_Id AS data_folder_id, Account_Prefix AS legacy_entity_id, Description AS legacy_entity_name,
        Account_Prefix AS new_entity_id, 0 AS include_entity, 0 AS pkg_base, 0 AS pkg_constr_sum,
        0 AS pkg_constr_det, 0 AS pkg_npc_commit, 0 AS pkg_pc_commit
    FROM fx_prefix_a
"""
CTES["map_batch_combine"] = """
    SELECT Batch AS source_batch, last_day(Accounting_Date) AS period,
        Batch || ' | ' || strftime(last_day(Accounting_Date), '%Y-%m') AS batch_per,
        CAST(sum(Debit) AS DECIMAL(38,2)) AS debit, CAST(-sum(Credit) AS DECIMAL(38,2)) AS credit,
        CAST(sum(round(Debit + Credit, 2)) AS DECIMAL(38,2)) AS net,
        CAST(abs(sum(round(Debit + Credit, 2))) AS DECIMAL(38,2)) AS net_abs, Batch AS to_batch_alias,
        Batch AS to_batch_id
    FROM fx_glt
    WHERE Accrual_or_Cash = 'Accrual' AND Accounting_Date BETWEEN DATE '1999-01-01' AND DATE '1999-11-30'
        AND left(Account, 2) IN ('01', '02')
    GROUP BY ALL
    HAVING sum(round(Debit + Credit, 2)) <> 0
"""
CTES["map_employee"] = """
    SELECT Employee AS legacy_employee_id, Employee_Name AS legacy_employee_name,
        if(Termination_Date IS NULL, 'Active', 'Inactive') AS legacy_employee_status, Employee AS new_employee_id,
        if(Termination_Date IS NULL, 1, 0) AS include_employee, Data_Folder_Id AS data_folder_id
    FROM fx_employee
"""
for _name in ("location", "department"):
    CTES[f"map_{_name}"] = f"""
        SELECT DISTINCT data_folder_id, prefixabc AS legacy_{_name}_id, prefixabc AS new_{_name}_id FROM chart
    """

# New account per ledger account: the full match, else the base match.
CTES["targets"] = """
    SELECT k.*, coalesce(f.new_base_account, b.new_base_account, '(MISSING)') AS acct_no
    FROM chart k
    LEFT JOIN map_base_account f ON f.acct_match_type = 'FULL' AND f.legacy_base_account = k.account
        AND f.data_folder_id = k.data_folder_id
    LEFT JOIN map_base_account b ON b.acct_match_type = 'BASE' AND b.legacy_base_account = k.baseaccount
        AND b.data_folder_id = k.data_folder_id AND f.legacy_base_account IS NULL
"""
CTES["jobs_in"] = "SELECT * FROM map_job WHERE include_job = 1"
CTES["jobs_plain"] = "SELECT * FROM map_job WHERE coalesce(legacy_extra_id, '') = ''"


def _pattern() -> re.Pattern:
    return re.compile(r"\b(" + "|".join(CTES) + r")\b")


def sql(text: str) -> str:
    """``text`` with every table expression it needs in front, in dependency order."""
    done: list[str] = []
    pattern = _pattern()

    def need(body: str) -> None:
        for name in pattern.findall(body):
            if name not in done:
                need(CTES[name])
                if name not in done:
                    done.append(name)

    need(text)
    if not done:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in done) + "\n" + text.strip()


def dup(values: list[str]) -> str:
    """Select list in which skip columns (written ``D: expression``) get their numbered names."""
    out, n = [], 0
    for item in values:
        name, _, value = item.partition(":")
        value = value.strip()
        if name.strip() == "D":
            n += 1
            name = f"DONOTIMPORT_{n:02d}"
        out.append(f"{value} AS {name.strip()}")
    return ", ".join(out)


def columns(spec: str, rest: str) -> str:
    """A SELECT from a column list with one ``NAME: expression`` per line."""
    return "SELECT " + dup([line for line in spec.strip().splitlines() if line.strip()]) + " " + rest


def select(spec: str, rest: str) -> str:
    return sql(columns(spec, rest))


def head(expression: str, line: str = "line") -> str:
    return f"CASE WHEN {line} = 1 THEN {expression} ELSE '' END"
