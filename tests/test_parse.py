from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermap.functions.parse import (
    account_segments,
    compose_memo,
    employee_names,
    parent_code,
    rebase_contract,
    routing_number,
    vendor_contact,
)
from ledgermap.functions.semantics import flag_from_text, int_or_zero, money_text

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def fmt(a, ab, abc, base=5, suffix=3):
    return {
        "Account_Prefix_A_Length": a,
        "Account_Prefix_AB_Length": ab,
        "Account_Prefix_ABC_Length": abc,
        "Base_Account_Length": base,
        "Suffix_Length": suffix,
    }


@pytest.mark.parametrize(
    "account, lengths, want",
    [
        ("10000", fmt(0, 0, 0), ("", "", "", "", "", "10000", "", "10000")),
        ("01-10000", fmt(3, 3, 3), ("01", "", "", "01", "01", "10000", "", "10000")),
        ("01-02-10000.007", fmt(3, 6, 6), ("01", "02", "", "01-02", "01-02", "10000", "007", "10000.007")),
        ("01-02-03-10000.7", fmt(3, 6, 9), ("01", "02", "03", "01-02", "01-02-03", "10000", "7", "10000.7")),
        ("01-02-10000", fmt(3, 6, 0), ("01", "02", "", "01-02", "01-02", "10000", "", "10000")),
        ("123", fmt(3, 6, 6), ("", "", "", "", "", "123", "", "123")),
    ],
)
def test_account_segments(source, account, lengths, want):
    row = account_segments(source("gl_account", {"Account": account}), source("account_format", lengths)).first()
    got = (row.prefixa, row.prefixb, row.prefixc, row.prefixab, row.prefixabc, row.baseaccount, row.suffix, row.acct)
    assert got == want


def test_account_without_format_is_dropped(source):
    formats = source("account_format", {**fmt(3, 6, 6), "Data_Folder_Id": "F9"})
    assert account_segments(source("gl_account", {"Account": "01-02-10000"}), formats).count() == 0


part = st.text("0123456789", min_size=2, max_size=2)


@SLOW
@given(st.lists(st.tuples(part, part, part, st.text("123456789", min_size=5, max_size=5)), min_size=1, max_size=5))
def test_account_parts_are_found_again(source, parts):
    accounts = ["-".join(p) + ".001" for p in parts]
    df = account_segments(
        source("gl_account", *[{"Account": a} for a in accounts]), source("account_format", fmt(3, 6, 9))
    )
    got = sorted((r.prefixa, r.prefixb, r.prefixc, r.baseaccount) for r in df.collect())
    assert got == sorted(parts)


@pytest.mark.parametrize(
    "name, want",
    [
        ("Last; First M", ("Last", "First", "M")),
        ("Last, First", ("Last", "First", "")),
        ("Mono", ("Mono", "", "")),
        (" ; First", (None, "First", "")),
        ("A, B; C D E", ("A, B", "C", "D E")),
        ("", (None, "", "")),
        (None, (None, "", "")),
    ],
)
def test_employee_names(source, name, want):
    row = employee_names(source("employee", {"Employee": "1", "Employee_Name": name})).first()
    assert (row.last_name, row.first_name, row.mi) == want


def value(spark, column, **inputs):
    kinds = {k: "string" if v is None or isinstance(v, str) else "decimal(18,6)" for k, v in inputs.items()}
    df = spark.range(1).select(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in inputs.items()])
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "code, want", [("01-000", ""), ("01-010", "01-000"), ("01-1", "01-0"), ("0110", None), ("01-", "")]
)
def test_parent_code(spark, code, want):
    assert value(spark, parent_code(F.col("x")), x=code) == want


@pytest.mark.parametrize(
    "contract, job, want",
    [("10-A", "99-7", "99-A"), ("10", "99-7", "10"), ("10-A", "99", "10-A"), ("10-A", None, "10-A")],
)
def test_rebase_contract(spark, contract, job, want):
    assert value(spark, rebase_contract(F.col("a"), F.col("b")), a=contract, b=job) == want


@pytest.mark.parametrize(
    "lead, vendor, safe, want",
    [
        ("Pay, now", "V1", False, "Pay now | V: V1"),
        ("Pay", "", False, "Pay"),
        ("Pay", None, False, "Pay"),
        (None, "V1", False, None),
        (None, "V1", True, " | V: V1"),
    ],
)
def test_compose_memo(spark, lead, vendor, safe, want):
    assert value(spark, compose_memo(F.col("a"), [(" | V: ", F.col("b"))], safe), a=lead, b=vendor) == want


def test_vendor_fields(spark):
    first, last = vendor_contact(F.col("x"))
    assert value(spark, first, x="Ann Marie Poe") == "Ann" and value(spark, last, x="Ann Marie Poe") == "Marie Poe"
    assert value(spark, first, x="Solo") == "" and value(spark, last, x="Solo") == "Solo"
    assert value(spark, routing_number(F.col("x")), x="123") == "000000123"
    assert value(spark, routing_number(F.col("x")), x="1234567890123") == "567890123"


def test_value_rules(spark):
    assert value(spark, int_or_zero(F.col("x")), x=" ") == 0
    assert value(spark, int_or_zero(F.col("x")), x="ab") is None
    assert value(spark, money_text(F.col("x")), x=1234.565) == "1234.57"
    assert value(spark, money_text(F.col("x")), x=-2.345) == "-2.35"
    assert [value(spark, flag_from_text(F.col("x")), x=v) for v in ("True", "1", "", "False", "0")] == [1, 1, 0, 0, 0]
