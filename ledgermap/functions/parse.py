"""Parsing and composing identifiers, names and memos as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import (
    blank_if_null,
    first_chars,
    from_char,
    joined,
    last_chars,
    length_of,
    position,
    text,
)


def account_segments(accounts: DataFrame, formats: DataFrame) -> DataFrame:
    """Split each ledger account by its folder's segment lengths.

    The part after the first dot holds the suffix. The part before it ends in the base account;
    what remains is read from the right as prefix C, then B, and the rest is prefix A.
    """
    fmt = formats.select(
        F.col("Data_Folder_Id").alias("_folder"),
        F.col("Suffix_Length").alias("_suffix_n"),
        F.col("Base_Account_Length").alias("_base_n"),
        F.col("Account_Prefix_A_Length").alias("_a"),
        F.col("Account_Prefix_AB_Length").alias("_ab"),
        F.col("Account_Prefix_ABC_Length").alias("_abc"),
    )
    c = F.col

    def tidy(name: str) -> Column:
        return F.rtrim(F.replace(c(name), F.lit("-"), F.lit("")))

    def without_tail(whole: str, tail: Column) -> Column:
        return first_chars(c(whole), length_of(c(whole)) - tail)

    cut = (
        accounts.join(fmt, c("Data_Folder_Id") == c("_folder"))
        .withColumn("_dot", position(c("Account"), "."))
        .withColumns(
            {
                "_left": F.when(c("_dot") > 0, first_chars(c("Account"), c("_dot") - 1)).otherwise(c("Account")),
                "_right": F.when(c("_dot") > 0, from_char(c("Account"), c("_dot") + 1)).otherwise(""),
            }
        )
        .withColumns(
            {
                "suffix": last_chars(c("_right"), c("_suffix_n")),
                "baseaccount": last_chars(c("_left"), c("_base_n")),
                "_head": without_tail("_left", c("_base_n")),
            }
        )
        .withColumn("_c", F.when(c("_abc") <= c("_ab"), "").otherwise(last_chars(c("_head"), c("_abc") - c("_ab"))))
        .withColumn("_head", F.when(c("_abc") == 0, c("_head")).otherwise(without_tail("_head", length_of(c("_c")))))
        .withColumn("_b", F.when(c("_ab") <= c("_a"), "").otherwise(last_chars(c("_head"), c("_ab") - c("_a"))))
        .withColumn("_head", without_tail("_head", length_of(c("_b"))))
        .withColumns({"prefixa": tidy("_head"), "prefixb": tidy("_b"), "prefixc": tidy("_c")})
    )
    ab = F.when(c("_b") == "", c("prefixa")).otherwise(joined(c("prefixa"), "-", c("prefixb")))
    abc = joined(c("prefixa"), "-", c("prefixb"), "-", c("prefixc"))
    return cut.select(
        c("Data_Folder_Id").alias("data_folder_id"),
        c("Account").alias("account"),
        c("Account_Title").alias("account_title"),
        c("Account_Type").alias("account_type"),
        "prefixa",
        "prefixb",
        "prefixc",
        ab.alias("prefixab"),
        F.when(c("_c") == "", ab).otherwise(abc).alias("prefixabc"),
        "baseaccount",
        "suffix",
        F.when(c("suffix") == "", c("baseaccount"))
        .otherwise(joined(c("baseaccount"), ".", c("suffix")))
        .alias("acct"),
    )


def employee_names(employees: DataFrame) -> DataFrame:
    """Add last name, first name and middle initial; ``;`` separates before ``,`` does."""
    c = F.col
    full = c("Employee_Name")
    semicolon, comma = position(full, ";"), position(full, ",")
    rest = F.trim(from_char(full, c("_cut") + 1))
    return (
        employees.withColumn("_cut", F.coalesce(F.when(semicolon > 0, semicolon).otherwise(comma), F.lit(0)))
        .withColumn("_rest", F.when(c("_cut") > 0, rest).otherwise(""))
        .withColumn("_gap", position(c("_rest"), " "))
        .withColumns(
            {
                "last_name": F.nullif(
                    F.trim(F.when(c("_cut") > 0, first_chars(full, c("_cut") - 1)).otherwise(full)), F.lit("")
                ),
                "first_name": F.when(c("_gap") == 0, c("_rest")).otherwise(first_chars(c("_rest"), c("_gap") - 1)),
                "mi": F.when(c("_gap") == 0, "").otherwise(F.trim(from_char(c("_rest"), c("_gap") + 1))),
            }
        )
        .drop("_cut", "_rest", "_gap")
    )


def code_tail(code: Column) -> Column:
    """The part after the first hyphen; the whole code if it has none."""
    return last_chars(code, length_of(code) - position(code, "-"))


def parent_code(code: Column) -> Column:
    """Parent of ``group-item`` is ``group-000``; a parent has no parent; without a hyphen NULL."""
    tail = F.when(position(code, "-") > 0, code_tail(code))
    number = F.when(F.trim(tail) == "", F.lit(0)).otherwise(tail.try_cast("int"))
    zeros = F.repeat(F.lit("0"), length_of(tail))
    return F.when(number == 0, "").otherwise(
        joined(F.when(position(code, "-") > 0, first_chars(code, position(code, "-") - 1)), "-", zeros)
    )


def rebase_contract(contract: Column, job: Column) -> Column:
    """Put a contract under the new job's prefix when both ids are hyphenated."""
    at_contract, at_job = position(contract, "-"), position(job, "-")
    return F.when(
        at_contract * at_job > 0, joined(first_chars(job, at_job - 1), from_char(contract, at_contract))
    ).otherwise(contract)


def compose_memo(lead: Column, parts: Sequence[tuple[str, Column]], null_safe: bool) -> Column:
    """``lead`` without commas, then ``label + value`` for each non-blank value.

    With ``null_safe`` a NULL lead counts as blank; otherwise it makes the whole memo NULL.
    A NULL value adds nothing in both forms.
    """
    start = F.replace(lead, F.lit(","), F.lit(""))
    segments = [F.when(value != "", joined(label, value)).otherwise("") for label, value in parts]
    return F.concat(blank_if_null(start) if null_safe else start, *segments)


def vendor_contact(contact: Column) -> tuple[Column, Column]:
    """First word and the rest (30 characters at most) of a contact name."""
    gap = position(contact, " ")
    return F.trim(first_chars(contact, gap)), F.substring(contact, gap + 1, F.lit(30))


def routing_number(bank_id: Column) -> Column:
    return last_chars(joined(text("000000000"), bank_id.cast("string")), 9)
