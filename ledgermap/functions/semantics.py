"""Value rules shared by every dataset.

Text built by ``joined`` is NULL as soon as one part is NULL; ``joined_or_blank`` reads NULL as
blank. Lengths ignore trailing blanks. Money is rounded half away from zero, which holds for
DECIMAL only, so amounts never pass through DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
NO_DATE = "1900-01-01"


def text(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def joined(*parts: str | Column) -> Column:
    """Concatenate; NULL if any part is NULL. Plain strings are literals."""
    return F.concat(*[text(p) for p in parts])


def joined_or_blank(*parts: str | Column) -> Column:
    """Concatenate, reading NULL parts as blank."""
    return F.concat(*[F.coalesce(text(p), F.lit("")) for p in parts])


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def tag(prefix: str, col: Column) -> Column:
    """Reference column such as ``PREFIX|value``; NULL stays NULL."""
    return joined(prefix, col)


def length_of(col: Column) -> Column:
    return F.length(F.rtrim(col))


def position(col: Column, needle: str) -> Column:
    """1-based position of ``needle``, 0 if absent."""
    return F.instr(col, needle)


def first_chars(col: Column, n: int | Column) -> Column:
    return F.left(col, F.greatest(F.lit(n) if isinstance(n, int) else n, F.lit(0)))


def last_chars(col: Column, n: int | Column) -> Column:
    return F.right(col, F.greatest(F.lit(n) if isinstance(n, int) else n, F.lit(0)))


def from_char(col: Column, start: Column) -> Column:
    """The rest of the text from the 1-based position ``start``."""
    return F.substring(col, start, F.length(col) + 1)


def int_or_zero(col: Column) -> Column:
    """Blank text counts as 0; text that is no number is NULL."""
    return F.when(F.trim(col) == "", F.lit(0)).otherwise(col.try_cast("int"))


def iso(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def iso_or_blank(col: Column) -> Column:
    return blank_if_null(iso(col))


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_end(col: Column) -> Column:
    return F.last_day(col)


def or_no_date(col: Column) -> Column:
    return F.coalesce(col, F.to_date(F.lit(NO_DATE)))


def unless_no_date(col: Column) -> Column:
    return F.nullif(col, F.to_date(F.lit(NO_DATE)))


def money(col: Column) -> Column:
    return F.round(col, 2).cast(MONEY)


def money_or_zero(col: Column) -> Column:
    return F.coalesce(money(col), F.lit(0).cast(MONEY))


def money_text(col: Column) -> Column:
    """Fixed two decimals, rounded half away from zero."""
    return money(col).cast("string")


def flag_from_text(col: Column) -> Column:
    """A sheet cell read into a 0/1 column: blank and ``False`` are 0, ``True`` and non-zero numbers 1, other text NULL."""
    word = F.lower(F.trim(col))
    return (
        F.when(word == "true", F.lit(1))
        .when(word.isin("false", ""), F.lit(0))
        .otherwise((word.try_cast("int") != 0).cast("int"))
    )


def flag_text(col: Column) -> Column:
    return F.when(col == 1, F.lit("True")).when(col == 0, F.lit("False"))
