"""Amounts and counts out of text, and exact decimal ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import NULL_TOKENS, as_col, key

MONEY = "decimal(18,2)"

# Marks that may surround an amount.
CURRENCY_MARKS = "$€, "
LINE_CURRENCY_MARKS = "$€£, "
THOUSANDS_MARKS = ", "

# try_cast reads exponents; as "x" they make the text no number
_EXPONENTS = ("eE", "xx")


def to_amount(c: Column | str, marks: str = CURRENCY_MARKS, sql_type: str = MONEY) -> Column:
    """An amount between currency marks, NULL for any other text.

    One ``translate`` replaces and deletes; a regular expression costs several times more."""
    exponents, spoilt = _EXPONENTS
    return F.translate(as_col(c), exponents + marks, spoilt).try_cast(sql_type)


def to_optional_amount(c: Column | str, marks: str = CURRENCY_MARKS) -> Column:
    return F.when(~key(c).isin(*NULL_TOKENS), to_amount(c, marks))


def to_decimal(c: Column | str, sql_type: str) -> Column:
    return to_amount(F.trim(as_col(c)), "", sql_type)


def to_int(c: Column | str) -> Column:
    return F.trim(as_col(c)).try_cast("int")


def or_zero(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def ratio(part: Column | str, whole: Column | str, times: int = 1, sql_type: str = MONEY) -> Column:
    """``part / whole * times`` where whole is positive, else 0.

    Scaling before the division keeps every digit the result type needs."""
    part, whole = as_col(part), as_col(whole)
    value = (part.cast("decimal(24,4)") * F.lit(times)) / whole.cast("decimal(24,4)")
    return F.when(whole > 0, value).otherwise(F.lit(0)).cast(sql_type)


def percent(part: Column | str, whole: Column | str, sql_type: str = MONEY) -> Column:
    return ratio(part, whole, 100, sql_type)


def share(part: Column | str, whole: Column | str) -> Column:
    """Percentage of rows to two decimals; NULL over an empty table."""
    scaled = as_col(part).cast("decimal(20,0)") * F.lit(100)
    return F.try_divide(scaled, as_col(whole).cast("decimal(20,0)")).cast("decimal(5,2)")


def average_money(c: Column | str, sql_type: str = "decimal(18,6)") -> Column:
    return F.avg(as_col(c)).cast(sql_type)


def cents(c: Column | str) -> Column:
    """Money as whole cents. Sums of sums stay plain long additions, where decimal sums widen
    with every level to types that are added as big integers."""
    return (as_col(c) * F.lit(100)).cast("bigint")


def from_cents(c: Column | str) -> Column:
    return (as_col(c).cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def total_money(c: Column | str) -> Column:
    return F.sum(as_col(c)).cast(MONEY)
