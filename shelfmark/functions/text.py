"""String clean-up as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing key or amount.
NULL_TOKENS = ("", "NA", "NULL", "N/A")

MISSING = "N/A"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key(c: Column | str) -> Column:
    """Comparable form of a business key: no outer spaces, upper case."""
    return F.upper(F.trim(as_col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def upper_text(c: Column | str) -> Column:
    return F.upper(blank_to_null(c))


def lower_text(c: Column | str) -> Column:
    return F.lower(blank_to_null(c))


def optional_key(c: Column | str) -> Column:
    """A key, or NULL where the text only stands for a missing one."""
    k = key(c)
    return F.when(~k.isin(*NULL_TOKENS), k)


def bounded(c: Column | str, size: int) -> Column:
    return F.substring(as_col(c), 1, size)


def text_length(c: Column | str) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(as_col(c)))


def capitalize(c: Column | str) -> Column:
    """First letter upper, the rest lower: 'LOS ANGELES' -> 'Los angeles'."""
    c = as_col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def proper_case(c: Column | str) -> Column:
    """Every space-separated word capitalized, inner spaces kept."""
    return F.initcap(F.trim(as_col(c)))


def list_head(c: Column | str, separator: str = ";") -> Column:
    return F.trim(F.substring_index(as_col(c), separator, 1))


def or_missing(c: Column | str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(MISSING))


def international_phone(c: Column | str) -> Column:
    phone = F.trim(as_col(c))
    return F.when(phone.startswith("+"), phone).otherwise(F.lit(MISSING))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    c = as_col(c)
    cut = F.substr(c, F.lit(len(prefix) + 1))
    return F.when(c.startswith(prefix) & (F.length(c) > len(prefix)), cut).otherwise(c)


def pattern_label(c: Column | str, rules: Sequence[tuple[str, str]], default: Column | str | None = None) -> Column:
    """Label of the first LIKE pattern that fits; ``default`` (or the value itself) otherwise."""
    c = as_col(c)
    chain = None
    for pattern, label in rules:
        fits = c.like(pattern)
        chain = F.when(fits, label) if chain is None else chain.when(fits, label)
    rest = c if default is None else (F.lit(default) if isinstance(default, str) else default)
    return rest if chain is None else chain.otherwise(rest)


def value_label(c: Column | str, groups: dict[str, Sequence[str]], default: str) -> Column:
    """Label of the group that lists the value."""
    c = key(c)
    chain = None
    for label, members in groups.items():
        hit = c.isin(*members)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def masked(c: Column | str, secret: str) -> Column:
    """Keyed one-way digest of a personal value; the missing marker stays readable.

    Without the secret, short values such as phone numbers cannot be tried out. It is part of the
    plan, so keep plans and event logs as private as the secret."""
    if not secret:
        raise ValueError("masking needs a secret")
    c = as_col(c)
    inner = F.sha2(F.concat(F.lit(secret), c), 256)
    return F.when(c == MISSING, c).otherwise(F.sha2(F.concat(F.lit(secret), inner), 256))
