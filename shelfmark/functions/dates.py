"""Dates out of text, and calendar arithmetic.

A text date is recognised by the place of its separators, put in ISO order and cast with
``try_cast``. That returns NULL without raising inside a format parser, which matters when a
large share of the rows is in another format."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import as_col


def _day_time(text: Column, token: Column, whole: bool) -> Column:
    """What follows the date: a time of day, with AM or PM as one of 24 hours if it is `whole`, and
    only checked otherwise; any other text as it is."""
    rest = F.substr(text, F.length(token) + 1)
    half = F.upper(F.right(text, F.lit(2)))
    clock = F.trim(F.substr(rest, F.lit(1), F.length(rest) - 2))
    hours = F.substring_index(clock, ":", 1)
    hour = hours.try_cast("int")
    if not whole:
        return F.when(half.isin("AM", "PM") & hour.between(1, 12), F.concat(F.lit(" "), clock)).otherwise(rest)
    shifted = hour % 12 + F.when(half == "PM", 12).otherwise(0)
    minutes = F.substr(clock, F.length(hours) + 1)
    written = F.concat(F.lit(" "), F.lpad(shifted.cast("string"), 2, "0"), minutes)
    return F.when(half.isin("AM", "PM") & hour.between(1, 12), written).otherwise(rest)


def _arranged(text: Column, day_first: bool, whole: bool) -> Column:
    """Two short numbers and a year between '/', '-' or '.', in ISO order. The month comes first; where
    the first number is no month and `day_first` allows it, the day does."""
    token = F.substring_index(text, " ", 1)
    slashed = F.translate(token, "-.", "//")
    first = F.substring_index(slashed, "/", 1)
    second = F.substring_index(F.substring_index(slashed, "/", 2), "/", -1)
    year = F.right(slashed, F.lit(4))
    if day_first:
        # a first number above 12 can only be a day; if both could be a month the month is first
        swap = F.lpad(first, 2, "0") > "12"
        numbers = F.when(swap, F.concat(second, F.lit("-"), first)).otherwise(F.concat(first, F.lit("-"), second))
    else:
        numbers = F.concat(first, F.lit("-"), second)
    return F.concat(year, F.lit("-"), numbers, _day_time(text, token, whole))


def _read(c: Column | str, day_first: bool, whole: bool) -> Column:
    """The timestamp of a text in any accepted form. Each form is told by its separators and put in
    ISO order as text, so that one cast reads them all and the generated code stays small."""
    text = F.trim(as_col(c))
    # keeps out the shorter forms that a cast also reads, such as a bare year
    iso = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    compact = (F.length(text) == 8) & (F.translate(text, "0123456789", "") == "")
    shaped = text.rlike("^[^-./ ]{0,2}[-./][^-./ ]*[-./][^-./ ]{4}( |$)")
    digits = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    found = F.when(iso, text).when(compact, digits).when(shaped, _arranged(text, day_first, whole))
    return found.try_cast("timestamp_ntz")


def iso_date(c: Column | str) -> Column:
    """The date of 'yyyy-MM-dd' with an optional time of day, of 'yyyyMMdd', or month first with
    '/', '-' or '.' between."""
    return _read(c, False, False).cast("date")


def mixed_date(c: Column | str) -> Column:
    """Month first, then day first, then ISO or compact: '03/04/2024' is March 4. Separators may be
    '/', '-' or '.'."""
    return _read(c, True, False).cast("date")


def mixed_timestamp(c: Column | str) -> Column:
    """As :func:`mixed_date`, with an optional time of day, of 24 hours or with AM or PM."""
    return _read(c, True, True).cast("timestamp")


def date_key(c: Column | str) -> Column:
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def year_month(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def year_span(start: Column | str, end: Column | str) -> Column:
    """Crossed year boundaries, not completed years."""
    return F.year(as_col(end)) - F.year(as_col(start))


def day_span(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))


def covered_days(start: Column | str, end: Column | str) -> Column:
    return day_span(start, end) + 1


def plausible_birthdate(column: str, as_of: dt.date) -> str:
    """The condition of a birthdate in the past and less than 120 years ago, as SQL text."""
    return f"({column} < DATE'{as_of}' AND {column} > add_months(DATE'{as_of}', -12 * 120))"


def active_on(today: Column, start: Column | str, end: Column | str) -> Column:
    return today.between(as_col(start), as_col(end)).cast("int")
