"""Versioned dimension history out of repeated loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.dedupe import keep_latest


def version_history(
    df: DataFrame,
    key: str,
    effective: str,
    tracked: Sequence[str],
    newest_first: Sequence[str],
    usable: Column | None = None,
) -> DataFrame:
    """A row for each change of the ``tracked`` columns, with its period and version number.

    Several rows of a key on one day count as the newest of them, which also bounds the rows a
    key brings to the ordered step by the number of days."""
    daily = keep_latest(df, [key, effective], newest_first, usable)
    ordered = Window.partitionBy(key).orderBy(effective)
    now = F.struct(*tracked)
    changes = (
        daily.withColumn("__before", F.lag(now).over(ordered))
        .filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(now))
        .drop("__before")
    )
    following = F.lead(effective).over(ordered)
    return changes.withColumns(
        {
            "Effective_From": F.col(effective),
            "Effective_To": F.date_sub(following, 1),
            "Is_Current": following.isNull().cast("int"),
            "Version_Number": F.row_number().over(ordered),
        }
    )


PERIOD = ("Effective_From", "Effective_To", "Is_Current", "Version_Number")


def merge_versions(
    stored: DataFrame,
    load: DataFrame,
    key: str,
    effective: str,
    tracked: Sequence[str],
    newest_first: Sequence[str],
    usable: Column | None = None,
) -> DataFrame:
    """The history after one new load: (key, tracked, period) of all versions.

    Only the open version of a key meets the load. Where the load differs from it, the open version
    is closed the day before and new ones follow, numbered on; other versions pass as they are. Rows of
    the load are in force no earlier than the open version of their key; earlier ones are left out, as
    a closed period is not rewritten. A row of the same day as the open version replaces it."""
    daily = keep_latest(load, [key, effective], newest_first, usable)
    new = daily.select(key, *tracked, F.col(effective).alias("Effective_From"), F.lit(False).alias("__old"), F.lit(0).alias("__base"))
    open_ = stored.filter("Is_Current = 1")
    touched = new.select(key).distinct()
    opened = open_.join(touched, key, "left_semi").select(
        key, *tracked, "Effective_From", F.lit(True).alias("__old"), (F.col("Version_Number") - 1).alias("__base")
    )
    # a key's rows are its open version and at most one row a day of the load
    whole = Window.partitionBy(key)
    ordered = whole.orderBy("Effective_From", F.desc("__old"))
    both = opened.unionByName(new)
    both = both.withColumns(
        {"__start": F.max(F.when(F.col("__old"), F.col("Effective_From"))).over(whole), "__base": F.max("__base").over(whole)}
    ).filter("__start IS NULL OR Effective_From >= __start")
    # of two rows of a day the load's counts
    both = both.withColumn("__next", F.lead("Effective_From").over(ordered)).filter("__next IS NULL OR __next > Effective_From")
    now = F.struct(*tracked)
    changes = (
        both.withColumn("__before", F.lag(now).over(ordered))
        .filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(now))
        .drop("__before")
    )
    following = F.lead("Effective_From").over(ordered)
    merged = changes.select(
        key,
        *tracked,
        "Effective_From",
        F.date_sub(following, 1).alias("Effective_To"),
        following.isNull().cast("int").alias("Is_Current"),
        (F.col("__base") + F.row_number().over(ordered)).cast("int").alias("Version_Number"),
    )
    columns = [key, *tracked, *PERIOD]
    closed = stored.filter("Is_Current = 0").select(*columns)
    untouched = open_.join(touched, key, "left_anti").select(*columns)
    return closed.unionByName(untouched).unionByName(merged.select(*columns))
