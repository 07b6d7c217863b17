"""Overlapping date ranges, counted without building the pairs.

Two ranges are disjoint exactly when one ends before the other starts, so overlaps follow from
running counts of starts and ends per day. Rows are summed per day before anything is ordered;
an ordered partition is therefore never longer than the calendar, however many ranges share a
group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.salting import salted_join


def _per_day(df: DataFrame, group: Sequence[str], start: str, end: str, usable: Column | None = None) -> DataFrame:
    """Starts and ends per group and day, of the ``usable`` rows.

    Other rows get no days instead of being filtered: a filter would be pushed below the columns it
    is computed from, and have every text parsed twice."""
    days = F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
        F.struct(F.col(end).alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
    )
    edges = df.select(*group, F.inline_outer(days if usable is None else F.when(usable, days))).filter("day IS NOT NULL")
    return edges.groupBy(*group, "day").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))


def _running(per_day: DataFrame, group: Sequence[str]) -> DataFrame:
    """The counts up to each day."""
    ordered = Window.partitionBy(*group).orderBy("day")
    return per_day.withColumns(
        {
            "started": F.sum("starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
            "ended_before": F.coalesce(
                F.sum("ends").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )


def _pairs(days: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    rows = F.sum("starts").cast("decimal(38,0)")
    disjoint = F.sum((F.col("starts") * F.col("ended_before")).cast("decimal(38,0)"))
    pairs = F.floor(rows * (rows - 1) / 2) - disjoint
    return days.groupBy(*group).agg(pairs.cast("bigint").alias(name))


def pairs_per_group(df: DataFrame, group: Sequence[str], start: str, end: str, name: str = "pairs") -> DataFrame:
    """Overlapping pairs of each group: all pairs less the disjoint ones."""
    return _pairs(_running(_per_day(df, group, start, end), group), group, name)


def count_overlapping_pairs(df: DataFrame, item: str, start: str, end: str, name: str = "Overlapping_Pairs", usable: Column | None = None) -> DataFrame:
    """Pairs of rows with different items and overlapping ranges, as a one-row frame.

    Ranges have start <= end; with ``usable`` only rows where it holds count. Pairs of rows of one item are counted apart and taken off; both counts
    come from one sum per item and day, which is shuffled once."""
    counts = F.col(start) <= F.col(end)
    by_item = _per_day(df, [item], start, end, counts if usable is None else counts & usable)
    by_day = by_item.groupBy(F.lit(1).alias("__all"), "day").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    everything = _pairs(_running(by_day, ["__all"]), ["__all"], "n").select("n")
    same_item = _pairs(_running(by_item, [item]), [item], "n").select((-F.col("n")).alias("n"))
    return everything.unionByName(same_item).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(name))


def overlap_degree(df: DataFrame, group: Sequence[str], start: str, end: str, name: str = "Overlapping_Others") -> DataFrame:
    """For each row, how many other rows of its group overlap it."""
    days = _running(_per_day(df, group, start, end), group)
    at_end = days.select(*[F.col(g).alias(f"e_{g}") for g in group], F.col("day").alias("e_day"), "started")
    at_start = days.select(*[F.col(g).alias(f"s_{g}") for g in group], F.col("day").alias("s_day"), "ended_before")
    met = salted_join(df, at_end, [(g, f"e_{g}") for g in group] + [(end, "e_day")])
    met = salted_join(met, at_start, [(g, f"s_{g}") for g in group] + [(start, "s_day")])
    others = (F.col("started") - F.col("ended_before") - 1).cast("bigint")
    return met.select(*df.columns, others.alias(name))
