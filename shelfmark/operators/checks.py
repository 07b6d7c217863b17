"""Declarative table checks: not null, unique, accepted values, expression holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str
    target: str
    fails: Column | None = None
    keys: tuple[str, ...] = ()
    only_if: Column | None = None

    @property
    def label(self) -> str:
        return f"{self.kind}({self.target})"


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c, F.col(c).isNull()) for c in columns]


def accepted(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, F.col(column).isNotNull() & ~F.col(column).isin(*values))


def holds(expression: str) -> Check:
    """A rule over a row; NULL counts as passed, as in a table constraint."""
    return Check("expression_is_true", expression, ~F.expr(expression))


def unique(*columns: str, only_if: str | None = None) -> Check:
    label = ", ".join(columns) + (f" where {only_if}" if only_if else "")
    return Check("unique", label, keys=columns, only_if=F.expr(only_if) if only_if else None)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """(Table_Name, Check_Name, Failures) per check.

    All row rules share one scan and one partial aggregate; each uniqueness rule adds a
    grouped count, summed on the map side first."""
    row_rules = [c for c in checks if c.fails is not None]
    parts: list[DataFrame] = []
    if row_rules:
        counts = df.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(row_rules)])
        cells = [F.struct(F.lit(c.label).alias("Check_Name"), F.col(f"c{i}").alias("Failures")) for i, c in enumerate(row_rules)]
        parts.append(counts.select(F.inline(F.array(*cells))))
    for c in checks:
        if c.keys:
            rows = df if c.only_if is None else df.filter(c.only_if)
            present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in c.keys])
            repeated = rows.filter(present).groupBy(*c.keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            parts.append(repeated.agg(F.count(F.lit(1)).alias("Failures")).select(F.lit(c.label).alias("Check_Name"), "Failures"))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(table).alias("Table_Name"), "Check_Name", "Failures")


VIOLATED = "Violated_Rules"


def violations(df: DataFrame, checks: Sequence[Check], first: Sequence[Column | str]) -> DataFrame:
    """``df`` with the labels of the rules that each row violates.

    Row rules are told row by row. Of the rows of a key that has to be unique, the one that comes first
    by ``first`` keeps the key and the others violate the rule; only rows that meet all row rules
    compete, so a key is not lost to a row that is turned away anyway. Rows without a key have no
    rule to violate."""
    labels = [F.when(c.fails, F.lit(c.label)) for c in checks if c.fails is not None]
    none = F.expr("cast(array() as array<string>)")
    marked = df.withColumn(VIOLATED, F.array_compact(F.array(*labels)) if labels else none)
    for i, check in enumerate(c for c in checks if c.keys):
        bound = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in check.keys])
        if check.only_if is not None:
            bound = bound & F.coalesce(check.only_if, F.lit(False))
        competes = f"__competes_{i}"
        marked = marked.withColumn(competes, bound & (F.size(VIOLATED) == 0))
        # other rows are dealt by a hash of the whole row, so that missing keys gather nowhere
        spread = F.when(~F.col(competes), F.xxhash64(*[F.col(c) for c in df.columns]))
        order = Window.partitionBy(competes, spread, *[F.when(F.col(competes), F.col(k)) for k in check.keys]).orderBy(*first)
        again = F.col(competes) & (F.row_number().over(order) > 1)
        marked = marked.withColumn(VIOLATED, F.when(again, F.array_append(VIOLATED, F.lit(check.label))).otherwise(F.col(VIOLATED)))
        marked = marked.drop(competes)
    return marked


def accepted_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(VIOLATED) == 0).drop(VIOLATED)


def rejected_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(VIOLATED) > 0)
