"""Quality rules as data: 0/1 flags, a validity gate and a weighted score.

Conditions are SQL text over the columns of the frame they are applied to."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A flag column. ``weight`` counts towards the score, ``gate`` towards validity."""

    name: str
    holds: str
    weight: int = 0
    gate: bool = False


def as_flag(condition: str) -> str:
    """1 where the condition holds, 0 where it fails or cannot be told."""
    return f"CAST(coalesce({condition}, false) AS INT)"


def has_text(column: str) -> str:
    return f"length(rtrim({column})) > 0"


def known(column: str) -> str:
    return f"{column} IS NOT NULL"


def optional(column: str, condition: str) -> str:
    """NULL is fine, a value has to meet the condition."""
    return f"({column} IS NULL OR {condition})"


def one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def all_set(flags: Iterable[str]) -> Column:
    return F.expr(as_flag(" AND ".join(f"{f} = 1" for f in flags)))


def apply_rules(df: DataFrame, rules: Sequence[Rule], validity: str = "DQ_Is_Valid") -> DataFrame:
    """Add every flag, and the validity column over the gates."""
    gates = " AND ".join(f"({r.holds})" for r in rules if r.gate)
    flags = [f"{as_flag(r.holds)} AS {r.name}" for r in rules]
    return df.selectExpr("*", *flags, f"{as_flag(gates)} AS {validity}")


def score(rules: Sequence[Rule]) -> Column:
    """Weighted sum of the flag columns, 0 to 100."""
    return F.expr(" + ".join(f"{r.name} * {r.weight}" for r in rules if r.weight))


def flagged_rows(df: DataFrame, flag: str, *columns: str | Column) -> DataFrame:
    """``columns`` of the rows whose ``flag`` is 1.

    For flags that are computed in the same plan: a filter would be pushed below the columns that its
    flag comes from, and its condition would repeat their whole parsing for each rule. Rows
    are unfolded from a one-row or missing array instead, which stays above them."""
    return df.select(F.inline(F.when(F.col(flag) == 1, F.array(F.struct(*columns)))))
