"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _USABLE = "__rank", "__usable"


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column], usable: Column | None = None
) -> DataFrame:
    """The newest row of each key; NULL order values count as oldest.

    The rank filter becomes a group limit that keeps one row per key and task before the
    shuffle, so a key with very many rows sends few of them to its final task.

    With ``usable`` (a 0/1 column), other rows are passed over. They are ordered last and dropped
    at the end: a filter ahead of the ranking would be pushed below the columns it is computed
    from, and have every text parsed twice."""
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest_first]
    if usable is not None:
        df = df.withColumn(_USABLE, usable)
        order.insert(0, F.col(_USABLE).desc_nulls_last())
    window = Window.partitionBy(*keys).orderBy(*order)
    first = df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    return first if usable is None else first.filter(F.col(_USABLE) == 1).drop(_USABLE)
