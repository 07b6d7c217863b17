"""Joins whose lookup side hides a hot key from the run-time skew split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of one key that a single task can take
HOT_ROWS = 1_000_000
# keys that are spread, the hottest first; no other key has more than one row in so many
MOST_HOT = 10_000

_SALT, _COPY, _SALTS = "__salt", "__copy", "__salts"


def row_bucket(df: DataFrame, buckets: Column) -> Column:
    """A bucket number from the whole row: the same on a retried task, even over one key's rows."""
    return F.pmod(F.hash(*[F.col(c) for c in df.columns]), buckets)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """(keys, __salts) of the keys that hold more than ``hot_rows`` rows, ``most`` of them at most: one salt
    for each ``hot_rows`` rows. Rows are counted before they are shuffled."""
    counts = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hottest = counts.where(F.col("__rows") > hot_rows).orderBy(F.desc("__rows"), *keys).limit(most)
    return hottest.select(*keys, F.ceil(F.col("__rows") / hot_rows).cast("int").alias(_SALTS))


def _salted(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """``df`` with the number of salts of its key, one where the key is not hot."""
    # A table joined to a list that turns out empty counts as 0 bytes, and adaptive execution would broadcast it
    # whole, whatever its size. So the list has a row for missing keys, which never are hot.
    none = df.sparkSession.range(1).select(*[F.lit(1 if f.name == _SALTS else None).cast(f.dataType).alias(f.name) for f in hot.schema])
    named = hot.union(none).toDF(*[f"__hot_{i}" for i in range(len(keys))], _SALTS)
    # bounded by the number of keys that are spread
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__hot_{i}")) for i, k in enumerate(keys)])
    joined = df.join(F.broadcast(named), same, "left")
    return joined.select(*df.columns, F.coalesce(_SALTS, F.lit(1)).alias(_SALTS))


def copied_lookup(lookup: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """The lookup with ``__copy``: rows of hot keys once for each salt, all others once."""
    salted = _salted(lookup, keys, hot)
    return salted.withColumn(_COPY, F.explode(F.sequence(F.lit(0), F.col(_SALTS) - 1))).drop(_SALTS)


def salted_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    most: int = MOST_HOT,
) -> DataFrame:
    """Join ``df`` to a lookup with one row per key, the rows of hot keys spread over several tasks.

    Skewed partitions are split at run time only where both sides of a join come straight from
    a shuffle. A lookup that is itself an aggregate or window is not. Here the keys of ``df`` are
    counted first; only rows of keys above ``hot_rows`` get a salt, and only their rows of the lookup
    are copied, so the copies grow with the hot keys and not with the tables."""
    keys = [left for left, _ in on]
    hot = hot_keys(df, keys, hot_rows, most)
    copies = copied_lookup(lookup, [right for _, right in on], hot)
    spread = _salted(df, keys, hot)
    spread = spread.withColumn(_SALT, row_bucket(df, F.col(_SALTS))).drop(_SALTS)
    match = [F.col(left) == F.col(right) for left, right in on] + [F.col(_SALT) == F.col(_COPY)]
    return spread.join(copies, reduce(and_, match), how).drop(_SALT, _COPY)
