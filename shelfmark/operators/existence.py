"""Does a key exist in another table? As a 0/1 column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.salting import HOT_ROWS, salted_join

_HIT, _REF, _KEY = "__hit", "__ref", "__key"


def flag_existing(
    df: DataFrame,
    key: str,
    reference: DataFrame,
    flag: str,
    reference_key: str | None = None,
    reference_is_unique: bool = False,
    null_passes: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``flag`` = 1 where ``key`` occurs in ``reference``.

    A reference that holds each key once is joined as it is: Spark broadcasts it when it is
    small, and splits a hot key of ``df`` at run time when it is not. A reference with repeated
    keys is reduced to its distinct keys first and joined with salts for hot keys. With ``null_passes`` a
    missing key counts as found; such rows are often the most, so they join under made-up keys
    that spread them."""
    keys = reference.select(F.col(reference_key or key).alias(_REF)).filter(F.col(_REF).isNotNull())
    join_key: Column = F.col(key)
    if null_passes:
        spread = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
        join_key = F.coalesce(F.col(key).cast("string"), spread)
    keyed = df.withColumn(_KEY, join_key)
    if reference_is_unique:
        joined = keyed.join(keys.withColumn(_HIT, F.lit(1)), F.col(_KEY) == F.col(_REF), "left")
    else:
        joined = salted_join(keyed, keys.distinct().withColumn(_HIT, F.lit(1)), [(_KEY, _REF)], "left", hot_rows)
    found: Column = F.coalesce(F.col(_HIT), F.lit(0))
    if null_passes:
        found = F.when(F.col(key).isNull(), F.lit(1)).otherwise(found)
    return joined.withColumn(flag, found).drop(_HIT, _REF, _KEY)
