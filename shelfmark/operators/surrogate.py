"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _SIZE, _BEFORE = "__bucket", "__size", "__before"


def hash_key(*natural_key: str) -> Column:
    """A key that needs no order and no shuffle; for facts."""
    return F.xxhash64(*natural_key)


def level_key(*natural_key: str) -> Column:
    """As :func:`hash_key`, where NULL is a value of its own: it stands for all values of a column, and
    two columns may hold it."""
    return F.xxhash64(*[x for k in natural_key for x in (F.col(k).isNull(), F.col(k))])


def dense_key(df: DataFrame, name: str, natural_key: Sequence[str], hex_digits: int = 3) -> DataFrame:
    """Keys 1..n without gaps, the same on every run, numbered inside digest buckets.

    ``natural_key`` is unique, so its digest spreads rows evenly over ``16 ** hex_digits``
    buckets; each bucket is numbered on its own and moved up by the rows of earlier buckets.
    Only the bucket sizes (at most ``16 ** hex_digits`` rows) meet in one task."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in natural_key])
    df = df.withColumn(_BUCKET, F.substring(F.md5(text), 1, hex_digits))
    sizes = df.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_SIZE))
    running = F.sum(_SIZE).over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(_BUCKET, F.coalesce(running, F.lit(0)).alias(_BEFORE))
    in_bucket = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*natural_key))
    # the broadcast side is bounded by the number of buckets, whatever the table size
    numbered = df.withColumn(name, in_bucket).join(F.broadcast(offsets), _BUCKET)
    return numbered.withColumn(name, F.col(name) + F.col(_BEFORE)).drop(_BUCKET, _BEFORE)


def lasting_key(df: DataFrame, name: str, natural_key: Sequence[str], known: DataFrame | None, hex_digits: int = 3) -> DataFrame:
    """The key map (natural key, ``name``) that a table's keys last by: ``known`` keys as they are, and
    natural keys of ``df`` that it lacks numbered on from its last one, without gaps.

    Store the result and pass it as ``known`` the next time."""
    natural = df.select(*natural_key).dropna().distinct()
    if known is None:
        return dense_key(natural, name, natural_key, hex_digits).select(*natural_key, F.col(name).cast("bigint").alias(name))
    unseen = natural.join(known.select(*natural_key), list(natural_key), "left_anti")
    last = F.coalesce(known.agg(F.max(name)).scalar(), F.lit(0))
    added = dense_key(unseen, name, natural_key, hex_digits)
    numbered = added.select(*natural_key, (F.col(name) + last).cast("bigint").alias(name))
    return known.select(*natural_key, F.col(name).cast("bigint").alias(name)).unionByName(numbered)
