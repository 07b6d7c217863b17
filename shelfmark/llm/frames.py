"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a local session (tests) may go
    without one and gets a temporary folder: elsewhere executors could not read the driver's."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="shelfmark-")


#: has the shuffle files of a job deleted at its end, not when the JVM next collects what named them
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Store `df` in the shared checkpoint folder, so that its lineage ends there. What was shuffled for it
    is not read again and leaves the disks."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        # a frame takes the setting when it is made, and `df` may be run again by its owner
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEAN_UP, before)


def _packed_batches(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches, column, 8 << 20):
        packed = [None if t is None else press.compress(t.encode()) for t in batch.column(column).to_pylist()]
        at = batch.schema.names.index(column)
        yield batch.set_column(at, column, pa.array(packed, pa.binary()))


def packed(df: DataFrame, column: str = "text") -> DataFrame:
    """`df` with a text column compressed, for a shuffle that moves whole texts."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == column else f.dataType, True) for f in df.schema])
    return df.mapInArrow(lambda b: _packed_batches(b, column), schema)


def unpacked(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Batches of a packed table, cut at `most` bytes of text as their frames tell it, each with its texts;
    a longer text is a batch of its own."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for batch in batches:
        frames = batch.column(column).to_pylist()
        sizes = [0 if x is None else zstandard.frame_content_size(x) for x in frames]
        start = total = 0
        for i, size in enumerate([*sizes, most + 1]):
            if i > start and total + size > most:
                yield batch.slice(start, i - start), [None if x is None else press.decompress(x) for x in frames[start:i]]
                start, total = i, 0
            total += size


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(df: DataFrame, name: str = "text"):
    """The text with null as the empty string."""
    return F.coalesce(df[name], F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of one column; a longer value is a batch of its own."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


__all__ = ["cut", "free_name", "packed", "shared_folder", "slices", "table", "text_column", "unpacked"]
