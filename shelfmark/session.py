"""Session settings the plans rely on. All are runtime SQL settings, so an existing
cluster session can be tuned in place."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins carry no broadcast hints on tables: Spark broadcasts a side only when its measured
# size is below the thresholds here, and otherwise shuffles both sides and splits skewed
# partitions. forceOptimizeSkewedJoin keeps that split even where a following aggregate
# reuses the join's partitioning. The JVM never compiles methods above 8,000 bytes; a stage whose
# generated method is longer runs faster by operators that are compiled one by one.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Only a new session can take these. Recording the caller of every column expression doubles
# the time to build a wide plan.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# stored (compressed) bytes per shuffle partition
PARTITION_BYTES = 64 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def fit_shuffle(spark: SparkSession, largest_table_bytes: int) -> int:
    """Start shuffles with enough partitions for the largest stored table.

    Adaptive execution merges partitions that turn out small, but never splits an ordinary
    shuffle that was started with too few."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(base, largest_table_bytes // PARTITION_BYTES + 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


# What one task may be given. The sorts and hash tables of a task take some 25 times the stored bytes that it
# scans (silver lines) and some 50 times the shuffled bytes that it reads (monthly sums at four levels); at
# Spark's own 128 and 64 MB that is 3 GB.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 8 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 * 1024 * 1024,
}
# columnar input per shuffle partition; its rows are some five times larger when they are shuffled as text
INPUT_BYTES = 2 * 1024 * 1024
_UNITS = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def _bytes(size: str) -> int:
    """The bytes of a setting such as '64MB', '8m' or '134217728b'."""
    number = size.strip().lower().removesuffix("b") or "0"
    return int(number[:-1]) * _UNITS[number[-1]] if number[-1] in _UNITS else int(number)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files of some tables, from their listing; no content is read."""
    files = spark.read.format("binaryFile").load(list(paths)).select("length")
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def bound_tasks(spark: SparkSession, largest_input_bytes: int) -> int:
    """Have the number of tasks grow with the input, so that what a task holds does not.

    Settings are only lowered. Adaptive execution merges partitions up to the size set here; more of
    them than the session starts with are asked for where the input needs them."""
    for name, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    partitions = largest_input_bytes // INPUT_BYTES + 1
    if partitions > int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(initial, str(partitions))
    return partitions


# has the shuffle files of a job deleted at its end, not when the JVM next collects what named them
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """Frames made within are run once: what was shuffled for them leaves the disks with their job."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def stored(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``df``, written once and read from files: for a plan that is needed in several jobs.

    A plan over files no longer tells the steps before them which columns it leaves out. Where only some
    ``columns`` are read later, no others are shuffled and written; the frame keeps them all, but a job that
    does read one of the others fails.

    The folder is below spark.checkpoint.dir or the warehouse, which all executors share."""
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        local = spark.sparkContext.master.startswith("local")
        shared = tempfile.mkdtemp(prefix="shelfmark-") if local else spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    kept = set(df.columns if columns is None else columns)
    with run_once(spark):
        df.select(*[c for c in df.columns if c in kept]).write.option("compression", "zstd").parquet(folder)
    found = spark.read.parquet(folder)
    return found.select(
        *[
            F.col(f.name) if f.name in kept else F.raise_error(F.lit(f"{f.name} is not among the stored {name}")).cast(f.dataType).alias(f.name)
            for f in df.schema
        ]
    )


def local_session(cpus: int | str = "*", app: str = "shelfmark", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    shuffle = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle))
    )
    for name, value in {**START_SETTINGS, **RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
