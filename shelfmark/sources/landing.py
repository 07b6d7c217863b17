"""Files to raw tables, with lineage columns and a load manifest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import ENTITIES, ENTITY_BY_FILE, LEDGER_TABLE, MANIFEST_SCHEMA, MANIFEST_TABLE, RAW, Entity
from shelfmark.sources.lake import Lake

# Texts that a file reader takes for a missing value.
TEXT_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)

# Quotes are doubled inside quoted text, which may hold line breaks. A record with another number
# of fields than the header fails the load; nothing of it is stored.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}
# names of files with line breaks inside quotes that are listed; beyond it all files are read whole
MOST_LISTED = 1000
# a row id is the load number and 45 bits of place: partition and row in it
PLACE_BITS = 45
MOST_LOADS = 1 << (63 - PLACE_BITS)


def batch_id(source: str, entity: str, at: dt.datetime) -> str:
    return f"{source.lower()}_{entity}_{at:%Y%m%d_%H%M%S}"


def entity_for(file_name: str) -> Entity:
    try:
        return ENTITY_BY_FILE[file_name]
    except KeyError:
        raise KeyError(f"no table mapping for file {file_name!r}") from None


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a headered file, or of a folder of files with the same header; reads the first
    record only."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", False).csv(path).columns


def read_from() -> Column:
    """The name of the file that a row was read from. It comes written as in an address, with spaces encoded."""
    name = F.col("_metadata.file_name")
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def files_with_open_quotes(spark: SparkSession, path: str, most: int = MOST_LISTED) -> list[str] | None:
    """Paths of the files that have a line with an odd number of quotes, as a record with a line break
    inside quotes has; None if they are more than ``most``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.where(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("path")).distinct()
    found = [r["path"] for r in odd.limit(most + 1).collect()]
    return found if len(found) <= most else None


def read_csv_text(spark: SparkSession, path: str, entity: Entity, names: Iterable[str] | None = None, most: int = MOST_LISTED) -> DataFrame:
    """A headered CSV as text columns of the entity, whatever the column order in the file.

    ``path`` is a file, a folder or a pattern of part files with the same header. Files are split
    between tasks; only those with a line break inside quotes, told by a first pass over their
    lines, are read by one task each."""
    present = list(names) if names is not None else header_columns(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in present])
    # a part file with its columns in another order fails instead of being read wrongly
    def reader(whole: bool) -> DataFrameReader:
        return spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", False).option("multiLine", whole)

    broken = files_with_open_quotes(spark, path, most)
    named = read_from().alias("Source_File")
    if broken is None:
        df = reader(True).csv(path).select("*", named)
    elif broken:
        split = reader(False).csv(path).where(~F.col("_metadata.file_path").isin(broken)).select("*", named)
        # the names are written as in an address, with spaces encoded
        paths = [unquote(p) for p in broken]
        df = split.unionAll(reader(True).csv(paths).select("*", named))
    else:
        df = reader(False).csv(path).select("*", named)
    columns = {c.lower() for c in present}
    for alias, column in entity.aliases:
        if alias in present and column not in present:
            df = df.withColumnRenamed(alias, column)
    missing = [c for c in entity.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: columns {missing} not found")
    if "source_file" in columns:
        # the file's own column of that name goes; the last one is where the row was read
        df = df.toDF(*[f"__own_{i}" if c.lower() == "source_file" and i < len(df.columns) - 1 else c for i, c in enumerate(df.columns)])
    return df


def text_nulls_removed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*TEXT_NULLS), F.col(c)) for c in columns})


def row_id(load: int, partitions: int) -> Column:
    """Load number and place, as one number that grows with the loads and, inside a load, with the order
    of the rows. Bits of the place go to the partitions as they need them, the rest to the rows."""
    if not 0 <= load < MOST_LOADS:
        raise OverflowError(f"load number {load} of an entity")
    row_bits = PLACE_BITS - max(partitions - 1, 0).bit_length()
    place = F.monotonically_increasing_id()
    nth, part = place.bitwiseAND((1 << 33) - 1), F.shiftright(place, 33)
    found = F.lit(load << PLACE_BITS) + F.shiftleft(part, row_bits) + nth
    fits = (nth < F.lit(1 << row_bits)) & (part < F.lit(max(partitions, 1)))
    return F.when(fits, found).otherwise(F.raise_error(F.lit("too many rows in one task for their ids")).cast("bigint"))


def to_raw(df: DataFrame, entity: Entity, batch: str | Column, loaded_at: dt.datetime, file_name: str | None = None, load: int = 0) -> DataFrame:
    """Raw rows of one load: text columns, lineage, and an id that grows with the file order."""
    if file_name:
        df = df.withColumn("Source_File", F.lit(file_name))
    df = text_nulls_removed(df, entity.columns)
    return df.select(
        row_id(load, df.rdd.getNumPartitions()).alias("Raw_ID"),
        *entity.columns,
        F.lit(batch).alias("Batch_ID"),
        "Source_File",
        F.lit(f"{loaded_at:%Y-%m-%d %H:%M:%S}").cast("timestamp").alias("Load_Timestamp"),
    )


def next_load(lake: Lake, entity: Entity) -> int:
    """The number of an entity's next load, from the manifest and the ledger of streamed files; the raw
    table is not read."""
    last = 0
    for table in (MANIFEST_TABLE, LEDGER_TABLE):
        if lake.exists(RAW, table):
            loads = lake.read(RAW, table).where(F.col("Entity_Name") == entity.entity)
            last = max(last, loads.agg(F.max("Load_Number")).first()[0] or 0)
    return last + 1


def manifest_row(spark: SparkSession, entity: Entity, batch: str, rows: int, start, end, status: str, error: str | None, load: int = 0):
    seconds = None if end is None else (end - start).total_seconds()
    row = (load, batch, entity.source, entity.entity, entity.file, rows, start, end, status, error, seconds, end or start)
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def load_file(lake: Lake, path: str, entity: Entity, loaded_at: dt.datetime, truncate: bool = False) -> bool:
    """Load a file, or a folder or pattern of part files, into the entity's raw table; the outcome goes to
    the manifest, not to the caller's stack."""
    spark = lake.spark
    batch = batch_id(entity.source, entity.entity, loaded_at)
    started = dt.datetime.now()
    load = next_load(lake, entity)
    lake.append(RAW, MANIFEST_TABLE, manifest_row(spark, entity, batch, 0, started, None, "STARTED", None, load))
    try:
        seen = Observation()
        raw = to_raw(read_csv_text(spark, path, entity), entity, batch, loaded_at, None, load)
        raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
        if truncate:
            lake.truncate_and_load(RAW, entity.table, raw)
        else:
            lake.append(RAW, entity.table, raw)
        status, rows, error = "COMPLETED", seen.get["rows"], None
    except Exception as problem:  # any failed load is reported, the other files go on
        status, rows, error = "FAILED", 0, str(problem)
    row = manifest_row(spark, entity, batch, rows, started, dt.datetime.now(), status, error, load)
    lake.append(RAW, MANIFEST_TABLE, row)
    return status == "COMPLETED"


def load_all(lake: Lake, folder: str, loaded_at: dt.datetime, truncate: bool = False, files: Mapping[str, str] | None = None) -> dict[str, bool]:
    """Load every mapped file of a folder (or the given file -> path map). A folder of part files may stand
    in place of a file, under the same name."""
    paths = files or {e.file: f"{folder.rstrip('/')}/{e.file}" for e in ENTITIES.values()}
    return {name: load_file(lake, path, entity_for(name), loaded_at, truncate) for name, path in paths.items()}


def manifest_status(manifest: DataFrame) -> DataFrame:
    """One row per batch with its last known state and duration, newest first."""
    # batch ids tell seconds apart, load numbers the loads of a second
    last = manifest.groupBy("Batch_ID", "Load_Number").agg(
        F.max_by(
            F.struct("Source_System", "Entity_Name", "Row_Count", "Load_Status", "Load_End_TS", "Load_Start_TS"),
            F.struct(F.col("Load_End_TS").isNotNull(), F.col("Load_End_TS")),
        ).alias("last")
    )
    seconds = F.unix_timestamp("Load_End_TS") - F.unix_timestamp("Load_Start_TS")
    return (
        last.select("Batch_ID", "Load_Number", "last.*")
        .select(
            "Source_System", "Entity_Name", "Batch_ID", "Load_Number", "Row_Count", "Load_Status",
            seconds.alias("Duration_Seconds"), "Load_Start_TS",
        )
        .orderBy(F.desc("Load_Start_TS"), "Batch_ID", F.desc("Load_Number"))
    )
