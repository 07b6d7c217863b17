"""The same raw load, file by file as they arrive: only new files since the last run are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import LEDGER_COLUMNS, LEDGER_TABLE, MANIFEST_SCHEMA, MANIFEST_TABLE, RAW, Entity
from shelfmark.sources.lake import Lake
from shelfmark.sources.landing import CSV_OPTIONS, next_load, read_from, to_raw


def _ledger(lake: Lake, entity: Entity, status: str) -> DataFrame | None:
    if not lake.exists(RAW, LEDGER_TABLE):
        return None
    files = lake.read(RAW, LEDGER_TABLE)
    return files.where((F.col("Entity_Name") == entity.entity) & (F.col("Load_Status") == status))


def _enter(lake: Lake, files: DataFrame, entity: Entity, load: Column, status: str, day: Column) -> None:
    """Append files (Batch_ID, Source_File, Row_Count) to the ledger."""
    told = {"Entity_Name": F.lit(entity.entity), "Load_Number": load, "Load_Status": F.lit(status), "Load_Day": day}
    lake.append(RAW, LEDGER_TABLE, files.withColumns(told).select(*LEDGER_COLUMNS), partition_by=["Load_Day"])


def _settle_interrupted(lake: Lake, entity: Entity) -> None:
    """Complete files that were started and not completed, if their rows are stored. The raw table is read
    for that only after a failure, and only for these files."""
    started = _ledger(lake, entity, "STARTED")
    if started is None:
        return
    finished = _ledger(lake, entity, "COMPLETED").select("Batch_ID")
    pending = started.join(finished, "Batch_ID", "left_anti")
    if pending.isEmpty() or not lake.exists(RAW, entity.table):
        return
    stored = lake.read(RAW, entity.table).groupBy("Batch_ID").agg(F.count(F.lit(1)).alias("Row_Count"))
    found = pending.drop("Row_Count").dropDuplicates(["Batch_ID"]).join(stored, "Batch_ID")
    _enter(lake, found.select("Batch_ID", "Source_File", "Row_Count", "Load_Number", "Load_Day"), entity, F.col("Load_Number"), "COMPLETED", F.col("Load_Day"))


def land_new_files(lake: Lake, folder: str, entity: Entity, checkpoint: str, loaded_at: dt.datetime, columns: list[str] | None = None):
    """Append files not seen before to the raw table, then stop.

    ``columns`` is the column order of the files, the entity's own order by default; a file whose
    header says otherwise fails the batch instead of being read in the wrong order. Each file is
    a batch of the raw table, known by its path, time and size, so a file that comes again, after a
    failure or with another checkpoint, is not stored twice, and any other file is stored.

    Files are entered in a ledger table by day, before their rows are stored and after, with their
    numbers of rows; each completed one has its manifest row. Known files are told by a join with the
    days of the ledger since the oldest file at hand was written. No list of files passes the driver."""
    spark: SparkSession = lake.spark
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (columns or entity.columns)])
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("multiLine", True).option("enforceSchema", False)
    files = reader.csv(folder)
    named = [F.col(f"_metadata.{x}").cast("string") for x in ("file_path", "file_modification_time", "file_size")]
    prefix = f"{entity.source.lower()}_{entity.entity}_stream_"
    files = files.withColumns(
        {
            "Source_File": read_from(),
            "Batch_ID": F.concat(F.lit(prefix), F.sha2(F.concat_ws("|", *named), 256)),
            "__written": F.to_date("_metadata.file_modification_time"),
        }
    )

    def append(rows: DataFrame, epoch: int) -> None:
        # the stream has a session of its own, with its own view of the table's files
        own = Lake(rows.sparkSession, lake.root, lake.prefix)
        started = dt.datetime.now()
        _settle_interrupted(own, entity)
        load = next_load(own, entity)
        # ids go by the files as they are read, before known ones are left out
        raw = to_raw(rows, entity, F.col("Batch_ID"), loaded_at, None, load)
        at_hand = rows.groupBy("Batch_ID", "Source_File", "__written").agg(F.count(F.lit(1)).alias("Row_Count"))
        done = _ledger(own, entity, "COMPLETED")
        if done is not None:
            # a file cannot have been landed before it was written
            oldest = at_hand.agg(F.min("__written")).first()[0]
            if oldest is not None:
                done = done.where(F.col("Load_Day") >= F.lit(oldest))
            at_hand = at_hand.join(done.select("Batch_ID"), "Batch_ID", "left_anti")
            raw = raw.join(done.select("Batch_ID"), "Batch_ID", "left_anti").select(*raw.columns)
        today = F.lit(max(loaded_at, started).date())
        at_hand = at_hand.drop("__written")
        _enter(own, at_hand.withColumn("Row_Count", F.lit(None).cast("bigint")), entity, F.lit(load), "STARTED", today)
        own.append(RAW, entity.table, raw)
        _enter(own, at_hand, entity, F.lit(load), "COMPLETED", today)
        ended = dt.datetime.now()
        completed = _ledger(own, entity, "COMPLETED").where((F.col("Load_Number") == load) & (F.col("Load_Day") == today))
        values = {
            "Load_Number": F.lit(load), "Batch_ID": F.col("Batch_ID"), "Source_System": F.lit(entity.source), "Entity_Name": F.lit(entity.entity),
            "Source_File": F.lit(entity.file), "Row_Count": F.col("Row_Count"), "Load_Start_TS": F.lit(started), "Load_End_TS": F.lit(ended),
            "Load_Status": F.lit("COMPLETED"), "Error_Message": F.lit(None), "Duration_Seconds": F.lit((ended - started).total_seconds()),
            "Created_TS": F.lit(ended),
        }
        manifest = completed.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields])
        own.append(RAW, MANIFEST_TABLE, manifest)

    query = (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    for table in (entity.table, MANIFEST_TABLE, LEDGER_TABLE):
        if lake.exists(RAW, table):
            spark.catalog.refreshTable(lake.name(RAW, table))
    return query
