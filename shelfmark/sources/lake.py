"""Layered tables: names, reads, appends and full-refresh writes."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.checks import VIOLATED, Check, violations
from shelfmark.schemas import LAYERS


class Lake:
    """Parquet tables under one shared root, one catalog database per layer.

    A refresh writes its files to a new folder first and only then points the catalog entry at
    them, so a failed build leaves the old table in place. A plain table with the same columns
    changes its location. A table with partitions or buckets is a view over the table of its newest
    build, and a refresh replaces the view. Both are one change of the catalog, so a reader sees the
    old build or the new one and never fails in between. A plain table whose columns change, or a
    name that held the other kind, is dropped and made anew.

    ``keep`` is how many builds of a table stay on disk; older ones are dropped after a refresh. By
    default all stay. Readers that started on a build need it until they end."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", keep: int | None = None):
        if keep is not None and keep < 1:
            raise ValueError("the newest build has to stay")
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.keep = keep

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create_layers(self, layers: Sequence[str] = LAYERS) -> None:
        for layer in layers:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)

    def stored_bytes(self, layer: str, table: str) -> int:
        """Size of the table's files, taken from the file listing."""
        name = self.name(layer, table)
        self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
        for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
            if row["col_name"] == "Statistics":
                return int(row["data_type"].split(" ")[0])
        return 0

    def count(self, layer: str, table: str) -> int:
        return self.read(layer, table).count()

    def refresh(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        bucket_by: tuple[int, str] | None = None,
    ) -> DataFrame:
        """Replace a table by ``df`` and return the stored table.

        ``bucket_by`` (buckets, column) stores the rows so that joins and groups by that column need
        no shuffle."""
        stamp = self._stamp()
        path = f"{self._folder(layer, table)}/{stamp}"
        if partition_by:
            # rebalance splits a partition value that holds much of the data over several files
            df = df.hint("rebalance", *partition_by)
        if bucket_by:
            # one task for each bucket, so that a bucket is one file
            df = df.repartition(*bucket_by)
        elif sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        name = self.name(layer, table)
        if not partition_by and not bucket_by:
            df.write.mode("errorifexists").parquet(path)
            self._point_at(name, path, df)
        else:
            build = f"{name}__{stamp}"
            if bucket_by:
                buckets, column = bucket_by
                writer = df.write.bucketBy(buckets, column).sortBy(column).option("path", path).format("parquet")
                writer.partitionBy(*partition_by).saveAsTable(build)
            else:
                df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
                self._create(build, path, df, partition_by)
            kind = self.spark.catalog.getTable(name).tableType if self.exists(layer, table) else None
            if kind not in (None, "VIEW"):
                self.spark.sql(f"DROP TABLE {name}")
            # CREATE OR REPLACE drops the view first, and readers would not find it for a moment
            change = "ALTER VIEW" if kind == "VIEW" else "CREATE OR REPLACE VIEW"
            self.spark.sql(f"{change} {name} AS SELECT * FROM {build}")
        self._drop_old(layer, table)
        return self.read(layer, table)

    def replace_partitions(
        self, layer: str, table: str, df: DataFrame, partition: str, touched: Sequence, sort_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the ``touched`` values of a partition column by the rows of ``df``, which has no others.

        Rows go to new folders, and each partition is pointed at its new one; other partitions are
        neither read nor written. A value without rows in ``df`` loses its partition."""
        if not self.exists(layer, table):
            return self.refresh(layer, table, df, [partition], sort_by)
        build = f"{self.database(layer)}.{self._builds(layer, table)[-1]}"
        path = f"{self._folder(layer, table)}/{self._stamp()}"
        ordered = df.hint("rebalance", partition).sortWithinPartitions(partition, *sort_by)
        ordered.write.mode("errorifexists").partitionBy(partition).parquet(path)
        written = set()
        if not self.spark.read.parquet(path).isEmpty():
            # no more rows than touched values
            written = {r[0] for r in self.spark.read.parquet(path).select(partition).distinct().collect()}
        for value in touched:
            where = f"PARTITION ({partition} = {value!r})"
            if value in written:
                folder = f"{path}/{partition}={value}"
                self.spark.sql(f"ALTER TABLE {build} ADD IF NOT EXISTS {where} LOCATION '{folder}'")
                self.spark.sql(f"ALTER TABLE {build} {where} SET LOCATION '{folder}'")
            else:
                self.spark.sql(f"ALTER TABLE {build} DROP IF EXISTS {where}")
        self.spark.catalog.refreshTable(build)
        self.spark.catalog.refreshTable(self.name(layer, table))
        return self.read(layer, table)

    def enforce(self, layer: str, table: str, df: DataFrame, checks: Sequence[Check], first: Sequence[str]) -> DataFrame:
        """Replace a table by the rows of ``df`` that meet all checks, and ``<table>_quarantine`` by the others,
        each with the rules it violates. The rows are computed and written once."""
        marked = violations(df, checks, first).withColumn("__rejected", (F.size(VIOLATED) > 0).cast("int"))
        path = f"{self._folder(layer, table)}/{self._stamp()}"
        marked.write.mode("errorifexists").partitionBy("__rejected").parquet(path)
        schema = marked.drop("__rejected").schema
        for kind, name, columns in ((0, table, df.columns), (1, f"{table}_quarantine", [*df.columns, VIOLATED])):
            part = f"{path}/__rejected={kind}"
            # a kind without rows has no folder; an empty write makes one
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(part)
            self._point_at(self.name(layer, name), part, self.spark.read.schema(schema).parquet(part).select(*columns))
        self._drop_old(layer, table)
        return self.read(layer, table)

    @staticmethod
    def _stamp() -> str:
        # sorts by time, also within a second
        return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:8]}"

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _builds(self, layer: str, table: str) -> list[str]:
        """Tables of the builds of a partitioned or bucketed table, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {self.database(layer)} LIKE '{table.lower()}__*'").collect()
        return sorted(r["tableName"] for r in found)

    def _create(self, name: str, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        # tables are external: dropping the name leaves the files of the older build
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitions} LOCATION '{path}'")
        if partition_by:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def _point_at(self, name: str, path: str, df: DataFrame) -> None:
        if self.spark.catalog.tableExists(name):
            is_view = self.spark.catalog.getTable(name).tableType == "VIEW"
            if not is_view and self.spark.table(name).dtypes == df.dtypes:
                # one change of the catalog entry: readers see the old files or the new ones
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                return
            self.spark.sql(f"DROP {'VIEW' if is_view else 'TABLE'} {name}")
        self._create(name, path, df)

    def _drop_old(self, layer: str, table: str) -> None:
        if self.keep is None:
            return
        for build in self._builds(layer, table)[: -self.keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database(layer)}.{build}")
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self._folder(layer, table))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # the folder of appended rows is not a build; month folders in use by the newest build stay
        names = sorted(f.getPath().getName() for f in files.listStatus(folder) if f.getPath().getName() != "appended")
        builds = self._builds(layer, table)
        oldest = builds[0].split("__")[-1] if builds else names[-self.keep :][0]
        for name in names:
            if name < oldest:
                files.delete(jvm.org.apache.hadoop.fs.Path(folder, name), True)

    def append(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.mode("append").format("parquet").partitionBy(*partition_by)
        if not self.exists(layer, table):
            writer = writer.option("path", f"{self._folder(layer, table)}/appended")
        writer.saveAsTable(self.name(layer, table))

    def truncate_and_load(self, layer: str, table: str, df: DataFrame) -> None:
        self.refresh(layer, table, df)
