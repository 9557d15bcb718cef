"""Versioned Parquet tables. A version's log entry, created exclusively, is its commit; it lists the folders that make up
the table, so appends copy nothing, and names the (application, batch) that wrote it, so a repeated batch is skipped."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def read_text(self, name: str) -> str | None:
        at = self._path(f"{self.root}/{name}")
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, name: str, text: str, overwrite: bool = True) -> None:
        stream = self._fs.create(self._path(f"{self.root}/{name}"), overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def log(self, table: str) -> list[dict]:
        at = self._path(f"{self.root}/{table}/_log")
        if not self._fs.exists(at):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.getPath().getName().endswith(".json"))
        return [json.loads(self.read_text(f"{table}/_log/{n}")) for n in names]

    def exists(self, table: str) -> bool:
        return bool(self.log(table))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        entry = [e for e in self.log(table) if version is None or e["version"] <= version][-1]
        return self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(*[f"{self.root}/{table}/{f}" for f in entry["folders"]])

    def written(self, table: str, app: str, batch: int) -> bool:
        """Whether this application's batch is in the table."""
        return any(e["app"] == app and e["batch"] == batch for e in self.log(table))

    def view(self, table: str, name: str | None = None) -> DataFrame:
        """The table, also as a temporary view for SQL, by its own name if no other is given."""
        df = self.read(table)
        df.createOrReplaceTempView(name or table)
        return df

    def create_as(self, table: str, sql: str, views: tuple[str, ...] = ()) -> DataFrame:
        """Creates or replaces a table from a query over views of other tables; returns it as a view of its name."""
        for v in views:
            self.view(v)
        self.write(table, self.spark.sql(sql))
        return self.view(table)

    def cluster(self, table: str, key: str, files: int) -> DataFrame:
        """Rewrites a table into `files` files by ranges of key, sorted inside, as a new version; rows don't change."""
        self.write(table, self.read(table).repartitionByRange(files, key).sortWithinPartitions(key))
        return self.read(table)

    def write(self, table: str, df: DataFrame, append: bool = False, app: str | None = None, batch: int | None = None) -> bool:
        """Commits a new version; False, and nothing written, if this application's batch is there already."""
        log = self.log(table)
        if app is not None and self.written(table, app, batch):
            return False
        version = len(log) + 1
        folder = f"v={version}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/{table}/{folder}")
        folders = (log[-1]["folders"] if append and log else []) + [folder]
        entry = {"version": version, "app": app, "batch": batch, "folders": folders, "schema": json.loads(df.schema.json())}
        self.write_text(f"{table}/_log/{version:09d}.json", json.dumps(entry), overwrite=False)
        return True
