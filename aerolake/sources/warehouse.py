"""Catalog tables of a lake that lasts between calls: parquet below one root, with a
declared schema, made once and then appended to."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import try_read


def required(schema: T.StructType) -> list[Column]:
    """The columns of ``schema`` in its order and types; a NULL in a NOT NULL
    column fails the write (parquet tables declare that, but do not check it)."""
    out = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            refuse = F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}"))
            value = F.coalesce(value, refuse.cast(f.dataType))
        out.append(value.alias(f.name))
    return out


class Warehouse:
    """Tables below ``root``.  The catalog database is named after the root, so
    every call (also in a new session, whose catalog is empty) finds its tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.db = "aerolake_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db}")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def name(self, table: str) -> str:
        return f"{self.db}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def create_if_absent(self, layer: str, table: str, schema: T.StructType,
                         partition_by: list[str] = (), bucket_by: list[str] = (),
                         buckets: int | None = None, comment: str = "") -> bool:
        """``CREATE TABLE IF NOT EXISTS`` with a fixed schema; gives whether it was
        made now.  A table that is there keeps its rows and its number of buckets
        (``buckets`` counts at its making: default, the shuffle partitions); one
        with other columns is an error.
        """
        full, path = self.name(table), self.path(layer, table)
        wanted = {"schema": json.loads(schema.json()), "partition_by": list(partition_by),
                  "bucket_by": list(bucket_by)}
        declared = f"{self.root}/_declared/{table}"
        found = try_read(self.spark, declared)
        made = found is None
        if made:
            buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            text = json.dumps({**wanted, "buckets": buckets})
            self.spark.createDataFrame([(text,)], "declaration string").coalesce(1).write.mode(
                "ignore").parquet(declared)
        else:
            stored = json.loads(found.first().declaration)
            buckets = stored.pop("buckets")
            if stored != wanted:
                raise ValueError(f"table {table} is declared otherwise: {stored}")
        if not self.spark.catalog.tableExists(full):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                f"{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
            parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
            by = f"CLUSTERED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS" if bucket_by else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet {parts} {by} "
                           f"LOCATION '{path}' COMMENT '{comment}'")
            # There are no files before the first append.
            if partition_by and try_read(self.spark, path, schema) is not None:
                self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        return made

    def schema(self, table: str) -> T.StructType:
        """The declared schema, with its NOT NULL columns."""
        stored = try_read(self.spark, f"{self.root}/_declared/{table}").first().declaration
        return T.StructType.fromJson(json.loads(stored)["schema"])

    def append(self, table: str, rows: DataFrame) -> int:
        """Append checked rows; gives their number."""
        checked = rows.select(*required(self.schema(table))).select(*self.table(table).columns)
        added = Observation()
        checked.observe(added, F.count(F.lit(1)).alias("n")).write.insertInto(self.name(table))
        self.spark.catalog.refreshTable(self.name(table))
        return int(added.get["n"])

    def replace(self, layer: str, table: str, rows: DataFrame, sort_by: list[str] = ()) -> None:
        """``CREATE OR REPLACE TABLE ... AS``; with ``sort_by`` the files hold the
        rows in that order."""
        full, path = self.name(table), self.path(layer, table)
        if sort_by:
            rows = rows.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        rows.write.mode("overwrite").parquet(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")
        self.expose(layer, table)

    def expose(self, layer: str, table: str, partitioned: bool = False) -> None:
        """Show what was written at a table's path in the catalog: first the table,
        then the files and partitions that were added to it."""
        full = self.name(table)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet "
                       f"LOCATION '{self.path(layer, table)}'")
        if partitioned:
            self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        self.spark.sql(f"REFRESH TABLE {full}")

    def analyze(self, table: str, columns: list[str] = ()) -> None:
        """Table and column statistics for the cost-based planner; of all columns
        unless some are named."""
        which = f"COLUMNS {', '.join(columns)}" if columns else "ALL COLUMNS"
        self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS FOR {which}")

    def in_file_order(self, table: str, number: str = "load_order") -> DataFrame:
        """A small table with the place of each row in its files, by name."""
        from pyspark.sql import Window

        rows = self.table(table).select("*", F.col("_metadata.file_name").alias("_file"),
                                        F.monotonically_increasing_id().alias("_row"))
        order = Window.orderBy("_file", "_row")
        return rows.withColumn(number, F.row_number().over(order)).drop("_file", "_row")
