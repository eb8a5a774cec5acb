"""Parquet table access."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# The driver tables this library maps onto lake roles.
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


class Tables:
    """Lazy parquet reader over one directory of ``{name}.parquet`` tables.

    Reading is lazy: Catalyst prunes columns and pushes filters into each
    scan, so selecting two columns reads two column chunks.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self(name)
        raise AttributeError(name)


def try_read(spark: SparkSession, path: str, schema=None):
    """The parquet table at ``path``, or None when there is no such path.

    Any other failure is raised: a table that cannot be read must never pass
    for a new one.  With ``schema`` a folder without files (an append that
    failed before its commit) is an empty table.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
