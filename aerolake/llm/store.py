"""Files and tables of one run, below the cluster's shared folder.

Executors write binary files through ``pyarrow.fs``, which takes the same
URIs as Spark (``file:``, ``hdfs:``, ``s3:``).  A file gets a name of its
own for each task attempt, and only the names that a finished stage lists in
its manifest table are ever read: a lost executor or a second attempt
leaves an unused file, never a wrong result.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from aerolake.session import scratch_path

BATCH_KEY, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of operator ``name`` in the shared folder."""
    root = scratch_path(spark, f"llm-{name}")
    return root if ":" in root.split("/")[0] else f"file://{root}"


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in Arrow batches of a few megabytes, whatever the length of
    their texts; a limit that the session has set itself stays."""
    if BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_KEY, BATCH)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage with a table
    every executor can read again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_new(folder: str, prefix: str, suffix: str):
    """A new binary file in ``folder``; gives its URI and the open stream."""
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)
    name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", where.open_output_stream(
        f"{base}/{name}", compression=None)


def open_old(uri: str):
    """The file at ``uri`` for random reads."""
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)
