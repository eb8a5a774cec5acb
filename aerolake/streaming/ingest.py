"""Bronze and clean streams.  Each hop is its own query with its own
checkpoint, triggered with ``availableNow`` (process what has landed, then
stop) and awaited so errors propagate."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.rules import MEASUREMENT_RULES, WEATHER_RULES, drop_failing, observe_failing
from ..operators import shape
from ..sources import schemas
from ..sources.landing import CORRUPT_FIELD, json_stream, rate_limit, source_name_col

# Bytes of new files per micro-batch.  The source pipeline read one file
# per batch, and a landed page holds only 1,000 rows, so a file count would
# make a backlog of months into millions of tiny batches, each paying the
# fixed cost of planning, the upsert's anti-join and the commit.  A byte
# budget keeps batches equal in work whatever the file sizes; at about 50x
# gzip compression 4 GB is some 200 GB of documents, enough to fill a large
# cluster, yet a backlog still runs as a sequence of bounded batches.
# ``max_files=1`` gives the source's behaviour.
DEFAULT_MAX_BYTES = 4 * 1024 ** 3
# Bronze parquet hops: the same bound on columnar files.
DEFAULT_MAX_PARQUET_BYTES = 16 * 1024 ** 3


def run_available(df: DataFrame, checkpoint: str, path: str | None = None,
                  partition_by: list[str] | None = None, fmt: str = "parquet",
                  foreach_batch=None):
    """Run a stream to the end of the available input, then stop.

    Either appends to ``path`` (file sink: exactly-once via its commit log)
    or calls ``foreach_batch(df, batch_id)`` (idempotent callbacks only).
    Returns the list of progress reports.
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch).outputMode("update")
    else:
        w = w.format(fmt).outputMode("append").option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    reports = _Reports()
    df.sparkSession.streams.addListener(reports)
    try:
        q = w.start()
        q.awaitTermination()
        return reports.of(str(q.runId))
    finally:
        df.sparkSession.streams.removeListener(reports)


class _Reports(StreamingQueryListener):
    """Every progress report of the streams run while it listens; a query's
    own ``recentProgress`` forgets all but the last hundred."""

    def __init__(self):
        self._progress, self._ended, self._news = {}, set(), threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        with self._news:
            self._progress.setdefault(str(event.progress.runId), []).append(event.progress)

    def onQueryTerminated(self, event):
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, run_id: str, seconds: float = 60.0) -> list:
        """The reports of one run, complete once its end was announced."""
        with self._news:
            if not self._news.wait_for(lambda: run_id in self._ended, seconds):
                raise RuntimeError(f"no end of stream {run_id} was announced in {seconds} s")
            return self._progress.get(run_id, [])


def observe_files(df: DataFrame, name: str) -> DataFrame:
    """Count the documents of each micro-batch, and those that were cut off."""
    return df.observe(name, F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(F.col(CORRUPT_FIELD).isNotNull()).alias("document is complete")
                      ).drop(CORRUPT_FIELD)


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file_name", source_name_col()).withColumn(
        "bronze_load_ts", F.current_timestamp())


def _documents(spark: SparkSession, landing: str, schema, glob: str, max_files, multiline: bool,
               max_bytes, files: str | None) -> DataFrame:
    """Landed documents; with ``files`` complete and cut-off ones are counted
    under that name, the latter give no rows."""
    raw = json_stream(spark, landing, schema, glob, max_files, multiline, max_bytes,
                      corrupt=files is not None)
    return raw if files is None else observe_files(raw, files)


def bronze_locations(spark: SparkSession, landing: str, glob: str, max_files=None,
                     multiline=False, max_bytes=DEFAULT_MAX_BYTES, files=None) -> DataFrame:
    raw = _documents(spark, landing, schemas.LOCATIONS_FILE, glob, max_files, multiline, max_bytes,
                     files)
    return _stamp(raw).select(F.explode("results").alias("results"), "source_file_name",
                              "bronze_load_ts")


def bronze_measurements(spark: SparkSession, landing: str, glob: str, max_files=None,
                        multiline=False, max_bytes=DEFAULT_MAX_BYTES, files=None) -> DataFrame:
    """One row per record; ``position`` is its place in the document, which
    with the page number of the file name gives the order of arrival."""
    raw = _documents(spark, landing, schemas.MEASUREMENTS_FILE, glob, max_files, multiline, max_bytes,
                     files)
    return _stamp(raw).select(F.posexplode("results").alias("position", "results"),
                              "source_file_name", "bronze_load_ts")


def bronze_weather(spark: SparkSession, landing: str, glob: str, max_files=None,
                   multiline=False, max_bytes=DEFAULT_MAX_BYTES, files=None) -> DataFrame:
    raw = _documents(spark, landing, schemas.WEATHER_FILE, glob, max_files, multiline, max_bytes,
                     files)
    return _stamp(raw).drop("_landing_name")


def read_bronze_stream(spark: SparkSession, path: str, like: DataFrame,
                       max_files: int | None = None,
                       max_bytes: int | None = DEFAULT_MAX_PARQUET_BYTES) -> DataFrame:
    """Stream a bronze parquet table (schema taken from its definition)."""
    return rate_limit(spark.readStream.schema(like.schema), max_files, max_bytes).parquet(path)


def clean_measurements_stream(bronze: DataFrame) -> DataFrame:
    cleaned = shape.measurements_clean(bronze)
    return drop_failing(observe_failing(cleaned, MEASUREMENT_RULES, "measurements_rules"),
                        MEASUREMENT_RULES)


def clean_weather_stream(bronze: DataFrame) -> DataFrame:
    rows = shape.weather_rows(shape.weather_docs(bronze), position=True)
    return drop_failing(observe_failing(rows, WEATHER_RULES, "weather_rules"), WEATHER_RULES)
