"""Insert-only upsert of a clean stream into a keyed fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from ..operators.facts import insert_new, pollution_fact_rows, weather_fact_rows
from ..operators.shape import page_number
from ..sources.schemas import FCT_POLLUTION, FCT_WEATHER, WEATHER_VARIABLES
from .ingest import run_available

# Order of arrival of rows with one key: load time, then the document (files
# of one chunk by page number, not by the text of their names), then the
# row's place in it.  Two different rows never tie; copies of one file do,
# and are equal.
ARRIVAL = ["bronze_load_ts", "_chunk", "_page", "position"]

# Both ids hash exactly these columns (time to the second), so a batch is
# reduced on them and only the surviving rows are hashed.
POLLUTION_NATURAL_KEY = ["sensor_id", "location_id", "datetime_from"]
WEATHER_NATURAL_KEY = ["location_id", "datetime"]


def upsert_stream(spark: SparkSession, clean: DataFrame, target: str, checkpoint: str,
                  columns: list[str], first_rows):
    """Run the ``clean`` stream into ``target`` with first-write-wins.

    ``first_rows(batch)`` turns a micro-batch into keyed rows, one per key:
    the first arrival.  They are anti-joined against the target (restricted
    to the batch's months) before appending; a replayed batch therefore
    inserts nothing twice.
    """
    inserted = []

    def each_batch(batch: DataFrame, batch_id: int):
        inserted.append(insert_new(batch.sparkSession, first_rows(batch), target, columns,
                                   order=[], dedup=False))

    run_available(clean, checkpoint, foreach_batch=each_batch)
    return inserted


def first_arrivals(batch: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """The first arrival of each key of a clean micro-batch."""
    name = F.col("source_file_name")
    rows = batch.select(
        *key, *payload, "bronze_load_ts",
        F.regexp_replace(name, r"_page\d+\.", ".").alias("_chunk"),
        page_number(name).alias("_page"), "position")
    return first_per_key(rows, key, ARRIVAL)


def _first(batch: DataFrame, key: list[str], ts: str, payload: list[str]) -> DataFrame:
    """The same with the key's time ``ts`` cut to the second."""
    return first_arrivals(batch.withColumn(ts, F.date_trunc("second", ts)), key, payload)


def first_pollution_rows(batch: DataFrame) -> DataFrame:
    """One fact row per natural key of a clean micro-batch (first arrival)."""
    return pollution_fact_rows(_first(batch, POLLUTION_NATURAL_KEY, "datetime_from", ["value"]))


def first_weather_rows(batch: DataFrame) -> DataFrame:
    """The same for weather rows."""
    return weather_fact_rows(_first(batch, WEATHER_NATURAL_KEY, "datetime",
                                    [n for n, _, _ in WEATHER_VARIABLES]))


def upsert_pollution(spark: SparkSession, clean: DataFrame, target: str, checkpoint: str):
    return upsert_stream(spark, clean, target, checkpoint, FCT_POLLUTION.fieldNames(),
                         first_pollution_rows)


def upsert_weather(spark: SparkSession, clean: DataFrame, target: str, checkpoint: str):
    return upsert_stream(spark, clean, target, checkpoint, FCT_WEATHER.fieldNames(),
                         first_weather_rows)
