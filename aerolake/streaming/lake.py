"""A lake that lasts between calls: one root with fixed landing folders, checkpoints
and tables.  Every call takes what has landed since the last one and adds to the same
tables, which are made on the first call."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.keys import date_int, pollution_key, time_int, weather_key
from ..operators import dims, shape
from ..operators.facts import POLLUTION_KEY, WEATHER_KEY, insert_unseen
from ..sources import schemas
from ..sources.landing import LOCATIONS_GLOB, MEASUREMENTS_GLOB, WEATHER_GLOB
from ..sources.warehouse import Warehouse
from . import ingest, metrics
from .keyed import merge_batch, read_keyed
from .upsert import first_arrivals

BRONZE = "01_bronze"
SILVER = "02_silver"
LOAD = "bronze_load_ts"


def _loaded(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOAD, T.TimestampType())])


class LastingLake:
    """The streams of one root.  Each ``ingest_*`` call runs its feed's chain of
    streams to the end of what has landed; files are named as the downloader names
    them, one document each, and cut-off ones are counted.  Feeds land in a folder
    each, or together in the folder ``landing``: their names tell them apart."""

    def __init__(self, spark: SparkSession, root: str, landing: str | None = None):
        self.spark, self.root, self.shared = spark, root, landing
        self.house = Warehouse(spark, root)
        self.metrics = f"{root}/{BRONZE}/_metrics"

    def landing(self, feed: str) -> str:
        return self.shared or f"{self.root}/00_landing/{feed}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/{BRONZE}/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/{SILVER}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def _kept(self, name: str, reports: list) -> list:
        metrics.append_reports(self.spark, self.metrics, name, reports)
        return reports

    def _append(self, rows: DataFrame, name: str) -> list:
        """One hop into the bronze table ``name``; its rule counts are kept."""
        return self._kept(name, ingest.run_available(rows, self.checkpoint(name), self.bronze(name)))

    def _stream(self, name: str, like: DataFrame) -> DataFrame:
        return ingest.read_bronze_stream(self.spark, self.bronze(name), like)

    def rule_counts(self) -> DataFrame:
        """(rule_set, rule, failed_rows, total_rows) of all calls so far."""
        return metrics.totals(metrics.read_reports(self.spark, self.metrics))

    # --- locations, sensors, parameters ------------------------------------------------
    def ingest_locations(self, max_files: int | None = 1) -> list:
        """Location documents, one file per micro-batch, into the three dimensions;
        gives the reports of the first hop."""
        raw = ingest.bronze_locations(self.spark, self.landing("locations"), LOCATIONS_GLOB,
                                      max_files, multiline=True, files="locations_files")
        reports = self._append(raw, "locations")

        def each_batch(batch: DataFrame, batch_id: int) -> None:
            flat = shape.locations_flat(batch).persist()
            sensors, counts = shape.sensor_rows(flat), {}
            for name, rows, rules in (
                    ("locations", shape.location_rows(flat), R.LOCATION_RULES),
                    ("sensors", shape.sensor_dim_rows(sensors), R.SENSOR_RULES),
                    ("parameters", shape.parameter_rows(sensors), R.PARAMETER_RULES)):
                table, schema, key = DIMENSIONS[name]
                failing = Observation()
                checked = R.drop_failing(rows.observe(failing, *R.failure_counts(rules)), rules)
                merge_batch(checked.select(*schema.fieldNames()), [key], [LOAD], self.silver(table),
                            batch_id, latest=True)
                counts[name] = failing.get
            flat.unpersist()
            metrics.append_batch(batch.sparkSession, self.metrics, "locations_dimensions", batch_id,
                                 counts)

        ingest.run_available(self._stream("locations", raw),
                             self.checkpoint("locations_dimensions"), foreach_batch=each_batch)
        return reports

    def dimension(self, name: str) -> DataFrame:
        """``locations``, ``sensors`` or ``parameters``: the latest row of each key."""
        table, schema, key = DIMENSIONS[name]
        return read_keyed(self.spark, self.silver(table), schema, [key], [LOAD],
                          latest=True).drop(LOAD)

    # --- measurements --------------------------------------------------------------------
    def ingest_measurements(self, max_files: int | None = None) -> list:
        """Measurement pages into bronze, clean rows and the pollution fact."""
        raw = ingest.bronze_measurements(
            self.spark, self.landing("measurements"), MEASUREMENTS_GLOB, max_files, multiline=True,
            files="measurements_files")
        reports = self._append(raw, "measurements_raw")
        clean = ingest.clean_measurements_stream(self._stream("measurements_raw", raw))
        self._append(clean, "measurements")
        self.house.create_if_absent(SILVER, "fct_pollution", schemas.FCT_POLLUTION_TABLE,
                                    ["date_month"], POLLUTION_KEY,
                                    comment="Fact table for pollution measurements")

        def each_batch(batch: DataFrame, batch_id: int) -> None:
            ts = F.col("datetime_from")
            keyed = batch.withColumns({"date_int": date_int(ts), "time_int": time_int(ts)})
            first = first_arrivals(keyed, POLLUTION_KEY, ["datetime_from", "value"])
            insert_unseen(self.house, "fct_pollution", first, POLLUTION_KEY, {"id": pollution_key(
                F.col("sensor_id"), F.col("location_id"), ts)})

        ingest.run_available(self._stream("measurements", clean), self.checkpoint("fct_pollution"),
                             foreach_batch=each_batch)
        return reports

    # --- weather ---------------------------------------------------------------------------
    def ingest_weather(self, max_files: int | None = None, facts: bool = True) -> list:
        """Weather documents into bronze and the weather locations; with ``facts``
        also into clean rows and the weather fact."""
        raw = ingest.bronze_weather(self.spark, self.landing("weather"), WEATHER_GLOB, max_files,
                                    multiline=True, files="weather_files")
        reports = self._append(raw, "weather_raw")
        self.house.create_if_absent(SILVER, "dim_weather_locations",
                                    schemas.DIM_WEATHER_LOCATIONS_TABLE)

        def merge(batch: DataFrame, batch_id: int) -> None:
            """``MERGE ... WHEN NOT MATCHED THEN INSERT``: the latest document of
            each location that has no row yet."""
            latest = dims.weather_locations_dim(shape.weather_docs(batch))
            known = self.house.table("dim_weather_locations")
            self.house.append("dim_weather_locations", dims.new_rows(latest, known, ["location_id"]))

        ingest.run_available(self._stream("weather_raw", raw),
                             self.checkpoint("dim_weather_locations"), foreach_batch=merge)
        if not facts:
            return reports
        clean = ingest.clean_weather_stream(self._stream("weather_raw", raw))
        self._append(clean, "weather")
        self.house.create_if_absent(SILVER, "fct_weather", schemas.FCT_WEATHER_TABLE,
                                    ["date_month"], WEATHER_KEY)

        def each_batch(batch: DataFrame, batch_id: int) -> None:
            ts = F.col("datetime")
            keyed = batch.withColumns({"date_int": date_int(ts), "time_int": time_int(ts)})
            first = first_arrivals(keyed, WEATHER_KEY,
                                   ["datetime", *[n for n, _, _ in schemas.WEATHER_VARIABLES]])
            insert_unseen(self.house, "fct_weather", first, WEATHER_KEY,
                          {"id": weather_key(F.col("location_id"), ts)})

        ingest.run_available(self._stream("weather", clean), self.checkpoint("fct_weather"),
                             foreach_batch=each_batch)
        return reports


DIMENSIONS = {
    "locations": ("dim_pollution_locations", _loaded(schemas.DIM_LOCATIONS), "location_id"),
    "sensors": ("dim_pollution_sensors", _loaded(schemas.DIM_SENSORS), "sensor_id"),
    "parameters": ("dim_pollution_parameters", _loaded(schemas.DIM_PARAMETERS), "parameter_id"),
}
