"""Map the driver tables onto the lake's roles.

Roles (TPC-H-like tables standing in for the sensor feeds):

* pollution location = ``nation`` (city = its ``region``)
* pollution parameter = a ``customer`` market segment; its id is its place in the
  order of the segments
* pollution sensor = ``customer`` (placed at its nation, measuring its segment)
* pollution measurement = ``events`` row (sensor = ``user_id``, hour = ``ts``
  cut to the hour, value = ``value``; arrival order = ``event_id``)
* weather location document = ``supplier`` (coordinates of its nation;
  a later supplier key is a later document)
* weather reading = ``events`` row at the nation of its user
* parallel hourly arrays = ``embeddings.embedding``

Every builder is lazy; nothing is collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import date_int, time_int, weather_location_key
from ..functions.rules import MEASUREMENT_RULES, WEATHER_RULES, drop_failing
from ..operators import dims, facts, gold
from ..operators.dedup import dense_places, first_per_key
from ..sources.tables import Tables

# Fixed load time of rows read from driver tables (they arrive at once).
LOAD_TS = "2024-02-01 00:00:00"
BASE_HOUR = "2024-01-01 00:00:00"


def hour_of(ts):
    """Start of the hour, kept as TIMESTAMP_NTZ like the driver tables."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


class Lake:
    """Silver and gold tables of the lake, derived from one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, events_where=None):
        """``events_where`` restricts the measurement / weather feeds (e.g. one
        landing round); dimensions and the calendar always use all data."""
        self.spark = spark
        self.t = Tables(spark, sf_dir)
        self.events_where = events_where

    def events(self) -> DataFrame:
        e = self.t.events.select("event_id", "ts", "user_id", "value")
        return e if self.events_where is None else e.filter(self.events_where)

    # --- pollution dimensions -------------------------------------------------
    def location_rows(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                .select(n.n_nationkey.cast("int").alias("location_id"),
                        n.n_name.alias("name"), r.r_name.alias("locality"),
                        n.n_name.alias("country"), r.r_name.alias("city"),
                        F.lit(None).cast("boolean").alias("is_mobile"),
                        F.lit(None).cast("boolean").alias("is_monitor"),
                        n.n_nationkey.cast("float").alias("latitude"),
                        n.n_regionkey.cast("float").alias("longitude"),
                        F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts")))

    def segment_ids(self) -> DataFrame:
        """(c_mktsegment, parameter_id): a segment's id is its least customer."""
        return (self.t.customer.filter("c_mktsegment is not null").groupBy("c_mktsegment")
                .agg(F.min("c_custkey").cast("int").alias("parameter_id")))

    def segment_places(self) -> DataFrame:
        """(c_mktsegment, parameter_id): a segment's place among all, from 1."""
        return dense_places(self.t.customer, "c_mktsegment", "parameter_id")

    def parameter_rows(self) -> DataFrame:
        return self.segment_places().select(
            "parameter_id",
            F.col("c_mktsegment").alias("display_name"),
            F.lower("c_mktsegment").alias("name"),
            F.lit(None).cast("string").alias("units"),
            F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts"))

    def sensor_rows(self) -> DataFrame:
        c = self.t.customer
        p = self.dim_parameters.select(F.col("display_name").alias("c_mktsegment"), "parameter_id")
        return (c.join(p, "c_mktsegment", "left")
                .select(F.col("c_custkey").alias("sensor_id"), F.col("c_name").alias("name"),
                        F.col("c_nationkey").cast("int").alias("location_id"), "parameter_id",
                        F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts")))

    @cached_property
    def dim_locations(self) -> DataFrame:
        return dims.locations_dim(self.location_rows())

    @cached_property
    def dim_parameters(self) -> DataFrame:
        return dims.parameters_dim(self.parameter_rows())

    @cached_property
    def dim_sensors(self) -> DataFrame:
        return dims.sensors_dim(self.sensor_rows())

    # --- pollution measurements -------------------------------------------------
    def _readings(self, with_region: bool) -> DataFrame:
        """Events with their sensor's location (and its region, for weather)."""
        e = self.events()
        c = self.t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
        out = e.join(c, "user_id", "left")
        if with_region:
            n = self.t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
            out = out.join(n, "c_nationkey", "left")
        return out

    @staticmethod
    def _measurement_columns() -> list:
        start = hour_of(F.col("ts"))
        return [start.alias("datetime_from"),
                (start + F.expr("INTERVAL 1 HOUR")).alias("datetime_to"),
                F.col("value").cast("float").alias("value"),
                F.lit("01:00:00").alias("interval"),
                F.col("c_nationkey").cast("int").alias("location_id"),
                F.col("user_id").alias("sensor_id"), "event_id"]

    def measurement_feed(self) -> DataFrame:
        """Clean-measurement rows (before rules) with arrival order."""
        return self._readings(False).select(*self._measurement_columns())

    def clean_measurements(self) -> DataFrame:
        return drop_failing(self.measurement_feed(), MEASUREMENT_RULES)

    @cached_property
    def fct_pollution(self) -> DataFrame:
        # Dedup on the compact natural key (the hashed id is a function of
        # it), then hash only the surviving rows.
        clean = self.clean_measurements().select(
            F.date_trunc("second", "datetime_from").cast("timestamp_ntz").alias("datetime_from"),
            "sensor_id", "location_id", "value", "event_id")
        first = first_per_key(clean, ["sensor_id", "location_id", "datetime_from"], ["event_id"])
        return facts.pollution_fact_rows(first)

    # --- weather ----------------------------------------------------------------
    def weather_documents(self) -> DataFrame:
        s, n, r = self.t.supplier, self.t.nation, self.t.region
        return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
                .select(n.n_nationkey.cast("double").alias("latitude"),
                        n.n_regionkey.cast("double").alias("longitude"),
                        r.r_name.alias("city"), F.lit("GMT").alias("timezone"),
                        s.s_acctbal.alias("elevation"),
                        F.timestamp_seconds(s.s_suppkey).alias("bronze_load_ts"),
                        F.concat(F.lit("openmeteo_"), r.r_name, F.lit("_"),
                                 s.s_suppkey.cast("string"), F.lit(".json.gz"))
                        .alias("source_file_name")))

    @cached_property
    def weather_locations(self) -> DataFrame:
        """The weather locations with their ``point``."""
        return dims.weather_locations_by_point(self.weather_documents())

    @cached_property
    def dim_weather_locations(self) -> DataFrame:
        return self.weather_locations.drop("point")

    @staticmethod
    def _weather_columns(hashed: bool = True) -> list:
        """Weather reading columns; with ``hashed`` False the location id is
        still the point its key hashes (NULL exactly when the key is NULL)."""
        v = F.col("value")
        nul = lambda t: F.lit(None).cast(t)
        location = weather_location_key if hashed else dims.point
        return [location(F.col("c_nationkey").cast("double"),
                         F.col("n_regionkey").cast("double")).alias("location_id"),
                hour_of(F.col("ts")).alias("datetime"),
                nul("float").alias("apparent_temperature"),
                nul("float").alias("precipitation"),
                nul("int").alias("relative_humidity_2m"),
                v.cast("float").alias("temperature_2m"),
                nul("int").alias("wind_direction_100m"),
                (F.floor(v).cast("int") % 360).alias("wind_direction_10m"),
                nul("float").alias("wind_gusts_10m"),
                nul("float").alias("wind_speed_100m"),
                (v / 10).cast("float").alias("wind_speed_10m"),
                v.cast("float").alias("surface_pressure"),
                "event_id"]

    def weather_feed(self) -> DataFrame:
        return self._readings(True).select(*self._weather_columns())

    def both_feeds(self) -> DataFrame:
        """Measurement columns at the top level and the weather columns of
        the same event in struct ``weather``: both feeds from one scan."""
        return self._readings(True).select(*self._measurement_columns(),
                                           F.struct(*self._weather_columns()).alias("weather"))

    @cached_property
    def weather_readings(self) -> DataFrame:
        """The first reading of each point and hour, nothing hashed: rules, dedup
        and joins run on the point (two doubles, NULL exactly when the key is)."""
        feed = self._readings(True).select(*self._weather_columns(hashed=False))
        clean = drop_failing(feed, WEATHER_RULES).withColumn(
            "datetime", F.date_trunc("second", "datetime").cast("timestamp_ntz"))
        return first_per_key(clean, ["location_id", "datetime"], ["event_id"])

    def weather_by_point(self) -> DataFrame:
        """Weather facts with their ``point`` in place of both ids."""
        ts = F.col("datetime")
        return self.weather_readings.select(F.col("location_id").alias("point"),
                                            date_int(ts).alias("date_int"),
                                            time_int(ts).alias("time_int"), *gold.WEATHER_MEASURES)

    @cached_property
    def fct_weather(self) -> DataFrame:
        return facts.weather_fact_rows(
            self.weather_readings.withColumn("location_id", dims.point_key("location_id")))

    def weather_array_documents(self) -> DataFrame:
        """One weather document per embedding: hour i holds element i."""
        e = self.t.embeddings
        hours = F.transform(
            F.sequence(F.lit(0), F.size("embedding") - 1),
            lambda i: F.date_format(F.lit(BASE_HOUR).cast("timestamp") + F.make_dt_interval(F.lit(0), i),
                                    "yyyy-MM-dd'T'HH:mm"))
        empty = lambda t: F.array().cast(f"array<{t}>")
        hourly = F.struct(
            hours.alias("time"),
            empty("double").alias("apparent_temperature"),
            F.slice(F.col("embedding"), F.lit(1), F.floor(F.size("embedding") / 2).cast("int")).cast("array<double>")
            .alias("precipitation"),
            empty("bigint").alias("relative_humidity_2m"),
            F.col("embedding").cast("array<double>").alias("temperature_2m"),
            empty("bigint").alias("wind_direction_100m"),
            empty("bigint").alias("wind_direction_10m"),
            empty("double").alias("wind_gusts_10m"),
            empty("double").alias("wind_speed_100m"),
            empty("double").alias("wind_speed_10m"),
            F.reverse(F.col("embedding")).cast("array<double>").alias("surface_pressure"))
        return e.select(
            F.col("label").cast("double").alias("latitude"),
            F.col("vec_id").cast("double").alias("longitude"),
            F.lit(None).cast("double").alias("elevation"),
            F.lit(None).cast("double").alias("generationtime_ms"),
            hourly.alias("hourly"),
            F.lit(None).cast("struct<time:string>").alias("hourly_units"),
            F.lit("GMT").alias("timezone"), F.lit("GMT").alias("timezone_abbreviation"),
            F.lit(0).cast("bigint").alias("utc_offset_seconds"),
            F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts"),
            F.concat(F.lit("openmeteo_"), F.col("label").cast("string"), F.lit("_"),
                     F.col("vec_id").cast("string"), F.lit(".json.gz")).alias("source_file_name"))

    # --- calendar -----------------------------------------------------------------
    @cached_property
    def dim_calendar(self) -> DataFrame:
        """Calendar covering the fact date range (first to last event day)."""
        b = self.t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
        return dims.calendar_between(b, F.to_date("lo"), F.to_date("hi"))

    # --- gold ------------------------------------------------------------------------
    @cached_property
    def hourly(self) -> DataFrame:
        return gold.hourly(self.fct_pollution, self.dim_sensors, self.dim_parameters,
                           self.dim_locations)

    @cached_property
    def hourly_by_city(self) -> DataFrame:
        return gold.hourly_by_city(self.hourly)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily(self.fct_pollution, self.dim_sensors, self.dim_parameters,
                          self.dim_locations, self.dim_calendar)

    @cached_property
    def monthly(self) -> DataFrame:
        return gold.monthly(self.daily, self.dim_calendar)

    @cached_property
    def weather_hourly(self) -> DataFrame:
        return gold.weather_hourly(self.weather_by_point(), self.weather_locations, on="point")
