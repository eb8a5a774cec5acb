"""Dimension builders: calendar, time of day, locations, parameters,
sensors and weather locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, time_columns
from ..functions.keys import weather_location_key
from ..functions.rules import LOCATION_RULES, PARAMETER_RULES, SENSOR_RULES, drop_failing
from ..sources.tables import try_read
from .dedup import latest_per_key



def _days(n: int = 1):
    return F.expr(f"INTERVAL {n} DAY")


def _hours(n: int = 1):
    return F.expr(f"INTERVAL {n} HOUR")


def calendar_between(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Calendar rows for every day from ``start`` to ``end`` of each bounds row.

    ``bounds`` is normally a one-row aggregate (e.g. min/max fact date), so
    the calendar follows the data instead of a fixed rolling window; the
    output has one row per day, ordered.
    """
    days = bounds.select(F.explode(F.sequence(start.cast("date"), end.cast("date"), _days()))
                         .alias("calendar_date"))
    return days.select(*calendar_columns(F.col("calendar_date")))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    return calendar_between(spark.range(1), F.lit(start), F.lit(end))


def rolling_calendar(spark: SparkSession, years: int = 5, end: str | None = None) -> DataFrame:
    """``years`` back from ``end`` (default today), the source's default range."""
    return rolling_between(spark.range(1), F.lit(end).cast("date") if end else F.current_date(),
                           years)


def rolling_between(bounds: DataFrame, end: Column, years: int = 5) -> DataFrame:
    """``years`` back from the ``end`` of each bounds row."""
    return calendar_between(bounds, F.add_months(end.cast("date"), -12 * years), end)


def time_of_day(spark: SparkSession) -> DataFrame:
    """24 rows, one per hour of a day."""
    hours = spark.range(1).select(F.explode(F.sequence(
        F.to_timestamp(F.lit("1900-01-01 00:00")), F.to_timestamp(F.lit("1900-01-01 23:59")),
        _hours())).alias("t"))
    return hours.select(*time_columns(F.col("t")))


def _latest_load(*columns: str) -> list[Column]:
    """Latest load first; rows of one load by every column, so that the row
    kept never depends on the order of the input."""
    return [F.col(c).desc() for c in ("bronze_load_ts", *columns)]


def locations_dim(rows: DataFrame) -> DataFrame:
    """Rule-checked locations, one row per location_id (latest load wins)."""
    checked = drop_failing(rows, LOCATION_RULES)
    payload = ["name", "locality", "country", "city", "is_mobile", "is_monitor", "latitude",
               "longitude"]
    return (latest_per_key(checked, ["location_id"], _latest_load(*payload))
            .select("location_id", *payload))


def parameters_dim(rows: DataFrame) -> DataFrame:
    """Rule-checked parameters, one row per parameter_id (latest load wins)."""
    checked = drop_failing(rows, PARAMETER_RULES)
    latest = latest_per_key(checked, ["parameter_id"],
                            _latest_load("name", "display_name", "units"))
    return latest.select("parameter_id", "display_name", "name", "units")


def sensors_dim(rows: DataFrame) -> DataFrame:
    checked = drop_failing(rows, SENSOR_RULES)
    latest = latest_per_key(checked, ["sensor_id"],
                            _latest_load("name", "location_id", "parameter_id"))
    return latest.select("sensor_id", "name", "location_id", "parameter_id")


def point(latitude: Column, longitude: Column) -> Column:
    """Raw (double) coordinates as one value; NULL if either is."""
    return F.when(latitude.isNotNull() & longitude.isNotNull(),
                  F.struct(latitude.alias("latitude"), longitude.alias("longitude")))


def point_key(where: str) -> Column:
    """The hashed location id of a ``point`` column."""
    return weather_location_key(F.col(f"{where}.latitude"), F.col(f"{where}.longitude"))


def weather_locations_by_point(raw: DataFrame) -> DataFrame:
    """Latest document per weather location with its ``point``.  Documents
    without coordinates (failed downloads) are skipped; ids are hashed from the
    raw coordinates (never from their FLOAT copy) of the rows that are kept."""
    src = raw.select(point(F.col("latitude"), F.col("longitude")).alias("point"), "city", "timezone",
                     F.col("elevation").cast("float").alias("elevation"), "bronze_load_ts",
                     "source_file_name").filter("point is not null")
    latest = latest_per_key(src, ["point"],
                            _latest_load("source_file_name", "city", "timezone", "elevation"))
    return latest.select("point", point_key("point").alias("location_id"),
                         F.col("point.latitude").cast("float").alias("latitude"),
                         F.col("point.longitude").cast("float").alias("longitude"),
                         "city", "timezone", "elevation")


def weather_locations_dim(raw: DataFrame) -> DataFrame:
    """Latest document per weather location."""
    return weather_locations_by_point(raw).drop("point")


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: rows of ``source`` whose key is not in ``target``."""
    return source.join(target.select(*keys), on=keys, how="left_anti")


def merge_insert_only(spark: SparkSession, source: DataFrame, path: str, keys: list[str]) -> int:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT`` on a parquet table: append
    the rows of ``source`` whose key is not yet in the table at ``path``
    (creating it on first use).  Existing rows are never updated, so
    re-running with the same source appends nothing.  Returns rows added."""
    target = try_read(spark, path)
    fresh = source if target is None else new_rows(source, target, keys)
    fresh = fresh.persist()
    try:
        n = fresh.count()
        if n or target is None:
            fresh.write.mode("append").parquet(path)
        return n
    finally:
        fresh.unpersist()
