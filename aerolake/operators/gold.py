"""Gold views: denormalised hourly detail, hourly by city, daily, monthly,
and hourly weather with a wind-direction bucket.

Dimension joins are plain equi-joins; Spark broadcasts a dimension when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
re-checks with runtime sizes) and falls back to a sort-merge join, with
AQE skew splitting, otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import first_of_month_int
from ..functions.wind import wind_bucket
from ..sources.schemas import WEATHER_VARIABLES

LOCATION_ATTRS = ["location_name", "country", "city", "latitude", "longitude"]


def _locations(locations: DataFrame) -> DataFrame:
    return locations.select("location_id", F.col("name").alias("location_name"),
                            "country", "city", "latitude", "longitude")


def _parameters(parameters: DataFrame) -> DataFrame:
    return parameters.select("parameter_id", F.col("name").alias("parameter"), "units")


def _sensor_parameter(sensors: DataFrame) -> DataFrame:
    return sensors.select("sensor_id", "parameter_id")


def hourly(fct: DataFrame, sensors: DataFrame, parameters: DataFrame,
           locations: DataFrame) -> DataFrame:
    """Every fact row with its location and parameter attributes."""
    return (fct.select("date_int", "time_int", "location_id", "sensor_id", "value")
            .join(_sensor_parameter(sensors), "sensor_id")
            .join(_parameters(parameters), "parameter_id")
            .join(_locations(locations), "location_id")
            .select("date_int", "time_int", "location_id", *LOCATION_ATTRS,
                    "parameter", "units", "value"))


def hourly_by_city(hourly_view: DataFrame) -> DataFrame:
    """avg / min / max across all locations of a city, per hour and parameter."""
    return (hourly_view.groupBy("date_int", "time_int", "country", "city", "parameter", "units")
            .agg(F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
                 F.max("value").alias("max_value")))


def daily(fct: DataFrame, sensors: DataFrame, parameters: DataFrame, locations: DataFrame,
          calendar: DataFrame) -> DataFrame:
    """Daily avg / min / max per location and parameter.

    Facts are first reduced to one row per (day, location, sensor) carrying
    sum / count / min / max -- about 24x fewer rows -- before they meet the
    dimensions, so a dimension too large to broadcast is joined against the
    reduced side.  The final average is sum / count, i.e. the plain mean
    of the day's values.
    """
    per_sensor = (fct.groupBy("date_int", "location_id", "sensor_id")
                  .agg(F.sum("value").alias("s"), F.count("value").alias("n"),
                       F.min("value").alias("lo"), F.max("value").alias("hi")))
    cal = calendar.select("date_int", F.col("calendar_date").alias("date"))
    joined = (per_sensor
              .join(_sensor_parameter(sensors), "sensor_id")
              .join(_parameters(parameters), "parameter_id")
              .join(_locations(locations), "location_id")
              .join(cal, "date_int"))
    keys = ["date", "date_int", "location_id", *LOCATION_ATTRS, "parameter", "units"]
    return (joined.groupBy(*keys)
            .agg((F.sum("s") / F.sum("n")).alias("avg_value"),
                 F.min("lo").alias("min_value"), F.max("hi").alias("max_value")))


def monthly(daily_view: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly roll-up of the daily view: mean of daily means (unweighted),
    min of daily minima, max of daily maxima."""
    cal = calendar.select("date_int", F.trunc("calendar_date", "month").alias("month_date"))
    keys = ["date", "date_int", "location_id", *LOCATION_ATTRS, "parameter", "units"]
    return (daily_view.drop("date").join(cal, "date_int")
            .select(F.col("month_date").alias("date"),
                    first_of_month_int(F.col("date_int")).alias("date_int"),
                    "location_id", *LOCATION_ATTRS, "parameter", "units",
                    "avg_value", "min_value", "max_value")
            .groupBy(*keys)
            .agg(F.avg("avg_value").alias("avg_value"), F.min("min_value").alias("min_value"),
                 F.max("max_value").alias("max_value")))


WEATHER_MEASURES = [n for n, _, _ in WEATHER_VARIABLES]


def weather_hourly(fct_weather: DataFrame, weather_locations: DataFrame,
                   on: str = "location_id") -> DataFrame:
    """Weather facts with city / coordinates and the wind-direction bucket.

    Facts and locations meet on column ``on``: the hashed id, or the coordinates
    that it hashes; the id then comes from the location, hashed once for each.
    """
    loc = weather_locations.select(*{on: 0, "location_id": 0}, "city", "latitude", "longitude")
    return (fct_weather.drop(*({"location_id"} - {on})).join(loc, on)
            .select("date_int", "time_int", "location_id", "city", "latitude", "longitude",
                    *WEATHER_MEASURES)
            .withColumn("wind_direction_bucket", wind_bucket(F.col("wind_direction_10m"))))
