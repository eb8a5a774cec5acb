"""Analytics the lake is built for: pollution against temperature, against
wind, and the cleanest hour of each weekday.  Gold views only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_CITY = ["date_int", "time_int", "city"]


def weather_by_city_hour(weather_hourly: DataFrame) -> DataFrame:
    """One weather row per (date, hour, city): mean over the city's points."""
    return (weather_hourly.groupBy(*HOUR_CITY)
            .agg(F.avg("temperature_2m").alias("temperature"),
                 F.avg("wind_speed_10m").alias("wind_speed")))


def corr_by_parameter(hourly_city: DataFrame, weather_hourly: DataFrame) -> DataFrame:
    """Pearson correlation of hourly city pollution with temperature."""
    w = weather_by_city_hour(weather_hourly)
    j = hourly_city.select(*HOUR_CITY, "parameter", "avg_value").join(w, HOUR_CITY)
    return (j.groupBy("parameter")
            .agg(F.count(F.lit(1)).alias("n_hours"),
                 F.corr("avg_value", "temperature").alias("corr_temperature"),
                 F.corr("avg_value", "wind_speed").alias("corr_wind_speed")))


def by_wind_bucket(hourly_city: DataFrame, weather_hourly: DataFrame) -> DataFrame:
    """Mean pollution per wind-direction bucket and parameter.

    Weather is first reduced to one row per (hour, city, bucket), so each
    pollution row meets at most eight weather rows.
    """
    wb = (weather_hourly.groupBy(*HOUR_CITY, "wind_direction_bucket")
          .agg(F.avg("wind_speed_10m").alias("wind_speed")))
    j = hourly_city.select(*HOUR_CITY, "parameter", "avg_value").join(wb, HOUR_CITY)
    return (j.groupBy("wind_direction_bucket", "parameter")
            .agg(F.count(F.lit(1)).alias("n_hours"),
                 F.avg("avg_value").alias("avg_pollution"),
                 F.avg("wind_speed").alias("avg_wind_speed")))


def best_hour(hourly_city: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per weekday and parameter, the hour with the lowest mean pollution."""
    cal = calendar.select("date_int", "day_of_week", "calendar_day")
    per_hour = (hourly_city.select("date_int", "time_int", "parameter", "avg_value")
                .join(cal, "date_int")
                .groupBy("day_of_week", "calendar_day", "parameter", "time_int")
                .agg(F.avg("avg_value").alias("avg_pollution"),
                     F.count(F.lit(1)).alias("n_hours")))
    w = Window.partitionBy("day_of_week", "parameter").orderBy(F.col("avg_pollution"),
                                                               F.col("time_int"))
    return (per_hour.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
