"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, over the driver tables.

Averages and correlations are rounded to 6 places (floating sums differ in
the last bits between engines); arrays are rendered as text so results
compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.keys import date_from_int, date_int
from ..operators import audit, dims, insight, planning, shape
from .model import Lake

# Parameters of the planning queries on the driver tables.
PLAN_PARAMETERS = ["building", "household", "machinery"]
PLAN_CITY = "EUROPE"
BACKFILL_FROM = "2023-11-15"
BACKFILL_TO = "2024-06-15"


def r6(c):
    return F.round(c, 6)


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(spark, sf_dir)


def q_rules_drop(spark, sf_dir):
    return _lake(spark, sf_dir).clean_measurements()


def q_rules_counts(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    parts = [
        R.count_failing(lk.location_rows(), R.LOCATION_RULES, "locations"),
        R.count_failing(lk.parameter_rows(), R.PARAMETER_RULES, "parameters"),
        R.count_failing(lk.sensor_rows(), R.SENSOR_RULES, "sensors"),
        # both event feeds from one scan of events
        R.count_failing_sets(lk.both_feeds(), [("measurements", R.MEASUREMENT_RULES, None),
                                               ("weather", R.WEATHER_RULES, "weather")]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dim_locations(spark, sf_dir):
    return _lake(spark, sf_dir).dim_locations


def q_dim_parameters(spark, sf_dir):
    return _lake(spark, sf_dir).dim_parameters


def q_dim_sensors(spark, sf_dir):
    return _lake(spark, sf_dir).dim_sensors


def q_dim_calendar(spark, sf_dir):
    return _lake(spark, sf_dir).dim_calendar


def q_dim_time(spark, sf_dir):
    """The 24-row time dimension with the number of facts in each hour."""
    lk = _lake(spark, sf_dir)
    per_hour = lk.fct_pollution.groupBy("time_int").agg(F.count(F.lit(1)).alias("n_facts"))
    return (dims.time_of_day(spark).join(per_hour, "time_int", "left")
            .select("time_int", "time", "hour", "time_24", "hour_24", "am_pm",
                    F.coalesce("n_facts", F.lit(0)).alias("n_facts")))


def q_latest_per_key(spark, sf_dir):
    """Latest order per customer (ties broken by the higher order key)."""
    o = _lake(spark, sf_dir).t.orders
    return dims.latest_per_key(
        o.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"),
        ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


def q_dim_weather_locations(spark, sf_dir):
    return _lake(spark, sf_dir).dim_weather_locations


def q_weather_rows(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    rows = shape.weather_rows(shape.weather_docs(lk.weather_array_documents()))
    return rows.drop("bronze_load_ts", "source_file_name")


def q_fct_pollution(spark, sf_dir):
    return _lake(spark, sf_dir).fct_pollution


def q_fct_weather(spark, sf_dir):
    return _lake(spark, sf_dir).fct_weather


def q_hourly_detail(spark, sf_dir):
    return _lake(spark, sf_dir).hourly


def _rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_value", r6(F.col("avg_value")))


def q_hourly_by_city(spark, sf_dir):
    return _rounded_stats(_lake(spark, sf_dir).hourly_by_city)


def q_agg_daily(spark, sf_dir):
    return _rounded_stats(_lake(spark, sf_dir).daily)


def q_agg_monthly(spark, sf_dir):
    return _rounded_stats(_lake(spark, sf_dir).monthly)


def q_weather_hourly(spark, sf_dir):
    return _lake(spark, sf_dir).weather_hourly


def q_high_water_by_location(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    return planning.high_water_by_location(lk.weather_by_point(), lk.weather_locations, on="point")


def _arr_text(df: DataFrame) -> DataFrame:
    return df.withColumn("sensor_id_arr", F.array_join("sensor_id_arr", ","))


def q_high_water_worklist(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    return _arr_text(planning.high_water_worklist(
        lk.dim_locations, lk.dim_sensors, lk.dim_parameters, lk.fct_pollution, PLAN_PARAMETERS))


def q_high_water_per_location(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    return _arr_text(planning.high_water_worklist(
        lk.dim_locations, lk.dim_sensors, lk.dim_parameters, lk.fct_pollution, PLAN_PARAMETERS,
        per_location=True))


def q_sensors_by_city(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    return _arr_text(planning.sensors_by_city(
        lk.dim_locations, lk.dim_sensors, lk.dim_parameters, PLAN_CITY, PLAN_PARAMETERS))


def q_backfill_worklist(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    # Clean measurements hold the same chunks as the fact, without its dedup.
    measured = lk.clean_measurements().select("location_id", "sensor_id",
                                              date_int(F.col("datetime_from")).alias("date_int"))
    return planning.backfill_worklist(lk.dim_locations, lk.dim_sensors, lk.dim_parameters,
                                      measured, BACKFILL_FROM, BACKFILL_TO, PLAN_PARAMETERS)


def q_key_audit(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    t = lk.t
    return audit.key_audit([
        ("lineitem", t.lineitem, ["l_orderkey", "l_linenumber"]),
        ("orders", t.orders, ["o_orderkey"]),
        ("customer", t.customer, ["c_custkey"]),
        ("fct_pollution", lk.fct_pollution, ["id"]),
        ("dim_pollution_sensors", lk.dim_sensors, ["sensor_id"]),
        ("dim_calendar", lk.dim_calendar, ["date_int"]),
    ])


def q_orphan_audit(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    t = lk.t
    orders, customer = t.orders, t.customer
    return audit.orphan_audit([
        ("events.user_id -> customer", t.events, "user_id", customer, "c_custkey"),
        ("lineitem.l_orderkey -> orders", t.lineitem, "l_orderkey", orders, "o_orderkey"),
        ("orders.o_custkey -> customer", orders, "o_custkey", customer, "c_custkey"),
        ("fct_pollution.sensor_id -> dim_pollution_sensors", lk.fct_pollution, "sensor_id",
         lk.dim_sensors, "sensor_id"),
        ("fct_pollution.date_int -> dim_calendar", lk.fct_pollution, "date_int",
         lk.dim_calendar, "date_int"),
        ("fct_pollution.time_int -> dim_time", lk.fct_pollution, "time_int",
         dims.time_of_day(spark), "time_int"),
        ("fct_weather.location_id -> dim_weather_locations", lk.fct_weather, "location_id",
         lk.dim_weather_locations, "location_id"),
    ])


def q_key_audit_dimensions(spark, sf_dir):
    """The declared keys that ``key_audit`` does not hold."""
    lk = _lake(spark, sf_dir)
    return audit.key_audit([
        ("dim_pollution_locations", lk.dim_locations, ["location_id"]),
        ("dim_pollution_parameters", lk.dim_parameters, ["parameter_id"]),
        ("dim_time", dims.time_of_day(spark), ["time_int"]),
        ("dim_weather_locations", lk.dim_weather_locations, ["location_id"]),
    ])


def q_orphan_audit_dimensions(spark, sf_dir):
    """The declared references that ``orphan_audit`` does not hold."""
    lk = _lake(spark, sf_dir)
    return audit.orphan_audit([
        ("dim_pollution_sensors.location_id -> dim_pollution_locations", lk.dim_sensors,
         "location_id", lk.dim_locations, "location_id"),
        ("dim_pollution_sensors.parameter_id -> dim_pollution_parameters", lk.dim_sensors,
         "parameter_id", lk.dim_parameters, "parameter_id"),
        ("fct_pollution.location_id -> dim_pollution_locations", lk.fct_pollution,
         "location_id", lk.dim_locations, "location_id"),
        ("fct_weather.date_int -> dim_calendar", lk.fct_weather, "date_int",
         lk.dim_calendar, "date_int"),
        ("fct_weather.time_int -> dim_time", lk.fct_weather, "time_int",
         dims.time_of_day(spark), "time_int"),
    ])


def q_corr_by_parameter(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    out = insight.corr_by_parameter(lk.hourly_by_city, lk.weather_hourly)
    return (out.withColumn("corr_temperature", r6(F.col("corr_temperature")))
            .withColumn("corr_wind_speed", r6(F.col("corr_wind_speed"))))


def q_by_wind_bucket(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    out = insight.by_wind_bucket(lk.hourly_by_city, lk.weather_hourly)
    return (out.withColumn("avg_pollution", r6(F.col("avg_pollution")))
            .withColumn("avg_wind_speed", r6(F.col("avg_wind_speed"))))


def q_best_hour(spark, sf_dir):
    lk = _lake(spark, sf_dir)
    out = insight.best_hour(lk.hourly_by_city, lk.dim_calendar)
    return out.withColumn("avg_pollution", r6(F.col("avg_pollution")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rules_drop": q_rules_drop,
    "rules_counts": q_rules_counts,
    "dim_locations": q_dim_locations,
    "dim_parameters": q_dim_parameters,
    "dim_sensors": q_dim_sensors,
    "dim_calendar": q_dim_calendar,
    "dim_time": q_dim_time,
    "latest_per_key": q_latest_per_key,
    "dim_weather_locations": q_dim_weather_locations,
    "weather_rows": q_weather_rows,
    "fct_pollution": q_fct_pollution,
    "fct_weather": q_fct_weather,
    "hourly_detail": q_hourly_detail,
    "hourly_by_city": q_hourly_by_city,
    "agg_daily": q_agg_daily,
    "agg_monthly": q_agg_monthly,
    "weather_hourly": q_weather_hourly,
    "high_water_by_location": q_high_water_by_location,
    "high_water_worklist": q_high_water_worklist,
    "high_water_per_location": q_high_water_per_location,
    "sensors_by_city": q_sensors_by_city,
    "backfill_worklist": q_backfill_worklist,
    "key_audit": q_key_audit,
    "orphan_audit": q_orphan_audit,
    "key_audit_dimensions": q_key_audit_dimensions,
    "orphan_audit_dimensions": q_orphan_audit_dimensions,
    "corr_by_parameter": q_corr_by_parameter,
    "by_wind_bucket": q_by_wind_bucket,
    "best_hour": q_best_hour,
}

from .build import BUILD_QUERIES  # noqa: E402
from .downloads import DOWNLOAD_QUERIES  # noqa: E402
from .raw import RAW_QUERIES  # noqa: E402
from .streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(BUILD_QUERIES)
QUERIES.update(STREAM_QUERIES)
QUERIES.update(RAW_QUERIES)
QUERIES.update(DOWNLOAD_QUERIES)
