"""Feeds as they come in: records with missing and senseless values.

The roles are those of ``model.Lake``; some attributes of the driver tables stand
for faults of a record, so every rule has rows that fail it, and the dimension rows
that rules drop leave references without a parent:

* the number ``k`` of an event's ``props``: 13 no value, 17 no start, 19 no sensor,
  23 no location; for weather 29 no coordinates, 31 no hour, 37 no temperature, 41 no
  pressure; an ``error`` event is a reading of half an hour, and values are stretched
  below 0 and above 800
* a nation whose name ends in 7 has no name, NATION_13 no id, and those ending in 2
  of ASIA have no city; names are written with a space
* a customer's balance: below -900 no sensor id, from there to -800 no location,
  from there to -700 a parameter without a name, above 9,900 no parameter id
* weather documents of nations above 20 have no coordinates
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import audit, dims, gold, planning
from .model import LOAD_TS, Lake, hour_of

# The last day of the calendar that facts are checked against, and the
# day on which the work list is made.
CALENDAR_END = "2024-01-20"
TODAY = "2024-02-10"
BACKFILL_FROM = "2023-11-15"
PLAN_PARAMETERS = ["building", "household", "machinery"]


def unless(fault, value):
    """``value``, NULL where ``fault`` holds."""
    return F.when(~fault, value)


def props_k():
    return F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int")


class RawFeeds(Lake):
    """The lake of ``model`` over faulty records."""

    def events(self) -> DataFrame:
        e = self.t.events.select("event_id", "ts", "user_id", "value", "event_type",
                                 F.coalesce(props_k(), F.lit(-1)).alias("k"))
        return e if self.events_where is None else e.filter(self.events_where)

    def location_rows(self) -> DataFrame:
        rows, name = super().location_rows(), F.col("name")
        return rows.select(
            unless(name == "NATION_13", F.col("location_id")).alias("location_id"),
            unless(name.endswith("7"), F.translate(name, "_", " ")).alias("name"), "locality",
            "country", unless(name.endswith("2") & (F.col("city") == "ASIA"), F.col("city"))
            .alias("city"), "is_mobile", "is_monitor", "latitude", "longitude", "bronze_load_ts")

    def parameter_rows(self) -> DataFrame:
        """One row per sensor's record, as the documents name them."""
        balance = F.col("c_acctbal")
        return (self.t.customer.join(self.segment_ids(), "c_mktsegment").select(
            unless(balance > 9900, F.col("parameter_id")).alias("parameter_id"),
            F.col("c_mktsegment").alias("display_name"),
            unless(balance.between(-800, -700), F.lower("c_mktsegment")).alias("name"),
            F.lit(None).cast("string").alias("units"),
            F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts")))

    def sensor_rows(self) -> DataFrame:
        balance = F.col("c_acctbal")
        return self.t.customer.join(self.segment_ids(), "c_mktsegment", "left").select(
            unless(balance < -900, F.col("c_custkey")).alias("sensor_id"),
            F.col("c_name").alias("name"),
            unless((balance >= -900) & (balance < -800), F.col("c_nationkey").cast("int"))
            .alias("location_id"),
            unless(balance > 9900, F.col("parameter_id")).alias("parameter_id"),
            F.lit(LOAD_TS).cast("timestamp").alias("bronze_load_ts"))

    @staticmethod
    def _measurement_columns() -> list:
        start, k = hour_of(F.col("ts")), F.col("k")
        return [unless(k == 17, start).alias("datetime_from"),
                (start + F.expr("INTERVAL 1 HOUR")).alias("datetime_to"),
                unless(k == 13, F.col("value") * 2 - 5).cast("float").alias("value"),
                F.when(F.col("event_type") == "error", "00:30:00").otherwise("01:00:00")
                .alias("interval"),
                unless(k == 23, F.col("c_nationkey").cast("int")).alias("location_id"),
                unless(k == 19, F.col("user_id")).alias("sensor_id"), "event_id"]

    @staticmethod
    def _weather_columns(hashed: bool = True) -> list:
        faults = {"location_id": 29, "datetime": 31, "temperature_2m": 37, "surface_pressure": 41}
        named = ["location_id", "datetime", *gold.WEATHER_MEASURES]
        columns = Lake._weather_columns(hashed)
        return [unless(F.col("k") == faults[n], c).alias(n) if n in faults else c
                for n, c in zip(named, columns)] + columns[len(named):]

    def weather_documents(self) -> DataFrame:
        rows, lost = super().weather_documents(), F.col("latitude") > 20
        return rows.withColumns({"longitude": unless(lost, F.col("longitude")),
                                 "latitude": unless(lost, F.col("latitude"))})

    @property
    def calendar(self) -> DataFrame:
        return dims.rolling_calendar(self.spark, 5, CALENDAR_END)


def _dropping(rows: str, rules: dict[str, str]):
    def query(spark, sf_dir):
        return R.drop_failing(getattr(RawFeeds(spark, sf_dir), rows)(), rules).drop("bronze_load_ts")

    query.__doc__ = f"The {rows} of the raw feeds that pass every rule."
    return query


def q_rules_counts_raw(spark, sf_dir):
    """Failing rows of every rule of the five sets."""
    lk = RawFeeds(spark, sf_dir)
    parts = [
        R.count_failing(lk.location_rows(), R.LOCATION_RULES, "locations"),
        R.count_failing(lk.parameter_rows(), R.PARAMETER_RULES, "parameters"),
        R.count_failing(lk.sensor_rows(), R.SENSOR_RULES, "sensors"),
        R.count_failing_sets(lk.both_feeds(), [("measurements", R.MEASUREMENT_RULES, None),
                                               ("weather", R.WEATHER_RULES, "weather")])]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_orphan_audit_raw(spark, sf_dir):
    """The nine declared references over the raw feeds' facts and what the rules
    left of the dimensions; each fact is read once."""
    lk = RawFeeds(spark, sf_dir)
    calendar, hours = lk.calendar, dims.time_of_day(spark)
    relations = [("fct_pollution", lk.fct_pollution, c, p, t) for c, p, t in (
        ("sensor_id", "dim_pollution_sensors", lk.dim_sensors),
        ("location_id", "dim_pollution_locations", lk.dim_locations),
        ("date_int", "dim_calendar", calendar), ("time_int", "dim_time", hours))]
    relations += [("fct_weather", lk.fct_weather, c, p, t) for c, p, t in (
        ("location_id", "dim_weather_locations", lk.dim_weather_locations),
        ("date_int", "dim_calendar", calendar), ("time_int", "dim_time", hours))]
    relations += [("dim_pollution_sensors", lk.dim_sensors, c, p, t) for c, p, t in (
        ("location_id", "dim_pollution_locations", lk.dim_locations),
        ("parameter_id", "dim_pollution_parameters", lk.dim_parameters))]
    return audit.orphan_audit([(f"{child}.{c} -> {parent}", rows, c, t, c)
                               for child, rows, c, parent, t in relations])


def q_backfill_until_yesterday(spark, sf_dir):
    """Chunks to fetch up to the day before a given day, of locations whose names
    hold spaces."""
    lk = RawFeeds(spark, sf_dir)
    return planning.backfill_worklist(lk.dim_locations, lk.dim_sensors, lk.dim_parameters,
                                      lk.fct_pollution, BACKFILL_FROM, None, PLAN_PARAMETERS,
                                      today=TODAY)


RAW_QUERIES = {
    "rules_drop_locations": _dropping("location_rows", R.LOCATION_RULES),
    "rules_drop_parameters": _dropping("parameter_rows", R.PARAMETER_RULES),
    "rules_drop_sensors": _dropping("sensor_rows", R.SENSOR_RULES),
    "rules_drop_measurements": _dropping("measurement_feed", R.MEASUREMENT_RULES),
    "rules_drop_weather": _dropping("weather_feed", R.WEATHER_RULES),
    "rules_counts_raw": q_rules_counts_raw,
    "orphan_audit_raw": q_orphan_audit_raw,
    "backfill_until_yesterday": q_backfill_until_yesterday,
}
