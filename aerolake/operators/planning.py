"""Planning queries: what has been ingested, and what still has to be
fetched.  They replace the download scripts' file-existence checks with
joins over tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_from_int
from ..functions.periods import chunk_name, quarter_periods

# Parameters whose sensors are fetched by default.
DEFAULT_PARAMETERS = ["pm10", "pm25", "co", "so2"]

# Sensors of one location are listed in blocks of sensor ids this wide, so one
# work-list row (one download task) never carries an unbounded array.  Every
# sensor is listed; a location with more sensors simply gets more rows, told
# apart by their ``sensor_block``.
SENSOR_BLOCK = 1000


def high_water_by_location(fct_weather: DataFrame, weather_locations: DataFrame,
                           on: str = "location_id") -> DataFrame:
    """Latest ingested date per weather location (city, latitude, longitude).

    Facts are reduced to one row per location before the join, which is on column
    ``on``: the hashed id or the coordinates that it hashes.
    """
    latest = fct_weather.groupBy(on).agg(F.max("date_int").alias("max_date_int"))
    loc = weather_locations.select(on, "city", "latitude", "longitude")
    return (latest.join(loc, on)
            .groupBy("city", "latitude", "longitude")
            .agg(date_from_int(F.max("max_date_int")).alias("last_date")))


def location_sensors(locations: DataFrame, sensors: DataFrame, parameters: DataFrame,
                     parameter_names: list[str], city: str | None = None) -> DataFrame:
    """(location id, name, city, sensor id) for sensors measuring one of
    ``parameter_names``; optionally only locations of ``city``."""
    loc = locations.select(F.col("location_id").alias("id"), "name", "city")
    if city is not None:
        loc = loc.filter(F.col("city") == F.lit(city))
    par = parameters.filter(F.col("name").isin(list(parameter_names))).select("parameter_id")
    sen = sensors.select("sensor_id", F.col("location_id").alias("id"), "parameter_id")
    return loc.join(sen, "id").join(par, "parameter_id").select("id", "name", "city", "sensor_id")


def _sensor_lists(pairs: DataFrame, extra: list[Column] = ()) -> DataFrame:
    block = F.floor(F.col("sensor_id") / F.lit(SENSOR_BLOCK)).alias("sensor_block")
    return (pairs.groupBy("id", "name", block)
            .agg(F.sort_array(F.collect_list("sensor_id")).alias("sensor_id_arr"))
            .select("id", "name", "sensor_block", *extra, "sensor_id_arr"))


def high_water_worklist(locations: DataFrame, sensors: DataFrame, parameters: DataFrame,
                        fct_pollution: DataFrame,
                        parameter_names: list[str] = DEFAULT_PARAMETERS,
                        per_location: bool = False) -> DataFrame:
    """Per location: its sensor list and the latest ingested date.

    By default the latest date is one global maximum over the facts (NULL
    on an empty fact), attached as a scalar subquery -- evaluated once, no
    join.  ``per_location`` uses each location's own latest date instead
    (facts reduced to one row per location first; NULL if it has none).
    """
    pairs = location_sensors(locations, sensors, parameters, parameter_names)
    if not per_location:
        last_date = fct_pollution.select(date_from_int(F.max("date_int"))).scalar()
        return _sensor_lists(pairs, [last_date.alias("last_date")])
    latest = (fct_pollution.groupBy(F.col("location_id").alias("id"))
              .agg(date_from_int(F.max("date_int")).alias("last_date")))
    lists = _sensor_lists(pairs)
    return (lists.join(latest, "id", "left")
            .select("id", "name", "sensor_block", "last_date", "sensor_id_arr"))


def sensors_by_city(locations: DataFrame, sensors: DataFrame, parameters: DataFrame, city: str,
                    parameter_names: list[str] = DEFAULT_PARAMETERS) -> DataFrame:
    """Backfill list for one city: location id, sensor list, location name."""
    pairs = location_sensors(locations, sensors, parameters, parameter_names, city)
    return _sensor_lists(pairs).select("id", "sensor_block", "sensor_id_arr", "name")


def period_start_of(day: Column, date_from: Column) -> Column:
    """Start of the quarter-bounded request period that contains ``day``."""
    qs = F.trunc(day, "quarter")
    return F.when(F.date_sub(qs, 1) > date_from, qs).otherwise(date_from)


def yesterday(today: str | None = None) -> str:
    """Default end of a request range: the last complete day before ``today``
    (ISO date; default: the current UTC day)."""
    day = date.fromisoformat(today) if today else datetime.now(timezone.utc).date()
    return (day - timedelta(days=1)).isoformat()


def backfill_worklist(locations: DataFrame, sensors: DataFrame, parameters: DataFrame,
                      fct_pollution: DataFrame, date_from: str, date_to: str | None = None,
                      parameter_names: list[str] = DEFAULT_PARAMETERS,
                      city: str | None = None, today: str | None = None) -> DataFrame:
    """Chunks (location, sensor, period) still to fetch in [date_from, date_to];
    without ``date_to`` up to the day before ``today``.

    Work = every selected sensor x every quarter-bounded period, generated
    per sensor row from an array expression (no cross join).  Finished =
    chunks that already have fact rows: facts in range (only location, sensor
    and ``date_int`` are read, and repeated readings do not matter) are
    reduced to distinct (location, sensor, period start) -- partial
    aggregation -- and removed with an anti-join.
    """
    date_to = date_to or yesterday(today)
    f = F.lit(date_from).cast("date")
    t = F.lit(date_to).cast("date")
    pairs = location_sensors(locations, sensors, parameters, parameter_names, city)
    work = (pairs.select("id", "name", "sensor_id", F.explode(quarter_periods(f, t)).alias("p"))
            .select(F.col("id").alias("location_id"), "sensor_id",
                    F.col("p.period_from").alias("period_from"),
                    F.col("p.period_to").alias("period_to"),
                    chunk_name(F.col("id"), F.col("sensor_id"), F.col("name"),
                               F.col("p.period_from"), F.col("p.period_to")).alias("chunk_name")))
    lo = int(date_from.replace("-", ""))
    hi = int(date_to.replace("-", ""))
    finished = (fct_pollution.filter(F.col("date_int").between(lo, hi))
                .select("location_id", "sensor_id",
                        period_start_of(date_from_int(F.col("date_int")), f).alias("period_from"))
                .distinct())
    return work.join(finished, ["location_id", "sensor_id", "period_from"], "left_anti")
