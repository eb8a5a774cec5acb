"""DuckDB SQL of the queries over faulty records, named files and written tables."""

from __future__ import annotations

from .oracle import (BACKFILL, CALENDAR, DAILY, FCT_POLLUTION, FCT_WEATHER, FEED, HOURLY,
                     HOURLY_BY_CITY, LOC_SENSORS, POLLUTION, TIME,
                     WEATHER, WEATHER_HOURLY, WEATHER_LOCATIONS, _orphan_part, _with)

RAW_EVENTS = """
raw_events AS (
  SELECT *, coalesce(TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER), -1) AS k,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events
)"""

RAW_ROWS = """
raw_locations AS (
  SELECT CASE WHEN n.n_name <> 'NATION_13' THEN CAST(n.n_nationkey AS INTEGER) END AS location_id,
         CASE WHEN n.n_name NOT LIKE '%7' THEN replace(n.n_name, '_', ' ') END AS name,
         r.r_name AS locality, n.n_name AS country,
         CASE WHEN NOT (n.n_name LIKE '%2' AND r.r_name = 'ASIA') THEN r.r_name END AS city,
         CAST(NULL AS BOOLEAN) AS is_mobile, CAST(NULL AS BOOLEAN) AS is_monitor,
         CAST(n.n_nationkey AS FLOAT) AS latitude, CAST(n.n_regionkey AS FLOAT) AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
segments AS (
  SELECT c_mktsegment, CAST(min(c_custkey) AS INTEGER) AS segment_id FROM customer
  WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
),
raw_parameters AS (
  SELECT CASE WHEN NOT (c_acctbal > 9900) THEN segment_id END AS parameter_id,
         c_mktsegment AS display_name,
         CASE WHEN NOT (c_acctbal BETWEEN -800 AND -700) THEN lower(c_mktsegment) END AS name,
         CAST(NULL AS VARCHAR) AS units
  FROM customer JOIN segments USING (c_mktsegment)
),
raw_sensors AS (
  SELECT CASE WHEN NOT (c_acctbal < -900) THEN c_custkey END AS sensor_id, c_name AS name,
         CASE WHEN NOT (c_acctbal >= -900 AND c_acctbal < -800) THEN CAST(c_nationkey AS INTEGER) END AS location_id,
         CASE WHEN NOT (c_acctbal > 9900) THEN segment_id END AS parameter_id
  FROM customer LEFT JOIN segments USING (c_mktsegment)
)"""

# The faulty measurement feed under the names that the shared CTEs use.
RAW_FEED = """
feed AS (
  SELECT CASE WHEN k <> 17 THEN hour END AS datetime_from,
         CAST(hour + INTERVAL 1 HOUR AS TIMESTAMP) AS datetime_to,
         CAST(CASE WHEN k <> 13 THEN value * 2 - 5 END AS FLOAT) AS value,
         CASE WHEN event_type = 'error' THEN '00:30:00' ELSE '01:00:00' END AS "interval",
         CASE WHEN k <> 23 THEN CAST(c_nationkey AS INTEGER) END AS location_id,
         CASE WHEN k <> 19 THEN user_id END AS sensor_id, event_id
  FROM raw_events e LEFT JOIN customer c ON e.user_id = c.c_custkey
),
""" + FEED[FEED.index("clean AS"):]
RAW_FCT_POLLUTION = RAW_FEED + FCT_POLLUTION[len(FEED):]

RAW_WFEED = """
wfeed AS (
  SELECT CASE WHEN k <> 29 AND c.c_nationkey IS NOT NULL AND n.n_regionkey IS NOT NULL THEN
           sha256(concat_ws('|', CAST(CAST(c.c_nationkey AS DOUBLE) AS VARCHAR),
                                 CAST(CAST(n.n_regionkey AS DOUBLE) AS VARCHAR))) END AS location_id,
         CASE WHEN k <> 31 THEN hour END AS datetime,
         CAST(NULL AS FLOAT) AS apparent_temperature, CAST(NULL AS FLOAT) AS precipitation,
         CAST(NULL AS INTEGER) AS relative_humidity_2m,
         CASE WHEN k <> 37 THEN CAST(e.value AS FLOAT) END AS temperature_2m,
         CAST(NULL AS INTEGER) AS wind_direction_100m,
         CAST(CAST(floor(e.value) AS INTEGER) % 360 AS INTEGER) AS wind_direction_10m,
         CAST(NULL AS FLOAT) AS wind_gusts_10m, CAST(NULL AS FLOAT) AS wind_speed_100m,
         CAST(e.value / 10 AS FLOAT) AS wind_speed_10m,
         CASE WHEN k <> 41 THEN CAST(e.value AS FLOAT) END AS surface_pressure, e.event_id
  FROM raw_events e LEFT JOIN customer c ON e.user_id = c.c_custkey
                    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""
RAW_WEATHER = RAW_WFEED + ",\n" + FCT_WEATHER[FCT_WEATHER.index("fct_weather AS"):]
# What the rules leave of the dimensions.
RAW_DIMS = """
dim_locations AS (SELECT * FROM raw_locations
  WHERE location_id IS NOT NULL AND name IS NOT NULL AND city IS NOT NULL),
dim_parameters AS (SELECT DISTINCT * FROM raw_parameters WHERE parameter_id IS NOT NULL AND name IS NOT NULL),
dim_sensors AS (SELECT * FROM raw_sensors
  WHERE sensor_id IS NOT NULL AND location_id IS NOT NULL AND parameter_id IS NOT NULL)"""
RAW_WEATHER_LOCATIONS = WEATHER_LOCATIONS.replace("WHERE latitude IS NOT NULL", "WHERE latitude <= 20 AND latitude IS NOT NULL")


def _calendar(last: str) -> str:
    """The calendar of the five years up to the date ``last``."""
    days = f"""
cal_days AS (
  SELECT CAST(unnest(generate_series(CAST({last} - INTERVAL 60 MONTH AS DATE), CAST({last} AS DATE),
                                     INTERVAL 1 DAY)) AS DATE) AS d
)"""
    return days + "," + CALENDAR[CALENDAR.index("\ndim_calendar AS"):]


def _failed(rule_set: str, rows: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule_set}' AS rule_set, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE NOT coalesce({test}, false)) AS failed_rows, "
        f"count(*) AS total_rows FROM {rows}" for rule, test in rules.items())


def _given(*columns: str) -> dict[str, str]:
    return {f"{c} is not null": f"{c} IS NOT NULL" for c in columns}


_MEASUREMENT = {"period interval is 1 hour": "\"interval\" = '01:00:00'",
                **_given("datetime_from", "value", "location_id", "sensor_id"),
                "value is sensible": "value > 0 AND value < 800"}

RAW_SQL: dict[str, str] = {
    "rules_drop_locations": _with(RAW_ROWS, RAW_DIMS) + "SELECT * FROM dim_locations",
    "rules_drop_parameters": _with(RAW_ROWS) + """
SELECT * FROM raw_parameters WHERE parameter_id IS NOT NULL AND name IS NOT NULL""",
    "rules_drop_sensors": _with(RAW_ROWS, RAW_DIMS) + "SELECT * FROM dim_sensors",
    "rules_drop_measurements": _with(RAW_EVENTS, RAW_FEED) + "SELECT * FROM clean",
    "rules_drop_weather": _with(RAW_EVENTS, RAW_WFEED) + """
SELECT * FROM wfeed WHERE location_id IS NOT NULL AND datetime IS NOT NULL AND temperature_2m IS NOT NULL
  AND surface_pressure IS NOT NULL""",
    "rules_counts_raw": _with(RAW_EVENTS, RAW_ROWS, RAW_FEED, RAW_WFEED) + " UNION ALL ".join([
        _failed("locations", "raw_locations", _given("location_id", "name", "city")),
        _failed("parameters", "raw_parameters", _given("parameter_id", "name")),
        _failed("sensors", "raw_sensors", _given("sensor_id", "location_id", "parameter_id")),
        _failed("measurements", "feed", _MEASUREMENT),
        _failed("weather", "wfeed", _given("location_id", "datetime", "temperature_2m",
                                           "surface_pressure"))]),
    "orphan_audit_raw": _with(RAW_EVENTS, RAW_ROWS, RAW_DIMS, RAW_FCT_POLLUTION, RAW_WEATHER,
                              RAW_WEATHER_LOCATIONS, TIME, _calendar("DATE '2024-01-20'"))
    + " UNION ALL ".join(
        _orphan_part(f"{child}.{c} -> {name}", rows, c, parent, c) for child, rows, c, name, parent in (
            ("fct_pollution", "fct_pollution", "sensor_id", "dim_pollution_sensors", "dim_sensors"),
            ("fct_pollution", "fct_pollution", "location_id", "dim_pollution_locations", "dim_locations"),
            ("fct_pollution", "fct_pollution", "date_int", "dim_calendar", "dim_calendar"),
            ("fct_pollution", "fct_pollution", "time_int", "dim_time", "dim_time"),
            ("fct_weather", "fct_weather", "location_id", "dim_weather_locations", "dim_weather_locations"),
            ("fct_weather", "fct_weather", "date_int", "dim_calendar", "dim_calendar"),
            ("fct_weather", "fct_weather", "time_int", "dim_time", "dim_time"),
            ("dim_pollution_sensors", "dim_sensors", "location_id", "dim_pollution_locations", "dim_locations"),
            ("dim_pollution_sensors", "dim_sensors", "parameter_id", "dim_pollution_parameters",
             "dim_parameters"))),
    "backfill_until_yesterday": _with(
        RAW_EVENTS, RAW_ROWS, RAW_DIMS, RAW_FCT_POLLUTION, LOC_SENSORS,
        BACKFILL.replace("2024-06-15", "2024-02-09").replace("20240615", "20240209")) + """
SELECT w.* FROM work w
WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE f.location_id = w.location_id
                  AND f.sensor_id = w.sensor_id AND f.period_from = w.period_from)""",
}

# --- documents as files -----------------------------------------------------------------
STATIONS = """
stations AS (
  SELECT c_nationkey, c_mktsegment, min(c_custkey) AS station FROM customer
  WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY ALL
),
users AS (
  SELECT c.c_custkey AS user_id, c.c_nationkey, s.station,
         s.station = min(s.station) OVER (PARTITION BY c.c_nationkey) AS first
  FROM customer c JOIN stations s ON c.c_nationkey = s.c_nationkey AND c.c_mktsegment = s.c_mktsegment
),
mid AS (SELECT (min(event_id) + max(event_id)) // 2 AS mid FROM events),
records AS (
  SELECT CASE WHEN event_id < mid THEN 1 ELSE 2 END AS round, u.first,
         event_id // 100000 * 2 + CASE WHEN event_id < mid THEN 1 ELSE 2 END AS page, e.ts, event_id,
         CASE WHEN k <> 17 THEN hour END AS datetime_from,
         CAST(CASE WHEN k <> 13 THEN value * 2 - 5 END AS FLOAT) AS value,
         CASE WHEN event_type = 'error' THEN '00:30:00' ELSE '01:00:00' END AS "interval",
         CAST(u.c_nationkey AS INTEGER) AS location_id, CAST(u.station AS INTEGER) AS sensor_id
  FROM raw_events e JOIN users u ON e.user_id = u.user_id JOIN nation n ON n.n_nationkey = u.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey, mid
),
pages AS (
  SELECT location_id, sensor_id, date_trunc('month', ts) AS month, page, round, first FROM records GROUP BY ALL
)"""

STATION_FACT = """
clean AS (
  SELECT * FROM records WHERE "interval" = '01:00:00' AND datetime_from IS NOT NULL AND value > 0 AND value < 800
)""" + FCT_POLLUTION[len(FEED):]

STATION_WEATHER = """
whours AS (
  SELECT CAST(c.c_nationkey AS INTEGER) AS nation, e.hour,
         CASE WHEN k <> 37 THEN value END AS temperature, CASE WHEN k <> 41 THEN value END AS pressure
  FROM raw_events e JOIN customer c ON e.user_id = c.c_custkey
  QUALIFY row_number() OVER (PARTITION BY c.c_nationkey, e.hour ORDER BY event_id) = 1
),
wplaces AS (
  SELECT nation, r.r_name, n.n_regionkey,
         sha256(concat_ws('|', CAST(CAST(nation AS DOUBLE) AS VARCHAR),
                               CAST(CAST(n.n_regionkey AS DOUBLE) AS VARCHAR))) AS location_id
  FROM (SELECT DISTINCT nation FROM whours) JOIN nation n ON n.n_nationkey = nation
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

RAW_SQL["lake_measurements"] = _with(RAW_EVENTS, STATIONS, STATION_FACT) + "SELECT * FROM fct_pollution"
RAW_SQL["lake_rule_metrics"] = _with(RAW_EVENTS, STATIONS) + _failed(
    "measurements", "records", _MEASUREMENT) + """
UNION ALL SELECT 'measurements_files', 'document is complete', count(*) FILTER (WHERE first AND round = 1),
  count(*) + count(*) FILTER (WHERE first AND round = 1) FROM pages"""
RAW_SQL["lake_weather"] = _with(RAW_EVENTS, STATION_WEATHER) + """
SELECT sha256(concat_ws('|', location_id, strftime(hour, '%Y-%m-%d %H:%M:%S'))) AS id, location_id,
       CAST(year(hour) * 10000 + month(hour) * 100 + day(hour) AS INTEGER) AS date_int,
       CAST(strftime(hour, '%H%M') AS INTEGER) AS time_int,
       CAST(NULL AS FLOAT) AS apparent_temperature, CAST(NULL AS FLOAT) AS precipitation,
       CAST(NULL AS INTEGER) AS relative_humidity_2m, CAST(temperature AS FLOAT) AS temperature_2m,
       CAST(NULL AS INTEGER) AS wind_direction_100m, CAST(NULL AS INTEGER) AS wind_direction_10m,
       CAST(NULL AS FLOAT) AS wind_gusts_10m, CAST(NULL AS FLOAT) AS wind_speed_100m,
       CAST(NULL AS FLOAT) AS wind_speed_10m, CAST(pressure AS FLOAT) AS surface_pressure
FROM whours JOIN wplaces USING (nation) WHERE nation <= 20 AND temperature IS NOT NULL AND pressure IS NOT NULL"""
RAW_SQL["lake_weather_locations"] = _with(RAW_EVENTS, STATION_WEATHER) + """
SELECT location_id, CAST(nation AS FLOAT) AS latitude, CAST(n_regionkey AS FLOAT) AS longitude,
       r_name || '-' || CAST(nation AS VARCHAR) AS city, 'GMT' AS timezone,
       CAST(CASE WHEN nation <= 12 THEN 100 ELSE 200 END AS FLOAT) AS elevation
FROM wplaces WHERE nation <= 20"""
RAW_SQL["lake_locations"] = """
SELECT CAST(n_nationkey AS INTEGER) AS location_id,
       CASE WHEN n_regionkey <= 2 AND n_name NOT LIKE '%7' THEN '' ELSE 'Old ' END || replace(n_name, '_', ' ') AS name,
       r_name AS locality, n_name AS country, r_name AS city, CAST(NULL AS BOOLEAN) AS is_mobile,
       CAST(NULL AS BOOLEAN) AS is_monitor, CAST(n_nationkey AS FLOAT) AS latitude,
       CAST(n_regionkey AS FLOAT) AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_13'"""
RAW_SQL["lake_sensors"] = _with(RAW_ROWS, STATIONS.split("users AS")[0].rstrip().rstrip(",")) + """
SELECT CAST(station AS INTEGER) AS sensor_id, c_name AS name, CAST(s.c_nationkey AS INTEGER) AS location_id,
       segment_id AS parameter_id
FROM stations s JOIN customer c ON c.c_custkey = station JOIN segments g ON g.c_mktsegment = s.c_mktsegment
JOIN nation ON n_nationkey = s.c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE n_name <> 'NATION_13'"""
RAW_SQL["download_files"] = _with(RAW_EVENTS, STATIONS, STATION_WEATHER) + """
SELECT 'locations' AS feed, count(DISTINCT n_regionkey) AS files, 0 AS cut_off, count(*) AS records,
       count(*) AS stamped, CAST(1 AS INTEGER) AS files_per_batch
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'measurements', count(*) + count(*) FILTER (WHERE first), count(*) FILTER (WHERE first),
       (SELECT count(*) FROM records WHERE round = 1), (SELECT count(*) FROM records WHERE round = 1), NULL
FROM pages WHERE round = 1
UNION ALL SELECT 'weather', count(*), 0, count(*), count(*), NULL
FROM (SELECT DISTINCT nation, date_trunc('month', hour) FROM whours JOIN wplaces USING (nation) WHERE nation <= 12)"""
RAW_SQL["ingest_inferred"] = """
SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_name AS name,
       CASE WHEN s_acctbal >= 4500 THEN n_name END AS country,
       CAST(CASE WHEN s_acctbal < 4500 THEN floor(s_acctbal) ELSE s_acctbal END AS DOUBLE) AS elevation,
       CASE WHEN s_acctbal >= 4500 THEN 2 END AS n_tags,
       CASE WHEN s_acctbal < 4500 THEN 1 ELSE 2 END AS schema_version
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

# --- written tables ---------------------------------------------------------------------
RAW_SQL["create_if_absent"] = _with(FCT_POLLUTION) + """
SELECT id, date_int, time_int, value, location_id, CAST(sensor_id AS INTEGER) AS sensor_id,
       'true,false' AS made FROM fct_pollution"""
RAW_SQL["dim_calendar_rolling"] = _with(_calendar("(SELECT CAST(max(ts) AS DATE) FROM events)")) + """
SELECT *, CAST(row_number() OVER (ORDER BY date_int) AS INTEGER) AS load_order FROM dim_calendar"""
RAW_SQL["dim_time_table"] = _with(TIME) + """
SELECT t.*, CAST(row_number() OVER (ORDER BY t.time_int) AS INTEGER) AS load_order, n_events
FROM dim_time t LEFT JOIN (SELECT CAST(strftime(date_trunc('hour', ts), '%H%M') AS INTEGER) AS time_int,
  count(*) AS n_events FROM events GROUP BY ALL) e ON e.time_int = t.time_int"""
_MONTHLY = """
monthly AS (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS date, location_id, parameter FROM daily)"""
RAW_SQL["lake_tables"] = _with(POLLUTION, CALENDAR, TIME, WEATHER, HOURLY, HOURLY_BY_CITY, DAILY,
                               _MONTHLY, WEATHER_HOURLY) + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {first}) AS n_first FROM {rows}"
    for name, rows, first in (
        ("dim_pollution_locations", "dim_locations", "location_id"),
        ("dim_pollution_parameters", "dim_parameters", "parameter_id"),
        ("dim_pollution_sensors", "dim_sensors", "sensor_id"),
        ("dim_weather_locations", "dim_weather_locations", "location_id"),
        ("dim_calendar", "dim_calendar", "date_int"), ("dim_time", "dim_time", "time_int"),
        ("fct_pollution", "fct_pollution", "id"), ("fct_weather", "fct_weather", "id"),
        ("agg_pollution_daily", "daily", "date"), ("agg_pollution_monthly", "monthly", "date"),
        ("agg_pollution_hourly", "hourly", "date_int"),
        ("agg_pollution_hourly_by_city", "hourly_by_city", "date_int"),
        ("agg_weather_hourly", "weather_hourly", "date_int")))
