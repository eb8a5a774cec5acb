"""DuckDB SQL equivalents of the registered queries (the correctness
oracle).  Tables are the driver's views of the same names."""

from __future__ import annotations

# --- shared CTEs -------------------------------------------------------------
LOCATIONS = """
dim_locations AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, n.n_name AS name, r.r_name AS locality,
         n.n_name AS country, r.r_name AS city,
         CAST(NULL AS BOOLEAN) AS is_mobile, CAST(NULL AS BOOLEAN) AS is_monitor,
         CAST(n.n_nationkey AS FLOAT) AS latitude, CAST(n.n_regionkey AS FLOAT) AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey IS NOT NULL AND n.n_name IS NOT NULL AND r.r_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY n.n_nationkey ORDER BY n.n_name DESC) = 1
)"""

PARAMETERS = """
dim_parameters AS (
  SELECT CAST(min(c_custkey) AS INTEGER) AS parameter_id,
         c_mktsegment AS display_name, lower(c_mktsegment) AS name, CAST(NULL AS VARCHAR) AS units
  FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
)"""

# Parameters numbered in the order of their segments.
RANKED_PARAMETERS = """
dim_parameters AS (
  SELECT CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS parameter_id,
         c_mktsegment AS display_name, lower(c_mktsegment) AS name, CAST(NULL AS VARCHAR) AS units
  FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)
)"""

SENSORS = """
dim_sensors AS (
  SELECT c.c_custkey AS sensor_id, c.c_name AS name, CAST(c.c_nationkey AS INTEGER) AS location_id,
         p.parameter_id
  FROM customer c LEFT JOIN dim_parameters p ON p.display_name = c.c_mktsegment
  WHERE c.c_custkey IS NOT NULL AND c.c_nationkey IS NOT NULL AND p.parameter_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY c.c_custkey ORDER BY c.c_name DESC) = 1
)"""

FEED = """
feed AS (
  SELECT CAST(date_trunc('hour', e.ts) AS TIMESTAMP) AS datetime_from,
         CAST(date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS datetime_to,
         CAST(e.value AS FLOAT) AS value, '01:00:00' AS "interval",
         CAST(c.c_nationkey AS INTEGER) AS location_id, e.user_id AS sensor_id, e.event_id
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
),
clean AS (
  SELECT * FROM feed
  WHERE "interval" = '01:00:00' AND datetime_from IS NOT NULL AND value IS NOT NULL
    AND location_id IS NOT NULL AND sensor_id IS NOT NULL AND value > 0 AND value < 800
)"""

FCT_POLLUTION = FEED + """,
fct_pollution AS (
  SELECT id, date_int, time_int, value, location_id, sensor_id FROM (
    SELECT sha256(concat_ws('|', CAST(sensor_id AS VARCHAR), CAST(location_id AS VARCHAR),
                            strftime(datetime_from, '%Y-%m-%d %H:%M:%S'))) AS id,
           CAST(year(datetime_from) * 10000 + month(datetime_from) * 100 + day(datetime_from) AS INTEGER) AS date_int,
           CAST(strftime(datetime_from, '%H%M') AS INTEGER) AS time_int,
           value, location_id, sensor_id, event_id
    FROM clean)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id) = 1
)"""

CALENDAR = """
cal_days AS (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
  FROM events
),
dim_calendar AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_int,
         d AS calendar_date,
         CAST(year(d) AS INTEGER) AS calendar_year,
         strftime(d, '%B') AS calendar_month,
         CAST(month(d) AS INTEGER) AS month_of_year,
         strftime(d, '%A') AS calendar_day,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         CAST(isodow(d) AS INTEGER) AS day_of_week_start_monday,
         CASE WHEN isodow(d) <= 5 THEN 'Y' ELSE 'N' END AS is_week_day,
         CAST(day(d) AS INTEGER) AS day_of_month,
         CASE WHEN d = last_day(d) THEN 'Y' ELSE 'N' END AS is_last_day_of_month,
         CAST(dayofyear(d) AS INTEGER) AS day_of_year,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year_iso,
         CAST(quarter(d) AS INTEGER) AS quarter_of_year,
         CAST(CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year_oct_to_sep,
         CAST((month(d) + 2) % 12 + 1 AS INTEGER) AS fiscal_month_oct_to_sep,
         CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year_jul_to_jun,
         CAST((month(d) + 5) % 12 + 1 AS INTEGER) AS fiscal_month_jul_to_jun
  FROM cal_days
)"""

TIME = """
dim_time AS (
  SELECT CAST(strftime(t, '%H%M') AS INTEGER) AS time_int,
         strftime(t, '%I:%M %p') AS "time",
         strftime(t, '%I') AS "hour",
         strftime(t, '%H:%M') AS time_24,
         CASE WHEN hour(t) = 0 THEN '24' ELSE strftime(t, '%H') END AS hour_24,
         strftime(t, '%p') AS am_pm
  FROM (SELECT unnest(generate_series(TIMESTAMP '1900-01-01 00:00:00', TIMESTAMP '1900-01-01 23:59:00',
                                      INTERVAL 1 HOUR)) AS t)
)"""

WEATHER_LOCATIONS = """
wdocs AS (
  SELECT CAST(n.n_nationkey AS DOUBLE) AS latitude, CAST(n.n_regionkey AS DOUBLE) AS longitude,
         r.r_name AS city, 'GMT' AS timezone, s.s_acctbal AS elevation, s.s_suppkey AS load_order
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_weather_locations AS (
  SELECT sha256(concat_ws('|', CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR))) AS location_id,
         CAST(latitude AS FLOAT) AS latitude, CAST(longitude AS FLOAT) AS longitude, city, timezone,
         CAST(elevation AS FLOAT) AS elevation
  FROM wdocs
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude ORDER BY load_order DESC) = 1
)"""

FCT_WEATHER = """
wfeed AS (
  SELECT CASE WHEN c.c_nationkey IS NOT NULL AND n.n_regionkey IS NOT NULL THEN
           sha256(concat_ws('|', CAST(CAST(c.c_nationkey AS DOUBLE) AS VARCHAR),
                                 CAST(CAST(n.n_regionkey AS DOUBLE) AS VARCHAR))) END AS location_id,
         CAST(date_trunc('hour', e.ts) AS TIMESTAMP) AS datetime,
         CAST(NULL AS FLOAT) AS apparent_temperature, CAST(NULL AS FLOAT) AS precipitation,
         CAST(NULL AS INTEGER) AS relative_humidity_2m, CAST(e.value AS FLOAT) AS temperature_2m,
         CAST(NULL AS INTEGER) AS wind_direction_100m,
         CAST(CAST(floor(e.value) AS INTEGER) % 360 AS INTEGER) AS wind_direction_10m,
         CAST(NULL AS FLOAT) AS wind_gusts_10m, CAST(NULL AS FLOAT) AS wind_speed_100m,
         CAST(e.value / 10 AS FLOAT) AS wind_speed_10m, CAST(e.value AS FLOAT) AS surface_pressure,
         e.event_id
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
                LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
fct_weather AS (
  SELECT id, location_id, date_int, time_int, apparent_temperature, precipitation,
         relative_humidity_2m, temperature_2m, wind_direction_100m, wind_direction_10m,
         wind_gusts_10m, wind_speed_100m, wind_speed_10m, surface_pressure FROM (
    SELECT sha256(concat_ws('|', location_id, strftime(datetime, '%Y-%m-%d %H:%M:%S'))) AS id,
           location_id,
           CAST(year(datetime) * 10000 + month(datetime) * 100 + day(datetime) AS INTEGER) AS date_int,
           CAST(strftime(datetime, '%H%M') AS INTEGER) AS time_int,
           apparent_temperature, precipitation, relative_humidity_2m, temperature_2m,
           wind_direction_100m, wind_direction_10m, wind_gusts_10m, wind_speed_100m,
           wind_speed_10m, surface_pressure, event_id
    FROM wfeed
    WHERE location_id IS NOT NULL AND datetime IS NOT NULL AND temperature_2m IS NOT NULL
      AND surface_pressure IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id) = 1
)"""

WEATHER_ROWS = """
weather_rows AS (
  SELECT sha256(concat_ws('|', CAST(CAST(label AS DOUBLE) AS VARCHAR), CAST(CAST(vec_id AS DOUBLE) AS VARCHAR))) AS location_id,
         CAST(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(pos - 1 AS BIGINT)) AS TIMESTAMP) AS datetime,
         CAST(NULL AS FLOAT) AS apparent_temperature,
         CAST(CASE WHEN pos <= len(embedding) // 2 THEN embedding[pos] END AS FLOAT) AS precipitation,
         CAST(NULL AS INTEGER) AS relative_humidity_2m, CAST(embedding[pos] AS FLOAT) AS temperature_2m,
         CAST(NULL AS INTEGER) AS wind_direction_100m, CAST(NULL AS INTEGER) AS wind_direction_10m,
         CAST(NULL AS FLOAT) AS wind_gusts_10m, CAST(NULL AS FLOAT) AS wind_speed_100m,
         CAST(NULL AS FLOAT) AS wind_speed_10m,
         CAST(embedding[len(embedding) + 1 - pos] AS FLOAT) AS surface_pressure
  FROM (SELECT label, vec_id, embedding, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
)"""

HOURLY = """
hourly AS (
  SELECT f.date_int, f.time_int, f.location_id, l.name AS location_name, l.country, l.city,
         l.latitude, l.longitude, p.name AS parameter, p.units, f.value
  FROM fct_pollution f
  JOIN dim_sensors s ON f.sensor_id = s.sensor_id
  JOIN dim_parameters p ON s.parameter_id = p.parameter_id
  JOIN dim_locations l ON f.location_id = l.location_id
)"""

HOURLY_BY_CITY = """
hourly_by_city AS (
  SELECT date_int, time_int, country, city, parameter, units,
         avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value
  FROM hourly GROUP BY date_int, time_int, country, city, parameter, units
)"""

DAILY = """
daily AS (
  SELECT c.calendar_date AS date, f.date_int, f.location_id, l.name AS location_name, l.country,
         l.city, l.latitude, l.longitude, p.name AS parameter, p.units,
         avg(f.value) AS avg_value, min(f.value) AS min_value, max(f.value) AS max_value
  FROM fct_pollution f
  JOIN dim_sensors s ON f.sensor_id = s.sensor_id
  JOIN dim_parameters p ON s.parameter_id = p.parameter_id
  JOIN dim_locations l ON f.location_id = l.location_id
  JOIN dim_calendar c ON f.date_int = c.date_int
  GROUP BY ALL
)"""

WEATHER_HOURLY = """
weather_hourly AS (
  SELECT f.date_int, f.time_int, f.location_id, l.city, l.latitude, l.longitude,
         f.apparent_temperature, f.precipitation, f.relative_humidity_2m, f.temperature_2m,
         f.wind_direction_100m, f.wind_direction_10m, f.wind_gusts_10m, f.wind_speed_100m,
         f.wind_speed_10m, f.surface_pressure,
         CASE WHEN f.wind_direction_10m >= 22.5 AND f.wind_direction_10m < 67.5 THEN 'NE'
              WHEN f.wind_direction_10m >= 67.5 AND f.wind_direction_10m < 112.5 THEN 'E'
              WHEN f.wind_direction_10m >= 112.5 AND f.wind_direction_10m < 157.5 THEN 'SE'
              WHEN f.wind_direction_10m >= 157.5 AND f.wind_direction_10m < 202.5 THEN 'S'
              WHEN f.wind_direction_10m >= 202.5 AND f.wind_direction_10m < 247.5 THEN 'SW'
              WHEN f.wind_direction_10m >= 247.5 AND f.wind_direction_10m < 292.5 THEN 'W'
              WHEN f.wind_direction_10m >= 292.5 AND f.wind_direction_10m < 337.5 THEN 'NW'
              ELSE 'N' END AS wind_direction_bucket
  FROM fct_weather f JOIN dim_weather_locations l ON f.location_id = l.location_id
)"""

POLLUTION_DIMS = ",".join([LOCATIONS, PARAMETERS, SENSORS])
POLLUTION = POLLUTION_DIMS + "," + FCT_POLLUTION
WEATHER = WEATHER_LOCATIONS + "," + FCT_WEATHER


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


PLAN_PARAMS_SQL = "('building', 'household', 'machinery')"

LOC_SENSORS = """
loc_sensors AS (
  SELECT l.location_id AS id, l.name, l.city, s.sensor_id
  FROM dim_locations l
  JOIN dim_sensors s ON l.location_id = s.location_id
  JOIN dim_parameters p ON s.parameter_id = p.parameter_id
  WHERE p.name IN """ + PLAN_PARAMS_SQL + """
)"""

BACKFILL = """
bounds AS (
  SELECT DATE '2023-11-15' AS f, DATE '2024-06-15' AS t
),
cuts AS (
  SELECT CAST(last_day(CAST(qs AS DATE) + INTERVAL 2 MONTH) AS DATE) AS q
  FROM bounds, (SELECT unnest(generate_series(CAST(date_trunc('quarter', f) AS TIMESTAMP),
                                              CAST(date_trunc('quarter', t) AS TIMESTAMP),
                                              INTERVAL 3 MONTH)) AS qs FROM bounds)
),
edges AS (
  SELECT CAST(f - INTERVAL 1 DAY AS DATE) AS e FROM bounds
  UNION SELECT q FROM cuts, bounds WHERE q > f AND q <= t
  UNION SELECT t FROM bounds
),
periods AS (
  SELECT CAST(prev + INTERVAL 1 DAY AS DATE) AS period_from, e AS period_to
  FROM (SELECT e, lag(e) OVER (ORDER BY e) AS prev FROM edges)
  WHERE prev IS NOT NULL
),
work AS (
  SELECT ls.id AS location_id, ls.sensor_id, p.period_from, p.period_to,
         concat_ws('_', CAST(ls.id AS VARCHAR), CAST(ls.sensor_id AS VARCHAR), replace(ls.name, ' ', '-'),
                   strftime(p.period_from, '%Y-%m-%d'), strftime(p.period_to, '%Y-%m-%d')) AS chunk_name
  FROM loc_sensors ls, periods p
),
finished AS (
  SELECT DISTINCT f.location_id, f.sensor_id,
         CASE WHEN CAST(date_trunc('quarter', d) AS DATE) - INTERVAL 1 DAY > b.f
              THEN CAST(date_trunc('quarter', d) AS DATE) ELSE b.f END AS period_from
  FROM (SELECT location_id, sensor_id, strptime(CAST(date_int AS VARCHAR), '%Y%m%d')::DATE AS d,
               date_int FROM fct_pollution) f, bounds b
  WHERE f.date_int BETWEEN 20231115 AND 20240615
)"""


def _key_audit_part(name, table, keys):
    kl = ", ".join(keys)
    nulls = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""
  SELECT '{name}' AS table_name, '{",".join(keys)}' AS key_columns,
         CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
         count(*) FILTER (WHERE n > 1) AS duplicate_keys,
         CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicate_keys,
         CAST(coalesce(sum(n) FILTER (WHERE null_key), 0) AS BIGINT) AS null_key_rows
  FROM (SELECT {kl}, count(*) AS n, bool_or({nulls}) AS null_key FROM {table} GROUP BY {kl})"""


def _orphan_part(relation, child, ccol, parent, pcol):
    return f"""
  SELECT '{relation}' AS relation, count(*) AS orphan_keys,
         CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows
  FROM (SELECT {ccol} AS k, count(*) AS n FROM {child} WHERE {ccol} IS NOT NULL GROUP BY {ccol}) c
  WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.k)"""


SQL: dict[str, str] = {
    "rules_drop": _with(FEED) + "SELECT * FROM clean",
    "rules_counts": _with(PARAMETERS, FEED, """
locrows AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, n.n_name AS name, r.r_name AS city
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
senrows AS (
  SELECT c.c_custkey AS sensor_id, CAST(c.c_nationkey AS INTEGER) AS location_id, p.parameter_id
  FROM customer c LEFT JOIN dim_parameters p ON p.display_name = c.c_mktsegment
),
wrows AS (
  SELECT CASE WHEN c.c_nationkey IS NOT NULL AND n.n_regionkey IS NOT NULL THEN 'k' END AS location_id,
         e.ts AS datetime, e.value AS temperature_2m, e.value AS surface_pressure
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
                LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)""") + """
SELECT 'locations' AS rule_set, rule, failed_rows, total_rows FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE NOT coalesce(location_id IS NOT NULL, false)) AS a,
         count(*) FILTER (WHERE NOT coalesce(name IS NOT NULL, false)) AS b,
         count(*) FILTER (WHERE NOT coalesce(city IS NOT NULL, false)) AS c
  FROM locrows) UNPIVOT (failed_rows FOR rule IN (a AS 'location_id is not null', b AS 'name is not null',
                                                   c AS 'city is not null'))
UNION ALL
SELECT 'parameters', rule, failed_rows, total_rows FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE parameter_id IS NULL) AS a,
         count(*) FILTER (WHERE name IS NULL) AS b
  FROM dim_parameters) UNPIVOT (failed_rows FOR rule IN (a AS 'parameter_id is not null', b AS 'name is not null'))
UNION ALL
SELECT 'sensors', rule, failed_rows, total_rows FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE sensor_id IS NULL) AS a,
         count(*) FILTER (WHERE location_id IS NULL) AS b,
         count(*) FILTER (WHERE parameter_id IS NULL) AS c
  FROM senrows) UNPIVOT (failed_rows FOR rule IN (a AS 'sensor_id is not null', b AS 'location_id is not null',
                                                   c AS 'parameter_id is not null'))
UNION ALL
SELECT 'measurements', rule, failed_rows, total_rows FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE NOT coalesce("interval" = '01:00:00', false)) AS a,
         count(*) FILTER (WHERE datetime_from IS NULL) AS b,
         count(*) FILTER (WHERE value IS NULL) AS c,
         count(*) FILTER (WHERE location_id IS NULL) AS d,
         count(*) FILTER (WHERE sensor_id IS NULL) AS e,
         count(*) FILTER (WHERE NOT coalesce(value > 0 AND value < 800, false)) AS f
  FROM feed) UNPIVOT (failed_rows FOR rule IN (a AS 'period interval is 1 hour', b AS 'datetime_from is not null',
      c AS 'value is not null', d AS 'location_id is not null', e AS 'sensor_id is not null',
      f AS 'value is sensible'))
UNION ALL
SELECT 'weather', rule, failed_rows, total_rows FROM (
  SELECT count(*) AS total_rows,
         count(*) FILTER (WHERE location_id IS NULL) AS a,
         count(*) FILTER (WHERE datetime IS NULL) AS b,
         count(*) FILTER (WHERE temperature_2m IS NULL) AS c,
         count(*) FILTER (WHERE surface_pressure IS NULL) AS d
  FROM wrows) UNPIVOT (failed_rows FOR rule IN (a AS 'location_id is not null', b AS 'datetime is not null',
      c AS 'temperature_2m is not null', d AS 'surface_pressure is not null'))
""",
    "dim_locations": _with(LOCATIONS) + "SELECT * FROM dim_locations",
    "dim_parameters": _with(RANKED_PARAMETERS) + "SELECT * FROM dim_parameters",
    "dim_sensors": _with(RANKED_PARAMETERS, SENSORS) + "SELECT * FROM dim_sensors",
    "dim_calendar": _with(CALENDAR) + "SELECT * FROM dim_calendar",
    "dim_time": _with(POLLUTION, TIME) + """
SELECT t.time_int, t."time", t."hour", t.time_24, t.hour_24, t.am_pm, coalesce(c.n, 0) AS n_facts
FROM dim_time t LEFT JOIN (SELECT time_int, count(*) AS n FROM fct_pollution GROUP BY time_int) c
  ON t.time_int = c.time_int""",
    "latest_per_key": """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "dim_weather_locations": _with(WEATHER_LOCATIONS) + "SELECT * FROM dim_weather_locations",
    "weather_rows": _with(WEATHER_ROWS) + "SELECT * FROM weather_rows",
    "fct_pollution": _with(FCT_POLLUTION) + "SELECT * FROM fct_pollution",
    "fct_weather": _with(FCT_WEATHER) + "SELECT * FROM fct_weather",
    "hourly_detail": _with(POLLUTION, HOURLY) + "SELECT * FROM hourly",
    "hourly_by_city": _with(POLLUTION, HOURLY, HOURLY_BY_CITY) + """
SELECT date_int, time_int, country, city, parameter, units, round(avg_value, 6) AS avg_value,
       min_value, max_value FROM hourly_by_city""",
    "agg_daily": _with(POLLUTION, CALENDAR, DAILY) + """
SELECT date, date_int, location_id, location_name, country, city, latitude, longitude, parameter, units,
       round(avg_value, 6) AS avg_value, min_value, max_value FROM daily""",
    "agg_monthly": _with(POLLUTION, CALENDAR, DAILY) + """
SELECT CAST(date_trunc('month', c.calendar_date) AS DATE) AS date,
       CAST(floor(d.date_int / 100) * 100 + 1 AS INTEGER) AS date_int,
       d.location_id, d.location_name, d.country, d.city, d.latitude, d.longitude, d.parameter, d.units,
       round(avg(d.avg_value), 6) AS avg_value, min(d.min_value) AS min_value, max(d.max_value) AS max_value
FROM daily d JOIN dim_calendar c ON d.date_int = c.date_int
GROUP BY ALL""",
    "weather_hourly": _with(WEATHER, WEATHER_HOURLY) + "SELECT * FROM weather_hourly",
    "high_water_by_location": _with(WEATHER) + """
SELECT l.city, l.latitude, l.longitude,
       strptime(CAST(max(f.date_int) AS VARCHAR), '%Y%m%d')::DATE AS last_date
FROM fct_weather f JOIN dim_weather_locations l ON f.location_id = l.location_id
GROUP BY l.city, l.latitude, l.longitude""",
    "high_water_worklist": _with(POLLUTION, LOC_SENSORS) + """
SELECT id, name, CAST(floor(sensor_id / 1000) AS BIGINT) AS sensor_block,
       (SELECT strptime(CAST(max(date_int) AS VARCHAR), '%Y%m%d')::DATE FROM fct_pollution) AS last_date,
       array_to_string(list_sort(list(sensor_id)), ',') AS sensor_id_arr
FROM loc_sensors GROUP BY id, name, floor(sensor_id / 1000)""",
    "sensors_by_city": _with(POLLUTION_DIMS, LOC_SENSORS) + """
SELECT id, CAST(floor(sensor_id / 1000) AS BIGINT) AS sensor_block,
       array_to_string(list_sort(list(sensor_id)), ',') AS sensor_id_arr, name
FROM loc_sensors WHERE city = 'EUROPE' GROUP BY id, name, floor(sensor_id / 1000)""",
    "backfill_worklist": _with(POLLUTION, LOC_SENSORS, BACKFILL) + """
SELECT w.* FROM work w
WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE f.location_id = w.location_id
                  AND f.sensor_id = w.sensor_id AND f.period_from = w.period_from)""",
    "key_audit": _with(POLLUTION, CALENDAR) + " UNION ALL ".join([
        _key_audit_part("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
        _key_audit_part("orders", "orders", ["o_orderkey"]),
        _key_audit_part("customer", "customer", ["c_custkey"]),
        _key_audit_part("fct_pollution", "fct_pollution", ["id"]),
        _key_audit_part("dim_pollution_sensors", "dim_sensors", ["sensor_id"]),
        _key_audit_part("dim_calendar", "dim_calendar", ["date_int"]),
    ]),
    "orphan_audit": _with(POLLUTION, CALENDAR, TIME, WEATHER) + " UNION ALL ".join([
        _orphan_part("events.user_id -> customer", "events", "user_id", "customer", "c_custkey"),
        _orphan_part("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphan_part("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"),
        _orphan_part("fct_pollution.sensor_id -> dim_pollution_sensors", "fct_pollution", "sensor_id",
                     "dim_sensors", "sensor_id"),
        _orphan_part("fct_pollution.date_int -> dim_calendar", "fct_pollution", "date_int",
                     "dim_calendar", "date_int"),
        _orphan_part("fct_pollution.time_int -> dim_time", "fct_pollution", "time_int",
                     "dim_time", "time_int"),
        _orphan_part("fct_weather.location_id -> dim_weather_locations", "fct_weather", "location_id",
                     "dim_weather_locations", "location_id"),
    ]),
}

SQL["key_audit_dimensions"] = _with(POLLUTION, TIME, WEATHER) + " UNION ALL ".join([
    _key_audit_part("dim_pollution_locations", "dim_locations", ["location_id"]),
    _key_audit_part("dim_pollution_parameters", "dim_parameters", ["parameter_id"]),
    _key_audit_part("dim_time", "dim_time", ["time_int"]),
    _key_audit_part("dim_weather_locations", "dim_weather_locations", ["location_id"]),
])

SQL["orphan_audit_dimensions"] = _with(POLLUTION, CALENDAR, TIME, WEATHER) + " UNION ALL ".join([
    _orphan_part("dim_pollution_sensors.location_id -> dim_pollution_locations", "dim_sensors",
                 "location_id", "dim_locations", "location_id"),
    _orphan_part("dim_pollution_sensors.parameter_id -> dim_pollution_parameters", "dim_sensors",
                 "parameter_id", "dim_parameters", "parameter_id"),
    _orphan_part("fct_pollution.location_id -> dim_pollution_locations", "fct_pollution",
                 "location_id", "dim_locations", "location_id"),
    _orphan_part("fct_weather.date_int -> dim_calendar", "fct_weather", "date_int",
                 "dim_calendar", "date_int"),
    _orphan_part("fct_weather.time_int -> dim_time", "fct_weather", "time_int",
                 "dim_time", "time_int"),
])

_GOLD_BOTH = _with(POLLUTION, HOURLY, HOURLY_BY_CITY, WEATHER, WEATHER_HOURLY)

SQL["corr_by_parameter"] = _GOLD_BOTH + """,
w AS (SELECT date_int, time_int, city, avg(temperature_2m) AS temperature, avg(wind_speed_10m) AS wind_speed
      FROM weather_hourly GROUP BY date_int, time_int, city)
SELECT h.parameter, count(*) AS n_hours,
       round(corr(h.avg_value, w.temperature), 6) AS corr_temperature,
       round(corr(h.avg_value, w.wind_speed), 6) AS corr_wind_speed
FROM hourly_by_city h JOIN w ON h.date_int = w.date_int AND h.time_int = w.time_int AND h.city = w.city
GROUP BY h.parameter"""

SQL["by_wind_bucket"] = _GOLD_BOTH + """,
wb AS (SELECT date_int, time_int, city, wind_direction_bucket, avg(wind_speed_10m) AS wind_speed
       FROM weather_hourly GROUP BY date_int, time_int, city, wind_direction_bucket)
SELECT wb.wind_direction_bucket, h.parameter, count(*) AS n_hours,
       round(avg(h.avg_value), 6) AS avg_pollution, round(avg(wb.wind_speed), 6) AS avg_wind_speed
FROM hourly_by_city h JOIN wb ON h.date_int = wb.date_int AND h.time_int = wb.time_int AND h.city = wb.city
GROUP BY wb.wind_direction_bucket, h.parameter"""

SQL["best_hour"] = _with(POLLUTION, HOURLY, HOURLY_BY_CITY, CALENDAR) + """
SELECT day_of_week, calendar_day, parameter, time_int, round(avg_pollution, 6) AS avg_pollution, n_hours
FROM (SELECT c.day_of_week, c.calendar_day, h.parameter, h.time_int,
             avg(h.avg_value) AS avg_pollution, count(*) AS n_hours
      FROM hourly_by_city h JOIN dim_calendar c ON h.date_int = c.date_int
      GROUP BY c.day_of_week, c.calendar_day, h.parameter, h.time_int)
QUALIFY row_number() OVER (PARTITION BY day_of_week, parameter ORDER BY avg_pollution, time_int) = 1"""

# --- streaming queries ---------------------------------------------------------------
PAGED = FEED + """,
paged AS (
  SELECT c.*, concat_ws('_', coalesce(CAST(c.location_id AS VARCHAR), ''), coalesce(CAST(c.sensor_id AS VARCHAR), ''),
                        coalesce(replace(n.n_name, ' ', '-'), ''),
                        strftime(date_trunc('month', c.datetime_from), '%Y-%m-%d'),
                        strftime(last_day(c.datetime_from), '%Y-%m-%d'))
              || '_page' || CAST(c.event_id // 100000 + 1 AS VARCHAR) || '.json' AS file_name
  FROM clean c LEFT JOIN nation n ON c.location_id = n.n_nationkey
)"""


SQL["land_json"] = _with(PAGED.replace("FROM clean c", "FROM feed c")) + """
SELECT file_name, count(*) AS n_results, round(sum(value), 3) AS sum_value FROM paged GROUP BY file_name"""
SQL["ingest_measurements"] = _with(FEED) + """
SELECT datetime_from, datetime_to, value, "interval", location_id, CAST(sensor_id AS INTEGER) AS sensor_id
FROM clean"""
# The stream keeps the row that the batch fact keeps: the first event of a key.
SQL["upsert_facts"] = SQL["ingest_rerun"] = _with(FCT_POLLUTION) + """
SELECT id, date_int, time_int, value, location_id, CAST(sensor_id AS INTEGER) AS sensor_id
FROM fct_pollution"""
SQL["ingest_locations"] = SQL["dim_locations"]
SQL["ingest_sensors"] = _with(RANKED_PARAMETERS, SENSORS) + """
SELECT CAST(sensor_id AS INTEGER) AS sensor_id, name, location_id, parameter_id FROM dim_sensors"""
SQL["ingest_parameters"] = SQL["dim_parameters"]
SQL["ingest_weather"] = _with(WEATHER_ROWS) + """
SELECT sha256(concat_ws('|', location_id, strftime(datetime, '%Y-%m-%d %H:%M:%S'))) AS id, location_id,
       CAST(year(datetime) * 10000 + month(datetime) * 100 + day(datetime) AS INTEGER) AS date_int,
       CAST(strftime(datetime, '%H%M') AS INTEGER) AS time_int,
       apparent_temperature, precipitation, relative_humidity_2m, temperature_2m, wind_direction_100m,
       wind_direction_10m, wind_gusts_10m, wind_speed_100m, wind_speed_10m, surface_pressure
FROM weather_rows
WHERE location_id IS NOT NULL AND datetime IS NOT NULL AND temperature_2m IS NOT NULL
  AND surface_pressure IS NOT NULL"""

SQL["sql_sensors_by_city"] = SQL["sensors_by_city"]
SQL["gold_tables"] = SQL["agg_monthly"]

SQL["high_water_per_location"] = _with(POLLUTION, LOC_SENSORS) + """
SELECT l.id, l.name, l.sensor_block, h.last_date, l.sensor_id_arr FROM (
  SELECT id, name, CAST(floor(sensor_id / 1000) AS BIGINT) AS sensor_block, array_to_string(list_sort(list(sensor_id)), ',') AS sensor_id_arr
  FROM loc_sensors GROUP BY id, name, floor(sensor_id / 1000)) l
LEFT JOIN (SELECT location_id, strptime(CAST(max(date_int) AS VARCHAR), '%Y%m%d')::DATE AS last_date
           FROM fct_pollution GROUP BY location_id) h ON l.id = h.location_id"""
SQL["gold_incremental"] = SQL["agg_daily"]

from .oracle_raw import RAW_SQL  # noqa: E402

SQL.update(RAW_SQL)
