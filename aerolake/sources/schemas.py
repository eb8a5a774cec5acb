"""Fixed schemas of the landing documents and of the silver tables.

Landing files are read with an explicit schema (no inference at run time);
a field present in a file but absent here is ignored.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, F_, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.FloatType(), T.BooleanType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- landing: pollution locations document ---------------------------------
PARAMETER_DOC = T.StructType([_f("id", L), _f("name", S), _f("displayName", S), _f("units", S)])
SENSOR_DOC = T.StructType([_f("id", L), _f("name", S), _f("parameter", PARAMETER_DOC)])
LOCATION_DOC = T.StructType([
    _f("id", I), _f("name", S), _f("locality", S),
    _f("country", T.StructType([_f("code", S)])),
    _f("isMobile", B), _f("isMonitor", B),
    _f("coordinates", T.StructType([_f("latitude", F_), _f("longitude", F_)])),
    _f("sensors", T.ArrayType(SENSOR_DOC)),
])
LOCATIONS_FILE = T.StructType([_f("results", T.ArrayType(LOCATION_DOC))])

# --- landing: pollution measurements document ------------------------------
_DT = T.StructType([_f("local", S), _f("utc", T.TimestampType())])
MEASUREMENT_DOC = T.StructType([
    _f("value", F_),
    _f("parameter", T.StructType([_f("id", I)])),
    _f("period", T.StructType([_f("interval", S), _f("datetimeFrom", _DT), _f("datetimeTo", _DT)])),
])
MEASUREMENTS_FILE = T.StructType([_f("results", T.ArrayType(MEASUREMENT_DOC))])

# --- landing: weather document (parallel hourly arrays) --------------------
# The hourly weather variables, in the order they are zipped.
WEATHER_VARIABLES = [
    ("apparent_temperature", D, F_),
    ("precipitation", D, F_),
    ("relative_humidity_2m", L, I),
    ("temperature_2m", D, F_),
    ("wind_direction_100m", L, I),
    ("wind_direction_10m", L, I),
    ("wind_gusts_10m", D, F_),
    ("wind_speed_100m", D, F_),
    ("wind_speed_10m", D, F_),
    ("surface_pressure", D, F_),
]
HOURLY = T.StructType([_f("time", T.ArrayType(S))]
                      + [_f(n, T.ArrayType(raw)) for n, raw, _ in WEATHER_VARIABLES])
WEATHER_FILE = T.StructType([
    _f("latitude", D), _f("longitude", D), _f("elevation", D), _f("generationtime_ms", D),
    _f("utc_offset_seconds", L), _f("timezone", S), _f("timezone_abbreviation", S),
    _f("hourly_units", T.StructType([_f("time", S)] + [_f(n, S) for n, _, _ in WEATHER_VARIABLES])),
    _f("hourly", HOURLY),
])

# --- silver tables -----------------------------------------------------------
DIM_LOCATIONS = T.StructType([
    _f("location_id", I, False), _f("name", S, False), _f("locality", S), _f("country", S),
    _f("city", S, False), _f("is_mobile", B), _f("is_monitor", B),
    _f("latitude", F_), _f("longitude", F_),
])
DIM_PARAMETERS = T.StructType([_f("parameter_id", I, False), _f("display_name", S),
                               _f("name", S, False), _f("units", S)])
DIM_SENSORS = T.StructType([_f("sensor_id", I, False), _f("name", S, False),
                            _f("location_id", I, False), _f("parameter_id", I, False)])
DIM_WEATHER_LOCATIONS = T.StructType([_f("location_id", S), _f("latitude", F_), _f("longitude", F_),
                                      _f("city", S), _f("timezone", S), _f("elevation", F_)])
FCT_POLLUTION = T.StructType([_f("id", S), _f("date_int", I), _f("time_int", I), _f("value", F_),
                              _f("location_id", I), _f("sensor_id", I)])
# Declared tables: NOT NULL columns and the layout column.
FCT_POLLUTION_TABLE = T.StructType([_f(f.name, f.dataType, False) for f in FCT_POLLUTION]
                                   + [_f("date_month", I, False)])
FCT_WEATHER = T.StructType([_f("id", S), _f("location_id", S), _f("date_int", I), _f("time_int", I)]
                           + [_f(n, cast) for n, _, cast in WEATHER_VARIABLES])
FCT_WEATHER_TABLE = T.StructType(
    [_f(f.name, f.dataType, f.name not in ("id", "location_id", "date_int", "time_int"))
     for f in FCT_WEATHER] + [_f("date_month", I, False)])
DIM_WEATHER_LOCATIONS_TABLE = T.StructType(
    [_f(f.name, f.dataType, f.name not in ("location_id", "latitude", "longitude", "city"))
     for f in DIM_WEATHER_LOCATIONS])
