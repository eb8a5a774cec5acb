"""Flatten landing documents into clean bronze rows (batch and stream alike)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import weather_location_key
from ..sources.schemas import WEATHER_VARIABLES


def file_part(name_col, sep: str, index: int):
    """Token ``index`` of a file name split on ``sep``; NULL when missing."""
    return F.get(F.split(name_col, sep), index)


def int_part(name_col, sep: str, index: int):
    """Integer token of a file name; NULL (not an error) when not numeric, so
    the "is not null" rules drop the row instead of failing the stream."""
    return file_part(name_col, sep, index).try_cast("int")


# --- pollution locations ------------------------------------------------------
def locations_flat(bronze: DataFrame) -> DataFrame:
    """Location record to columns; city is the file-name prefix before '-'."""
    r = lambda f: F.col(f"results.{f}")
    return bronze.select(
        r("id").cast("int").alias("id"),
        r("name").alias("name"),
        r("locality").alias("locality"),
        r("country.code").alias("country"),
        r("isMobile").alias("is_mobile"),
        r("isMonitor").alias("is_monitor"),
        r("coordinates.latitude").cast("float").alias("latitude"),
        r("coordinates.longitude").cast("float").alias("longitude"),
        r("sensors").alias("sensors"),
        file_part(F.col("source_file_name"), "-", 0).alias("city"),
        F.col("bronze_load_ts"),
    )


def location_rows(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("id").alias("location_id"), "name", "locality", "country", "city",
        "is_mobile", "is_monitor", "latitude", "longitude", "bronze_load_ts")


def sensor_rows(flat: DataFrame) -> DataFrame:
    """One row per (location, sensor); the nested parameter is kept."""
    return (flat.select(F.col("id").alias("location_id"), F.explode("sensors").alias("s"),
                        "bronze_load_ts")
            .select(F.col("s.id").alias("id"), F.col("s.name").alias("name"),
                    F.col("s.parameter").alias("parameter"), "location_id", "bronze_load_ts"))


def parameter_rows(sensors: DataFrame) -> DataFrame:
    return sensors.select(
        F.col("parameter.id").cast("int").alias("parameter_id"),
        F.col("parameter.displayName").alias("display_name"),
        F.col("parameter.name").alias("name"),
        F.col("parameter.units").alias("units"),
        "bronze_load_ts")


def sensor_dim_rows(sensors: DataFrame) -> DataFrame:
    return sensors.select(
        F.col("id").cast("int").alias("sensor_id"), "name", "location_id",
        F.col("parameter.id").cast("int").alias("parameter_id"), "bronze_load_ts")


# --- pollution measurements ---------------------------------------------------
def measurements_clean(bronze: DataFrame) -> DataFrame:
    """Measurement record to columns; location and sensor ids come from the
    file name ``{location}_{sensor}_...``, not from the record."""
    return bronze.select(
        F.col("results.period.datetimeFrom.utc").alias("datetime_from"),
        F.col("results.period.datetimeTo.utc").alias("datetime_to"),
        F.col("results.value").cast("float").alias("value"),
        F.col("results.period.interval").alias("interval"),
        int_part(F.col("source_file_name"), "_", 0).alias("location_id"),
        int_part(F.col("source_file_name"), "_", 1).alias("sensor_id"),
        "source_file_name", "bronze_load_ts",
        *[c for c in ["position"] if c in bronze.columns],
    )


def page_number(name_col):
    """The number n of a file name ``..._page{n}.json``; 0 without one."""
    return F.coalesce(F.regexp_extract(name_col, r"_page(\d+)\.", 1).try_cast("bigint"),
                      F.lit(0).cast("bigint"))


# --- weather -------------------------------------------------------------------
def weather_docs(bronze: DataFrame) -> DataFrame:
    """Document-level columns, city from ``openmeteo_{city}_...`` and the
    location id hashed from the raw (double) coordinates."""
    return bronze.select(
        "elevation", "generationtime_ms", "hourly", "hourly_units", "latitude", "longitude",
        "timezone", "timezone_abbreviation", "utc_offset_seconds", "bronze_load_ts",
        "source_file_name",
        file_part(F.col("source_file_name"), "_", 1).alias("city"),
        weather_location_key(F.col("latitude"), F.col("longitude")).alias("location_id"),
    )


def zip_rows(df: DataFrame, keep: list[str], arrays: dict[str, object], name: str = "m",
             position: str = "position") -> DataFrame:
    """Parallel arrays to rows: element i of every array forms row i.

    Shorter arrays are padded with NULL.  A missing (NULL) array counts as
    empty, so a document lacking one variable keeps its hours with NULL in
    that column (the row rules then decide); a document with no arrays at
    all yields no rows.
    """
    cols = {n: (F.col(c) if isinstance(c, str) else c) for n, c in arrays.items()}
    types = df.select(*[c.alias(n) for n, c in cols.items()]).schema
    zipped = F.arrays_zip(*[F.coalesce(c, F.array().cast(types[n].dataType)).alias(n)
                            for n, c in cols.items()])
    return df.select(*keep, F.posexplode(zipped).alias(position, name))


def weather_rows(docs: DataFrame, position: bool = False) -> DataFrame:
    """One row per hour of a weather document, typed as the clean table; with
    ``position`` also the hour's place in the document's arrays."""
    arrays = {"time": "hourly.time"}
    arrays.update({n: f"hourly.{n}" for n, _, _ in WEATHER_VARIABLES})
    z = zip_rows(docs, ["location_id", "bronze_load_ts", "source_file_name"], arrays)
    return z.select(
        "location_id",
        F.try_to_timestamp(F.col("m.time")).alias("datetime"),
        *[F.col(f"m.{n}").try_cast(cast.simpleString()).alias(n) for n, _, cast in WEATHER_VARIABLES],
        "bronze_load_ts", "source_file_name", *(["position"] if position else []),
    )
