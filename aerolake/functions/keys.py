"""Surrogate keys: hashed fact / location keys and integer date/time keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text form of a timestamp inside a key, independent of session zone.
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _text(c: Column) -> Column:
    return c.cast("string")


def key_text(*parts: Column) -> Column:
    """The text a key hashes: the parts joined with '|'; NULL if any part is
    NULL.  Equal texts give equal keys, so rows can be grouped on this short
    form and hashed afterwards."""
    any_null = reduce(lambda a, b: a | b, (p.isNull() for p in parts))
    return F.when(~any_null, F.concat_ws("|", *[_text(p) for p in parts]))


def hash_text(text: Column) -> Column:
    return F.sha2(text, 256)


def hashed_key(*parts: Column) -> Column:
    """sha-256 hex of the parts joined with '|'; NULL if any part is NULL.

    Joining with a separator keeps (1, 23) and (12, 3) apart; returning NULL
    for a missing part lets a "key is not null" rule drop the row instead of
    hashing a partial key.
    """
    return hash_text(key_text(*parts))


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, KEY_TS_FORMAT)


def pollution_key(sensor_id: Column, location_id: Column, datetime_from: Column) -> Column:
    return hashed_key(sensor_id, location_id, ts_text(datetime_from))


def weather_key(location_id: Column, datetime: Column) -> Column:
    return hashed_key(location_id, ts_text(datetime))


def weather_location_key(latitude: Column, longitude: Column) -> Column:
    """Location id of a weather document, hashed from the raw coordinates."""
    return hashed_key(latitude, longitude)


def date_int(ts: Column) -> Column:
    """yyyymmdd as INT."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_int(ts: Column) -> Column:
    """HHmm as INT (09:00 -> 900)."""
    return F.date_format(ts, "HHmm").cast("int")


def month_int(date_int_col: Column) -> Column:
    """yyyymm from a yyyymmdd key: the coarse layout / pruning column."""
    return F.floor(date_int_col / 100).cast("int")


def first_of_month_int(date_int_col: Column) -> Column:
    """yyyymm01 from a yyyymmdd key."""
    return (F.floor(date_int_col / 100) * 100 + 1).cast("int")


def date_from_int(date_int_col: Column) -> Column:
    return F.to_date(date_int_col.cast("string"), "yyyyMMdd")
