import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake.functions import rules as R
from aerolake.functions.calendar import calendar_columns
from aerolake.functions.keys import date_int, hashed_key, time_int
from aerolake.functions.periods import chunk_name, quarter_periods
from aerolake.functions.wind import wind_bucket


def test_measurement_rules_edges(spark):
    rows = [
        ("01:00:00", 1, 0.0), ("01:00:00", 1, 800.0), ("01:00:00", 1, -3.0),
        ("01:00:00", 1, 0.001), ("01:00:00", 1, 799.99), ("01:00:00", 1, None),
        ("00:30:00", 1, 5.0), (None, 1, 5.0), ("01:00:00", None, 5.0),
    ]
    df = spark.createDataFrame(rows, "interval string, sensor_id int, value float").select(
        F.lit(dt.datetime(2024, 1, 1)).alias("datetime_from"), F.lit(7).alias("location_id"), "*")
    kept = sorted(r.value for r in R.drop_failing(df, R.MEASUREMENT_RULES).collect())
    assert kept == [pytest_approx(0.001), pytest_approx(799.99)]
    counts = {r.rule: r.failed_rows for r in R.count_failing(df, R.MEASUREMENT_RULES, "m").collect()}
    assert counts["value is sensible"] == 4          # 0, 800, -3 and NULL
    assert counts["period interval is 1 hour"] == 2  # other interval and NULL
    assert counts["sensor_id is not null"] == 1
    assert counts["value is not null"] == 1


def pytest_approx(x):
    import pytest

    return pytest.approx(x, rel=1e-6)


def test_wind_bucket_edges(spark):
    cases = {None: "N", 0: "N", 22: "N", 22.5: "NE", 23: "NE", 67: "NE", 67.5: "E", 68: "E",
             112.5: "SE", 157.5: "S", 202.5: "SW", 247.5: "W", 292.5: "NW", 337: "NW",
             337.5: "N", 338: "N", 360: "N", -10: "N", 500: "N"}
    df = spark.createDataFrame([(None if k is None else float(k),) for k in cases], "d double")
    got = {r.d: r.b for r in df.select("d", wind_bucket(F.col("d")).alias("b")).collect()}
    assert got == {(None if k is None else float(k)): v for k, v in cases.items()}
    ints = spark.createDataFrame([(22,), (23,), (337,), (338,)], "d int")
    assert [r.b for r in ints.select(wind_bucket(F.col("d")).alias("b")).collect()] == ["N", "NE", "NW", "N"]


def test_hashed_key(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (None, 3)], "a int, b int")
    ks = [r.k for r in df.select(hashed_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert ks[0] != ks[1] and ks[2] is None
    import hashlib

    assert ks[0] == hashlib.sha256(b"1|23").hexdigest()


def test_date_and_time_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 9, 5),), (dt.datetime(2023, 12, 31, 0, 0),)],
                               "ts timestamp_ntz")
    got = [(r.d, r.t) for r in df.select(date_int(F.col("ts")).alias("d"), time_int(F.col("ts")).alias("t")).collect()]
    assert got == [(20240229, 905), (20231231, 0)]


def brute_periods(f: dt.date, t: dt.date):
    """Cut [f, t] after every quarter end q with f < q <= t."""
    out, start, d = [], f, f
    while d <= t:
        nxt = d + dt.timedelta(days=1)
        if d > f and nxt.day == 1 and nxt.month in (1, 4, 7, 10):
            out.append((start, d))
            start = nxt
        d = nxt
    if start <= t:
        out.append((start, t))
    return out


def test_periods_examples(spark):
    cases = [("2024-03-31", "2024-04-10"), ("2024-01-15", "2024-03-31"), ("2024-01-15", "2024-07-01"),
             ("2024-05-05", "2024-05-05"), ("2024-05-05", "2024-05-04"), ("2019-02-01", "2024-02-29"),
             ("2024-04-01", "2024-06-30")]
    df = spark.createDataFrame(cases, "f string, t string")
    got = df.select("f", "t", quarter_periods(F.col("f"), F.col("t")).alias("p")).collect()
    for r in got:
        f, t = dt.date.fromisoformat(r.f), dt.date.fromisoformat(r.t)
        assert [(p.period_from, p.period_to) for p in r.p] == brute_periods(f, t), (r.f, r.t)


@settings(max_examples=25, deadline=None)
@given(st.dates(min_value=dt.date(2018, 1, 1), max_value=dt.date(2026, 12, 31)),
       st.integers(min_value=-3, max_value=900))
def test_periods_property(spark, f, n):
    t = f + dt.timedelta(days=n)
    df = spark.createDataFrame([(f, t)], "f date, t date")
    p = df.select(quarter_periods(F.col("f"), F.col("t")).alias("p")).first().p
    assert [(x.period_from, x.period_to) for x in p] == brute_periods(f, t)


def test_chunk_name(spark):
    df = spark.createDataFrame([(12, 345, "Novi Beograd", dt.date(2024, 1, 1), dt.date(2024, 3, 31))],
                               "l int, s int, n string, f date, t date")
    r = df.select(chunk_name(*[F.col(c) for c in "lsnft"]).alias("c")).first()
    assert r.c == "12_345_Novi-Beograd_2024-01-01_2024-03-31"


def test_calendar_columns_edges(spark):
    days = [dt.date(2024, 2, 29), dt.date(2020, 12, 31), dt.date(2021, 1, 3), dt.date(2021, 1, 4),
            dt.date(2024, 6, 30), dt.date(2024, 7, 1), dt.date(2024, 9, 30), dt.date(2024, 10, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = {r.calendar_date: r for r in df.select(*calendar_columns(F.col("d"))).collect()}
    leap = rows[dt.date(2024, 2, 29)]
    assert (leap.date_int, leap.is_last_day_of_month, leap.calendar_day, leap.day_of_week,
            leap.day_of_week_start_monday, leap.is_week_day) == (20240229, "Y", "Thursday", 5, 4, "Y")
    assert rows[dt.date(2020, 12, 31)].week_of_year_iso == 53
    assert rows[dt.date(2021, 1, 3)].week_of_year_iso == 53 and rows[dt.date(2021, 1, 3)].is_week_day == "N"
    assert rows[dt.date(2021, 1, 4)].week_of_year_iso == 1
    j30, j1 = rows[dt.date(2024, 6, 30)], rows[dt.date(2024, 7, 1)]
    assert (j30.fiscal_year_jul_to_jun, j30.fiscal_month_jul_to_jun) == (2024, 12)
    assert (j1.fiscal_year_jul_to_jun, j1.fiscal_month_jul_to_jun) == (2025, 1)
    s30, o1 = rows[dt.date(2024, 9, 30)], rows[dt.date(2024, 10, 1)]
    assert (s30.fiscal_year_oct_to_sep, s30.fiscal_month_oct_to_sep) == (2024, 12)
    assert (o1.fiscal_year_oct_to_sep, o1.fiscal_month_oct_to_sep, o1.quarter_of_year) == (2025, 1, 4)


def test_rule_sets_counted_together_equal_separate_counts(spark):
    # both sets test a column named "x", meaning different things in each
    df = spark.createDataFrame([(1, None, 5), (None, "a", 5), (None, None, 900), (2, "b", None)],
                               "x int, wx string, v int").select(
        "x", "v", F.struct(F.col("wx").alias("x"), F.col("v").alias("y")).alias("w"))
    top = {"x is not null": "x IS NOT NULL", "v in range": "v > 0 AND v < 800"}
    nested = {"x is not null": "x IS NOT NULL", "y present": "y IS NOT NULL"}
    together = R.count_failing_sets(df, [("w", nested, "w"), ("top", top, None)])
    separate = R.count_failing(df.select("x", "v"), top, "top").unionByName(
        R.count_failing(df.select("w.*"), nested, "w"))
    assert sorted(tuple(r) for r in together.collect()) == sorted(tuple(r) for r in separate.collect())
    got = {(r.rule_set, r.rule): r.failed_rows for r in together.collect()}
    assert got[("top", "x is not null")] == 2 and got[("w", "x is not null")] == 2
    assert got[("top", "v in range")] == 2 and got[("w", "y present")] == 1
