import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from aerolake.operators import dims, facts
from aerolake.operators.dedup import first_per_key, latest_per_key
from aerolake.sources.schemas import FCT_POLLUTION


def test_time_of_day(spark):
    rows = {r.time_int: r for r in dims.time_of_day(spark).collect()}
    assert len(rows) == 24
    assert tuple(rows[0])[1:] == ("12:00 AM", "12", "00:00", "24", "AM")
    assert tuple(rows[1300])[1:] == ("01:00 PM", "01", "13:00", "13", "PM")
    assert rows[900].time_int == 900


def test_calendar_range(spark):
    cal = dims.calendar(spark, "2024-02-27", "2024-03-02").collect()
    assert [r.date_int for r in cal] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert dims.rolling_calendar(spark, 5, "2024-02-29").count() == 1828


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("b", 5, 4.0)],
                               "id string, ord int, v double")
    got = sorted((r.id, r.ord, r.v) for r in first_per_key(df, ["id"], ["ord"]).collect())
    assert got == [("a", 1, 2.0), ("b", 5, 4.0)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 10, "x"), (1, 12, "y"), (2, 5, "z")], "k int, ts int, v string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], [F.col("ts").desc()]).collect())
    assert got == [(1, 12, "y"), (2, 5, "z")]


def _fact_batch(spark, rows):
    df = spark.createDataFrame(rows, "sensor_id int, location_id int, datetime_from timestamp_ntz, "
                                     "value float, bronze_load_ts int, source_file_name string")
    return facts.pollution_fact_rows(df, extra=["bronze_load_ts", "source_file_name"])


def test_insert_new_first_write_wins_and_idempotent(spark, tmpdir_path):
    target = tmpdir_path + "/fct"
    h = dt.datetime(2024, 1, 1, 5)
    cols = FCT_POLLUTION.fieldNames()
    order = ["bronze_load_ts", "source_file_name", "value"]
    b1 = _fact_batch(spark, [(1, 7, h, 10.0, 1, "f1"), (1, 7, h, 11.0, 1, "f2"), (2, 7, h, 5.0, 1, "f1")])
    assert facts.insert_new(spark, b1, target, cols, order) == 2
    assert facts.insert_new(spark, b1, target, cols, order) == 0          # replayed batch
    b2 = _fact_batch(spark, [(1, 7, h, 99.0, 2, "f3"), (3, 7, h + dt.timedelta(days=40), 1.0, 2, "f3")])
    assert facts.insert_new(spark, b2, target, cols, order) == 1          # only the new key
    got = {(r.sensor_id, r.value) for r in spark.read.parquet(target).collect()}
    assert got == {(1, 10.0), (2, 5.0), (3, 1.0)}


def test_new_rows_anti_join(spark):
    src = spark.createDataFrame([("a", 1), ("b", 2)], "location_id string, v int")
    tgt = spark.createDataFrame([("a", 9)], "location_id string, v int")
    assert [r.location_id for r in dims.new_rows(src, tgt, ["location_id"]).collect()] == ["b"]


def test_locations_dim_dedups_keys(spark):
    rows = spark.createDataFrame(
        [(1, "old", None, "RS", "Belgrade", True, False, 1.0, 2.0, dt.datetime(2024, 1, 1)),
         (1, "new", None, "RS", "Belgrade", True, False, 1.0, 2.0, dt.datetime(2024, 1, 2)),
         (2, None, None, "RS", "Belgrade", True, False, 1.0, 2.0, dt.datetime(2024, 1, 2)),
         (3, "x", None, "RS", None, True, False, 1.0, 2.0, dt.datetime(2024, 1, 2))],
        "location_id int, name string, locality string, country string, city string, is_mobile boolean, "
        "is_monitor boolean, latitude float, longitude float, bronze_load_ts timestamp")
    got = [(r.location_id, r.name) for r in dims.locations_dim(rows).collect()]
    assert got == [(1, "new")]


def test_merge_insert_only(spark, tmpdir_path):
    path = tmpdir_path + "/dim"
    src = spark.createDataFrame([("a", 1), ("b", 2)], "location_id string, v int")
    assert dims.merge_insert_only(spark, src, path, ["location_id"]) == 2
    again = spark.createDataFrame([("a", 9), ("c", 3)], "location_id string, v int")
    assert dims.merge_insert_only(spark, again, path, ["location_id"]) == 1
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 2), ("c", 3)]


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 50), st.integers(1, 99)),
                min_size=1, max_size=30),
       st.integers(1, 3))
def test_upsert_batches_keep_first_arrival(spark, rows, n_batches):
    """Against brute force: whatever the split into batches, each key keeps
    the value of its first arrival, and replaying every batch adds nothing."""
    import tempfile

    target = tempfile.mkdtemp(prefix="aerolake-prop-", dir="/tmp") + "/fct"
    base = dt.datetime(2024, 1, 31, 20)          # hours span a month boundary
    cols = FCT_POLLUTION.fieldNames()
    order = ["bronze_load_ts", "source_file_name", "value"]
    batches = [[] for _ in range(n_batches)]
    for i, (sensor, hour, value) in enumerate(rows):
        b = i * n_batches // len(rows)
        batches[b].append((sensor, 7, base + dt.timedelta(hours=hour), float(value), b, f"f{i:03d}"))
    for _ in range(2):                           # second pass replays every batch
        for b in batches:
            if b:
                facts.insert_new(spark, _fact_batch(spark, b), target, cols, order)
    expected = {}
    for sensor, hour, value in rows:
        expected.setdefault((sensor, hour), float(value))
    got = {}
    for r in spark.read.parquet(target).collect():
        hour = (dt.datetime.strptime(f"{r.date_int}{r.time_int:04d}", "%Y%m%d%H%M") - base)
        key = (r.sensor_id, int(hour.total_seconds() // 3600))
        assert key not in got
        got[key] = r.value
    assert got == expected


def test_parameters_are_numbered_in_order(spark, tmpdir_path):
    from aerolake.plans.model import Lake

    segments = ["MACHINERY", None, "ab", "abc", "BUILDING", "abca", "abcb", "a", "é", "BUILDING", ""]
    spark.createDataFrame([(100 - i, f"c{i}", i % 3, s) for i, s in enumerate(segments)],
                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"
                          ).write.parquet(f"{tmpdir_path}/customer.parquet")
    want = {s: i for i, s in enumerate(sorted({s for s in segments if s is not None}), 1)}
    lake = Lake(spark, tmpdir_path)
    assert {r.display_name: r.parameter_id for r in lake.dim_parameters.collect()} == want
    got = {r.sensor_id: r.parameter_id for r in lake.sensor_rows().collect()}
    assert got == {100 - i: want.get(s) for i, s in enumerate(segments)}
    assert [f.dataType.simpleString() for f in lake.dim_sensors.schema] == [
        "bigint", "string", "int", "int"]
