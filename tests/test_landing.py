"""Nested landing fixtures in the downloader's shape: one multi-line gzip
JSON document per file, ids and city in the file name."""

import gzip
import json
import os

from pyspark.sql import functions as F

from aerolake.functions.rules import MEASUREMENT_RULES, drop_failing
from aerolake.operators import dims, shape
from aerolake.sources.landing import LOCATIONS_GLOB, MEASUREMENTS_GLOB, WEATHER_GLOB
from aerolake.streaming import ingest


def put(folder, name, doc):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as fh:
        fh.write(json.dumps(doc, indent=4))


def meas(value, interval="01:00:00", utc="2024-01-01T05:00:00Z"):
    return {"value": value, "parameter": {"id": 2},
            "period": {"interval": interval,
                       "datetimeFrom": {"utc": utc, "local": "2024-01-01T06:00:00+01:00"},
                       "datetimeTo": {"utc": "2024-01-01T06:00:00Z", "local": "x"}}}


def run_stream(df, root, name):
    out = f"{root}/{name}"
    ingest.run_available(df, f"{root}/_ck/{name}", out)
    return out


def test_measurement_files_rules_and_rerun(spark, tmpdir_path):
    land = tmpdir_path + "/m"
    put(land, "123_456_Novi-Beograd_2024-01-01_2024-03-31_page1.json.gz",
        {"results": [meas(0), meas(800), meas(-1), meas(0.5), meas(799.5), meas(None),
                     meas(5, "00:30:00"), meas(5, None), meas(5, utc=None)], "meta": {"found": 9}})
    put(land, "9a_456_X_2024-01-01_2024-03-31_page1.json.gz", {"results": [meas(5)]})  # id not numeric
    put(land, "abc_456_X_2024-01-01_2024-03-31_page1.json.gz", {"results": [meas(5)]})  # glob skips it
    put(land, "77_page1.json.gz", {"results": [meas(5)]})
    put(land, "88_99_Empty_2024-01-01_2024-03-31_page1.json.gz", {"results": []})
    put(land, "Belgrade-locations.json.gz", {"results": []})   # not a measurement file
    bronze = ingest.bronze_measurements(spark, land, MEASUREMENTS_GLOB, max_files=1, multiline=True)
    raw = run_stream(bronze, tmpdir_path, "raw")
    assert spark.read.parquet(raw).count() == 11
    clean = drop_failing(shape.measurements_clean(spark.read.parquet(raw)), MEASUREMENT_RULES)
    got = sorted((r.location_id, r.sensor_id, r.value) for r in clean.collect())
    assert got == [(123, 456, 0.5), (123, 456, 799.5)]
    # a rerun with nothing new reads no file again
    run_stream(ingest.bronze_measurements(spark, land, MEASUREMENTS_GLOB, multiline=True), tmpdir_path, "raw")
    assert spark.read.parquet(raw).count() == 11


def test_location_files_to_dimensions(spark, tmpdir_path):
    land = tmpdir_path + "/l"
    sensor = lambda i, p, n: {"id": i, "name": f"s{i}", "parameter": {"id": p, "name": n, "displayName": n.upper(), "units": "ug"}}
    loc = lambda i, name, sensors: {"id": i, "name": name, "locality": "L", "country": {"code": "RS"},
                                    "isMobile": False, "isMonitor": True,
                                    "coordinates": {"latitude": 44.8, "longitude": 20.4}, "sensors": sensors}
    put(land, "Belgrade-locations.json.gz",
        {"results": [loc(1, "A", [sensor(10, 2, "pm10"), sensor(11, 3, "pm25")]), loc(2, "B", []),
                     loc(3, None, [sensor(12, 2, "pm10")])]})
    put(land, "Nis-locations_2.json.gz", {"results": [loc(1, "A2", [sensor(10, 2, "pm10")])]})
    bronze = ingest.bronze_locations(spark, land, LOCATIONS_GLOB, multiline=True)
    raw = spark.read.parquet(run_stream(bronze, tmpdir_path, "l_raw"))
    flat = shape.locations_flat(raw)
    locs = {r.location_id: (r.name, r.city) for r in dims.locations_dim(shape.location_rows(flat)).collect()}
    assert set(locs) == {1, 2} and locs[2] == ("B", "Belgrade")     # null name dropped
    sens = sorted((r.sensor_id, r.location_id, r.parameter_id)
                  for r in dims.sensors_dim(shape.sensor_dim_rows(shape.sensor_rows(flat))).collect())
    assert sens == [(10, 1, 2), (11, 1, 3), (12, 3, 2)]
    pars = sorted((r.parameter_id, r.name) for r in
                  dims.parameters_dim(shape.parameter_rows(shape.sensor_rows(flat))).collect())
    assert pars == [(2, "pm10"), (3, "pm25")]


def test_weather_files_zip_and_failed_download(spark, tmpdir_path):
    land = tmpdir_path + "/w"
    hourly = {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "not a time"],
              "temperature_2m": [1.5, 2.5, 3.5], "surface_pressure": [1000.0, 1001.0, 1002.0],
              "relative_humidity_2m": [50], "wind_direction_10m": [10, 350, 90]}
    put(land, "openmeteo_Belgrade_2024-01-01_2024-01-02.json.gz",
        {"latitude": 44.8, "longitude": 20.46, "elevation": 117.0, "timezone": "GMT", "hourly": hourly})
    put(land, "openmeteo_Belgrade_2024-01-03_2024-01-04.json.gz", {})
    bronze = ingest.bronze_weather(spark, land, WEATHER_GLOB, multiline=True)
    raw = spark.read.parquet(run_stream(bronze, tmpdir_path, "w_raw"))
    assert raw.count() == 2
    rows = shape.weather_rows(shape.weather_docs(raw)).orderBy("temperature_2m").collect()
    assert len(rows) == 3
    assert [r.relative_humidity_2m for r in rows] == [50, None, None]       # padded
    assert rows[2].datetime is None                                          # bad time text
    import hashlib

    assert rows[0].location_id == hashlib.sha256(b"44.8|20.46").hexdigest()
    wl = dims.weather_locations_dim(shape.weather_docs(raw)).collect()
    assert [(r.city, round(r.latitude, 2)) for r in wl] == [("Belgrade", 44.8)]


def test_clean_stream_reports_rule_counts(spark, tmpdir_path):
    land = tmpdir_path + "/m2"
    put(land, "5_6_A_2024-01-01_2024-03-31_page1.json.gz",
        {"results": [meas(1.0), meas(900.0), meas(None), meas(2.0, "00:15:00")]})
    bronze = ingest.bronze_measurements(spark, land, MEASUREMENTS_GLOB, multiline=True)
    raw = run_stream(bronze, tmpdir_path, "m2_raw")
    clean = ingest.clean_measurements_stream(ingest.read_bronze_stream(spark, raw, bronze))
    progress = ingest.run_available(clean.drop("source_file_name", "bronze_load_ts"),
                                    f"{tmpdir_path}/_ck/m2_clean", f"{tmpdir_path}/m2_clean")
    metrics = [p["observedMetrics"]["measurements_rules"] for p in progress
               if p.get("observedMetrics", {}).get("measurements_rules")]
    assert metrics, progress
    m = metrics[0]
    assert (m["total_rows"], m["value is sensible"], m["value is not null"],
            m["period interval is 1 hour"]) == (4, 2, 1, 1)
    assert spark.read.parquet(f"{tmpdir_path}/m2_clean").count() == 1


def test_sample_schema(spark, tmpdir_path):
    from aerolake.sources.landing import sample_schema

    land = tmpdir_path + "/m3"
    put(land, "5_6_A_2024-01-01_2024-03-31_page1.json.gz", {"results": [meas(1.0)]})
    s = sample_schema(spark, land, MEASUREMENTS_GLOB)
    assert "results" in s.fieldNames()


def test_byte_bound_splits_a_backlog_into_batches(spark, tmpdir_path):
    land = tmpdir_path + "/mb"
    for i in range(6):
        put(land, f"{i + 1}_7_X_2024-01-01_2024-03-31_page1.json.gz",
            {"results": [meas(float(i + 1))] * 50})
    size = max(os.path.getsize(os.path.join(land, f)) for f in os.listdir(land))
    bronze = ingest.bronze_measurements(spark, land, MEASUREMENTS_GLOB, multiline=True,
                                        max_bytes=2 * size)
    out = f"{tmpdir_path}/raw_b"
    progress = ingest.run_available(bronze, f"{tmpdir_path}/_ck/raw_b", out)
    batches = [p["numInputRows"] for p in progress if p["numInputRows"]]
    # input rows are documents (one per file): several bounded batches, no file lost
    assert len(batches) >= 3 and sum(batches) == 6
    assert spark.read.parquet(out).count() == 300
