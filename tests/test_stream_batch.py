"""Each streaming path gives the same rows as its batch form."""

from pyspark.sql import functions as F

from aerolake.plans import streams
from aerolake.plans.model import Lake
from aerolake.plans.streams import q_ingest_measurements, q_upsert_facts
from aerolake.streaming import ingest, upsert

from .conftest import SF_SMALL


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_clean_stream_equals_batch(spark):
    stream = q_ingest_measurements(spark, SF_SMALL)
    batch = Lake(spark, SF_SMALL).clean_measurements().withColumn(
        "sensor_id", F.col("sensor_id").cast("int"))
    cols = ["datetime_from", "value", "interval", "location_id", "sensor_id"]
    s = stream.withColumn("datetime_from", F.col("datetime_from").cast("timestamp_ntz"))
    assert rows(s, cols) == rows(batch, cols)


def test_upsert_stream_keeps_the_row_the_batch_keeps(spark):
    stream = q_upsert_facts(spark, SF_SMALL)
    batch = Lake(spark, SF_SMALL).fct_pollution
    cols = ["id", "date_int", "time_int", "value", "location_id", "sensor_id"]
    assert rows(stream, cols) == rows(batch, cols)


def test_several_pages_arrive_by_number(spark, monkeypatch):
    """With small pages a chunk has more than nine, so page 10 must not come
    before page 2; the kept values stay those of the batch fact."""
    monkeypatch.setattr(streams, "PAGE_SPAN", 7)
    stream = q_upsert_facts(spark, SF_SMALL)
    batch = Lake(spark, SF_SMALL).fct_pollution
    assert rows(stream, ["id", "value"]) == rows(batch, ["id", "value"])


def test_first_arrival_by_page_and_position(spark):
    ts = "timestamp'2024-01-01 05:00:00'"
    batch = spark.sql(f"""
        SELECT {ts} datetime_from, 1 sensor_id, 2 location_id, timestamp'2024-02-01' bronze_load_ts,
               concat('2_1_X_page', page, '.json') source_file_name, position, value
        FROM VALUES (10, 0, 1f), (2, 3, 9f), (2, 1, 7f) AS t(page, position, value)""")
    assert [r.value for r in upsert.first_pollution_rows(batch).collect()] == [7.0]


def test_progress_of_every_batch_is_kept(spark, tmpdir_path):
    """More batches than a query remembers: each is reported once."""
    spark.range(0, 120, 1, 120).write.parquet(f"{tmpdir_path}/many")
    stream = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1)
              .parquet(f"{tmpdir_path}/many"))
    seen = ingest.run_available(stream, f"{tmpdir_path}/ck",
                                foreach_batch=lambda df, i: df.count())
    assert sorted(p["batchId"] for p in seen if p["numInputRows"]) == list(range(120))
