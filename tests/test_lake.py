"""Tables made once, keyed rows of a stream, rule counts as a table, undeclared
fields, and files that broke off."""

import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.operators import audit
from aerolake.operators.facts import POLLUTION_KEY, insert_unseen
from aerolake.operators.planning import yesterday
from aerolake.sources import evolving as E
from aerolake.sources import schemas
from aerolake.sources.landing import land_files
from aerolake.sources.warehouse import Warehouse
from aerolake.streaming import ingest, metrics
from aerolake.streaming.keyed import keyed_stream, merge_batch, read_keyed
from aerolake.streaming.lake import LastingLake

from .test_landing import meas, put

NAMED = T.StructType([T.StructField("id", T.IntegerType(), False),
                      T.StructField("name", T.StringType()),
                      T.StructField("month", T.IntegerType(), False)])


def test_table_is_made_once(spark, tmpdir_path):
    for call, made in enumerate((True, False, False)):
        house = Warehouse(spark, f"{tmpdir_path}/w")
        assert house.create_if_absent("s", "t", NAMED, ["month"], ["id"], buckets=3) is made
        assert house.append("t", spark.createDataFrame([(call, None, 5)], NAMED)) == 1
    assert sorted(r.id for r in house.table("t").collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="declared otherwise"):
        house.create_if_absent("s", "t", T.StructType(NAMED.fields[:2]))


def test_empty_table_is_read_before_its_first_row(spark, tmpdir_path):
    house = Warehouse(spark, f"{tmpdir_path}/w")
    house.create_if_absent("s", "t", NAMED)
    assert house.table("t").count() == 0
    house.append("t", spark.createDataFrame([(1, "a", 1)], NAMED))
    assert house.table("t").count() == 1


def test_null_in_a_required_column_fails(spark, tmpdir_path):
    house = Warehouse(spark, f"{tmpdir_path}/w")
    house.create_if_absent("s", "t", NAMED)
    loose = "id int, name string, month int"
    with pytest.raises(PySparkException, match="NOT NULL column id"):
        house.append("t", spark.createDataFrame([(None, "a", 1)], loose))
    assert house.append("t", spark.createDataFrame([(1, None, 1)], loose)) == 1


def test_table_is_found_by_a_new_session_catalog(spark, tmpdir_path):
    house = Warehouse(spark, f"{tmpdir_path}/w")
    house.create_if_absent("s", "t", NAMED, ["month"], ["id"], buckets=2)
    house.append("t", spark.createDataFrame([(1, "a", 7), (2, "b", 8)], NAMED))
    spark.sql(f"DROP TABLE {house.name('t')}")      # the files stay
    again = Warehouse(spark, f"{tmpdir_path}/w")
    assert again.create_if_absent("s", "t", NAMED, ["month"], ["id"], buckets=9) is False
    assert sorted(r.month for r in again.table("t").collect()) == [7, 8]


def test_replay_of_a_batch_adds_nothing(spark, tmpdir_path):
    house = Warehouse(spark, f"{tmpdir_path}/w")
    house.create_if_absent("s", "fct", schemas.FCT_POLLUTION_TABLE, ["date_month"], POLLUTION_KEY)
    rows = spark.range(40).selectExpr("int(id) sensor_id", "int(1) location_id",
                                      "int(20240131 + 70 * (id % 2)) date_int", "int(100) time_int",
                                      "float(id) value")
    late = {"id": F.concat_ws("|", *POLLUTION_KEY)}
    assert insert_unseen(house, "fct", rows, POLLUTION_KEY, late) == 40
    assert insert_unseen(house, "fct", rows, POLLUTION_KEY, late) == 0
    assert house.table("fct").select("date_month").distinct().count() == 2


SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("at", T.IntegerType()),
                       T.StructField("v", T.StringType())])


@pytest.mark.parametrize("stateful", [True, False])
@pytest.mark.parametrize("latest", [False, True])
def test_row_per_key_does_not_depend_on_arrival(spark, tmpdir_path, stateful, latest):
    files = [[(1, 5, "a"), (2, 1, "x"), (3, 1, None)], [(1, 3, "b"), (2, 1, "w"), (4, 9, "z")],
             [(1, 3, "b"), (1, 7, "c"), (None, 1, "n")]]
    found = []
    for turn, order in enumerate(([0, 1, 2], [2, 1, 0])):
        root = f"{tmpdir_path}/{turn}"
        for i in order:      # one file, one call each
            spark.createDataFrame(files[i], SCHEMA).coalesce(1).write.mode("append").parquet(
                f"{root}/in")
            rows = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
            if stateful:
                keyed_stream(rows, ["k"], ["at"], f"{root}/ck", f"{root}/out", latest)
            else:
                ingest.run_available(rows, f"{root}/ck", foreach_batch=lambda b, n: [
                    merge_batch(b, ["k"], ["at"], f"{root}/out", n, latest) for _ in (1, 2)])
        found.append(sorted(map(str, read_keyed(spark, f"{root}/out", SCHEMA, ["k"], ["at"],
                                                latest).collect())))
    assert found[0] == found[1] and len(found[0]) == 5
    assert ("v='c'" if latest else "v='b'") in found[0][0]


def test_rule_counts_of_a_repeated_batch_count_once(spark, tmpdir_path):
    def report(batch, run, at, failed):
        return {"observedMetrics": {"x_rules": {"total_rows": 10, "r": failed}}, "runId": run,
                "batchId": batch, "timestamp": at, "numInputRows": 10}

    path = f"{tmpdir_path}/m"
    assert metrics.totals(metrics.read_reports(spark, path)).count() == 0
    metrics.append_reports(spark, path, "s", [report(0, "a", "1", 4), report(1, "a", "2", 1)])
    metrics.append_reports(spark, path, "s", [report(1, "b", "3", 2), report(2, "b", "4", 0)])
    idle = dict(report(3, "b", "5", 9), numInputRows=0)
    metrics.append_reports(spark, path, "s", [idle])
    assert [tuple(r) for r in metrics.totals(metrics.read_reports(spark, path)).collect()] == [
        ("x", "r", 6, 30)]


def test_cut_off_files_are_counted(spark, tmpdir_path):
    lake = LastingLake(spark, f"{tmpdir_path}/lake")
    land = lake.landing("measurements")
    put(land, "1_2_A_2024-01-01_2024-03-31_page1.json.gz", {"results": [meas(1.5), meas(900)]})
    whole = gzip.open(f"{land}/1_2_A_2024-01-01_2024-03-31_page1.json.gz").read()
    with gzip.open(f"{land}/1_2_A_2024-01-01_2024-03-31_page2.json.gz", "wb") as out:
        out.write(whole[:len(whole) // 2])
    put(land, "_hidden.json.gz", {"results": [meas(5)]})
    lake.ingest_measurements(max_files=1)
    put(land, "1_3_A_2024-01-01_2024-03-31_page1.json.gz", {"results": [meas(2.5), meas(-1)]})
    lake = LastingLake(spark, f"{tmpdir_path}/lake")
    lake.ingest_measurements(max_files=1)
    counts = {(r.rule_set, r.rule): (r.failed_rows, r.total_rows) for r in lake.rule_counts().collect()}
    assert counts["measurements_files", "document is complete"] == (1, 3)
    assert counts["measurements", "value is sensible"] == (2, 4)
    rows = lake.house.table("fct_pollution").collect()
    assert sorted((r.sensor_id, r.value) for r in rows) == [(2, 1.5), (3, 2.5)]


def test_files_get_their_names(spark, tmpdir_path):
    docs = spark.createDataFrame([("a b+c%.json", 1, False), ("x.json", 2, True)],
                                 "file string, v int, cut boolean")
    for _ in range(2):      # a second attempt replaces the first
        land_files(docs, f"file://{tmpdir_path}/l", "file", "cut")
    assert sorted(os.listdir(f"{tmpdir_path}/l")) == ["a b+c%.json.gz", "x.json.gz"]
    from aerolake.sources.landing import CORRUPT_FIELD, json_stream

    stream = json_stream(spark, f"{tmpdir_path}/l", T.StructType([T.StructField("v", T.IntegerType())]),
                         "*.json.gz", multiline=True, corrupt=True)
    ingest.run_available(stream, f"{tmpdir_path}/ck", f"{tmpdir_path}/out")
    rows = {r._landing_name: (r.v, r[CORRUPT_FIELD] is None)
            for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    assert rows == {"a b+c%.json.gz": (1, True), "x.json.gz": (None, False)}


def test_types_widen():
    s = lambda ddl: T.DataType.fromDDL(ddl)
    assert E.widen(s("struct<a: bigint, b: string>"), s("struct<c: boolean, a: double>")) == s(
        "struct<a: double, b: string, c: boolean>")
    assert E.widen(s("array<struct<x: bigint>>"), s("array<struct<y: bigint>>")) == s(
        "array<struct<x: bigint, y: bigint>>")
    assert E.widen(s("bigint"), s("struct<a: int>")) == T.StringType()
    assert E.hinted(s("struct<r: array<struct<id: bigint>>>"), {"r.element.id": "INT", "n.v": "FLOAT"}
                    ) == s("struct<r: array<struct<id: int>>, n: struct<v: float>>")


def test_schema_is_stored_and_widened(spark, tmpdir_path):
    land, feed = f"{tmpdir_path}/in", E.EvolvingFeed(spark, f"{tmpdir_path}/feed")
    assert feed.read() is None
    put(land, "a 1.json.gz", {"id": 1, "o": {"x": 1}, "l": [{"p": 1}], "none": None, "mix": 1})
    assert feed.ingest(land, "*.json.gz", whole_files=True) == [1]
    assert feed.ingest(land, "*.json.gz", whole_files=True) == []
    put(land, "b.json.gz", {"id": 2, "o": {"x": 2}, "l": [], "mix": 7})
    feed = E.EvolvingFeed(spark, f"{tmpdir_path}/feed")
    assert feed.ingest(land, "*.json.gz", whole_files=True) == []      # nothing new to store
    put(land, "c.json.gz", {"id": 3, "o": {"x": 2.5, "y": "n"}, "l": [{"p": 2, "q": True}],
                            "none": "now", "mix": {"deep": 1}})
    with gzip.open(f"{land}/d.json.gz", "wt") as out:
        out.write('{"id": 4, "o"')
    assert feed.ingest(land, "*.json.gz", whole_files=True) == [2]
    rows = {r.source_file_name: r for r in feed.read().collect()}
    assert set(rows) == {"a 1.json.gz", "b.json.gz", "c.json.gz", "d.json.gz"}
    a, c, d = rows["a 1.json.gz"], rows["c.json.gz"], rows["d.json.gz"]
    assert (a.id, a.o.x, a.o.y, a.none, a.mix, a.schema_version) == (1, 1.0, None, None, "1", 1)
    assert (a.l[0].p, a.l[0].q, c.l[0].q, c.o.x, c.none) == (1, None, True, 2.5, "now")
    assert c.mix == '{"deep":1}' and d.id is None and d._corrupt_record == '{"id": 4, "o"'
    assert sorted(E.stored_versions(spark, feed.schemas)) == [1, 2]


def test_orphans_of_all_relations_together(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (9, "b"), (9, "a"), (None, "z")],
                                  "x int, y string")
    numbers = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n long")
    texts = spark.createDataFrame([("a",)], "t string")
    got = {r.relation: (r.orphan_keys, r.orphan_rows) for r in audit.orphan_audit([
        ("x", child, "x", numbers, "n"), ("y", child, "y", texts, "t"),
        ("n", numbers, "n", numbers, "n")]).collect()}
    assert got == {"x": (1, 2), "y": (2, 3), "n": (0, 0)}


def test_yesterday():
    assert yesterday("2024-03-01") == "2024-02-29"
    assert len(yesterday()) == 10
