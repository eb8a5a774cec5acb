"""Plan-shape and skew checks: what must hold at any scale."""

from pyspark.sql import functions as F

from aerolake.operators import planning
from aerolake.operators.dedup import first_per_key
from aerolake.plans.model import Lake

from .conftest import SF_SMALL


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_dedup_is_partially_aggregated(spark):
    # one key holds a third of all rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ord"), (F.col("id") * 2).alias("v"))
    out = first_per_key(df, ["k"], ["ord"])
    rows = {r.k: (r.ord, r.v) for r in out.collect()}
    assert rows["hot"] == (0, 0) and len(rows) == 20001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan     # reduced per task before the shuffle


def test_gold_plans_have_no_pair_joins_or_python(spark):
    lake = Lake(spark, SF_SMALL)
    for df in (lake.daily, lake.hourly_by_city, lake.weather_hourly):
        plan = executed_plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                    "BatchEvalPython"):
            assert bad not in plan


def test_rules_reach_the_scan(spark):
    lake = Lake(spark, SF_SMALL)
    plan = lake.clean_measurements()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_global_latest_date_is_a_scalar_subquery(spark):
    lake = Lake(spark, SF_SMALL)
    df = planning.high_water_worklist(lake.dim_locations, lake.dim_sensors, lake.dim_parameters,
                                      lake.fct_pollution, ["building", "household"])
    plan = executed_plan(df)
    assert "Subquery" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_sensor_lists_are_bounded_but_complete(spark):
    locs = spark.createDataFrame([(1, "A", "X")], "location_id int, name string, city string")
    sens = spark.range(2500).select(F.col("id").alias("sensor_id"), F.lit(1).alias("location_id"),
                                    F.lit(7).alias("parameter_id"))
    pars = spark.createDataFrame([(7, "pm10")], "parameter_id int, name string")
    rows = planning.sensors_by_city(locs, sens, pars, "X", ["pm10"]).collect()
    sizes = sorted(len(r.sensor_id_arr) for r in rows)
    assert sizes == [500, 1000, 1000]
    assert sorted(s for r in rows for s in r.sensor_id_arr) == list(range(2500))


def test_scale_conf_sizes_partitions():
    from aerolake.session import scale_conf

    tb = 1024 ** 4
    c = scale_conf(30 * tb, 8000)
    assert c["spark.sql.shuffle.partitions"] == "122880"
    assert c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "122880"
    small = scale_conf(1024 ** 3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192     # 3 tasks per core
    mid = scale_conf(2 * tb, 256)
    assert int(mid["spark.sql.shuffle.partitions"]) == 8192      # 256 MB per reducer


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
             "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def test_no_registered_query_plans_pair_joins_or_python(spark):
    """Planned (not run) physical plan of every batch query: no pair joins,
    no Python in the data path.  AQE may only turn a shuffle join into a
    broadcast hash join at run time, never into one of these."""
    from aerolake.plans.catalog import QUERIES

    from .test_oracle import STREAMING

    from aerolake.plans.build import BUILD_QUERIES

    builds = set(BUILD_QUERIES) - {"sql_sensors_by_city"}      # their steps are checked above
    for name, fn in QUERIES.items():
        if name in STREAMING or name in builds:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_cluster_session_needs_a_shared_checkpoint_folder():
    import pytest

    from aerolake.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_hashed_below_the_dedup(spark):
    """Weather joins and groups on coordinates; only the location dimension is hashed."""
    from aerolake.plans.catalog import QUERIES

    for name in ("corr_by_parameter", "by_wind_bucket", "high_water_by_location"):
        assert "sha2" not in executed(QUERIES[name](spark, SF_SMALL)), name
    plan = executed(QUERIES["weather_hourly"](spark, SF_SMALL))
    facts = [x for x in plan.split("\n") if "sha2" in x]
    assert facts and all("latitude" in x and "datetime" not in x for x in facts)
    plan = executed(Lake(spark, SF_SMALL).fct_weather)
    assert plan.index("sha2") < plan.index("HashAggregate")      # above it in the tree


def test_all_references_of_a_fact_in_one_scan(spark):
    from aerolake.plans.catalog import QUERIES

    plan = executed(QUERIES["orphan_audit_raw"](spark, SF_SMALL))
    assert plan.count("events.parquet") <= 2
    assert executed(QUERIES["orphan_audit"](spark, SF_SMALL)).count("lineitem.parquet") == 1


def test_statistics_change_the_plan(spark, tmpdir_path):
    """A filtered dimension is broadcast only where its columns were analysed."""
    from aerolake.operators import dims
    from aerolake.sources.warehouse import Warehouse

    house = Warehouse(spark, f"{tmpdir_path}/stats")
    house.replace("02_silver", "dim_calendar", dims.calendar(spark, "2000-01-01", "2024-12-31"))
    facts = spark.range(1000).select((F.col("id") + 20240101).cast("int").alias("date_int"))
    facts.write.parquet(f"{tmpdir_path}/facts")

    def join():
        days = house.table("dim_calendar").filter("date_int >= 20241201")
        return executed(spark.read.parquet(f"{tmpdir_path}/facts").join(
            days.select("date_int", "calendar_date"), "date_int"))

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    try:
        before = join()
        house.analyze("dim_calendar")
        after = join()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in before and "BroadcastHashJoin" in after


def test_bucketed_target_is_not_shuffled(spark, tmpdir_path):
    from aerolake.operators.facts import POLLUTION_KEY, unseen
    from aerolake.sources import schemas
    from aerolake.sources.warehouse import Warehouse

    house = Warehouse(spark, f"{tmpdir_path}/buckets")
    house.create_if_absent("02_silver", "fct_pollution", schemas.FCT_POLLUTION_TABLE,
                           ["date_month"], POLLUTION_KEY, buckets=8)
    rows = spark.range(500).selectExpr(
        "string(id) id", "int(20240100 + id % 28) date_int", "int(100 * (id % 24)) time_int",
        "float(id) value", "int(id % 7) location_id", "int(id) sensor_id", "202401 date_month")
    assert house.append("fct_pollution", rows.filter("sensor_id < 300")) == 300
    fresh = unseen(house, "fct_pollution", rows, POLLUTION_KEY, [202401])
    assert fresh.count() == 200
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(unseen(house, "fct_pollution", rows, POLLUTION_KEY, [202401]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    target = plan[plan.index("Bucketed: true") - 600:]
    assert plan.count("Exchange") == 1 and "Exchange" not in target
    assert "PartitionFilters: [isnotnull(date_month" in plan or "date_month" in target


def test_references_meet_in_one_aggregate(spark):
    """Children and parents are not sorted and joined, and keys of any types meet."""
    from aerolake.operators.audit import orphan_audit

    child = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 3), (None, "b", None)],
                                  "i int, s string, m int")
    parent = spark.createDataFrame([(1, "a", "01"), (None, None, "2"), (5, "c", "3"), (1, "a", "x")],
                                   "i long, s string, m string")
    out = orphan_audit([("whole", child, "i", parent, "i"), ("text", child, "s", parent, "s"),
                        ("mixed", child, "m", parent, "m")])
    assert {tuple(r) for r in out.collect()} == {("whole", 1, 1), ("text", 1, 2), ("mixed", 1, 1)}
    assert "Join" not in executed(out)
