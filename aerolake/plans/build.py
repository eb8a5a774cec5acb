"""Materialise the lake: silver dimensions and facts, then gold views, each
written as a parquet table under one root of the shared folder.

Gold is computed from the *written* silver tables (and the monthly view
from the written daily table), as the source pipelines read tables: each
layer is a lineage cut, so a lost executor recomputes from the last
written layer, never from the landing data.  Tables are registered in the
session catalog so Spark SQL can read them by name and ``ANALYZE`` can
give the planner column statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import month_int, time_int
from ..operators import dims, gold
from ..operators.facts import (POLLUTION_KEY, insert_new, pollution_fact_rows, touched_months,
                               with_partition)
from ..operators.planning import SENSOR_BLOCK
from ..session import scratch_path
from ..sources.schemas import FCT_POLLUTION, FCT_POLLUTION_TABLE
from ..sources.tables import Tables
from ..sources.warehouse import Warehouse
from .model import Lake
from .planning_sql import temp_views

SILVER = "02_silver"
GOLD = "03_gold"
DIMENSIONS = ["dim_pollution_locations", "dim_pollution_parameters", "dim_pollution_sensors",
              "dim_weather_locations", "dim_calendar", "dim_time"]
# Facts and the columns that joins and filters use: their statistics are kept.
FACTS = {"fct_pollution": ["date_int", "time_int", "location_id", "sensor_id"],
         "fct_weather": ["date_int", "time_int", "location_id"]}
VIEWS = ["agg_pollution_daily", "agg_pollution_monthly", "agg_pollution_hourly",
         "agg_pollution_hourly_by_city", "agg_weather_hourly"]


def write_table(df: DataFrame, path: str, sort_by: list[str] | None = None,
                partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` (create-or-replace).

    ``sort_by`` range-partitions and sorts the rows (clustered layout: row
    group min/max statistics then skip data on range filters);
    ``partition_by`` adds directory partitions for partition pruning.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class LakeTables(Warehouse):
    """Paths and catalog tables of one materialised lake."""

    def read(self, name: str, months: list[int] | None = None) -> DataFrame:
        """A written table, by name from the catalog, so that the planner knows its
        statistics; with ``months`` only those partitions."""
        df = self.table(name)
        if "date_month" not in df.columns:
            return df
        return (df if months is None else df.filter(F.col("date_month").isin(months))).drop(
            "date_month")


def build_silver(lake: Lake, out: LakeTables) -> None:
    spark = lake.spark
    s = lambda n: out.path(SILVER, n)
    write_table(lake.dim_locations, s("dim_pollution_locations"))
    write_table(lake.dim_parameters, s("dim_pollution_parameters"))
    write_table(lake.dim_sensors, s("dim_pollution_sensors"), sort_by=["sensor_id"])
    dims.merge_insert_only(spark, lake.dim_weather_locations, s("dim_weather_locations"),
                           ["location_id"])
    write_table(lake.dim_calendar, s("dim_calendar"), sort_by=["date_int"])
    write_table(dims.time_of_day(spark), s("dim_time"), sort_by=["time_int"])
    for name, fct in (("fct_pollution", lake.fct_pollution), ("fct_weather", lake.fct_weather)):
        # Range keys beyond the day let one hot day spread over many writers.
        write_table(fct.withColumn("date_month", month_int(F.col("date_int"))), s(name),
                    sort_by=["date_month", "date_int", "location_id", "id"],
                    partition_by=["date_month"])
    for name in DIMENSIONS:
        out.expose(SILVER, name)
        out.analyze(name)
    for name, keys in FACTS.items():
        out.expose(SILVER, name, partitioned=True)
        out.analyze(name, keys)


# Writers of one day of a gold table.
SPREAD = 8


def write_months(out: LakeTables, name: str, df: DataFrame, sort_by: list[str]) -> None:
    """Replace only the month partitions present in ``df`` (dynamic partition
    overwrite); other months stay as they are.  Rows are dealt by day and a hash of
    the other sort keys, so a day has several writers and nothing is sampled."""
    df = df.withColumn("date_month", month_int(F.col("date_int")))
    spread = F.pmod(F.xxhash64(*sort_by[1:]), F.lit(SPREAD))
    (df.repartition("date_month", sort_by[0], spread).sortWithinPartitions("date_month", *sort_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_month").parquet(out.path(GOLD, name)))
    out.expose(GOLD, name, partitioned=True)


def build_gold(out: LakeTables, months: list[int] | None = None,
               facts: list[str] = ("fct_pollution", "fct_weather")) -> None:
    """Compute the gold views of ``facts`` from the silver tables.

    With ``months`` only those months are recomputed -- facts and the daily
    table are read with a partition filter, so the work follows the change
    (a late or replayed month), not the whole history -- and only their
    partitions are replaced.
    """
    read = lambda n: out.read(n, months)
    if "fct_pollution" in facts:
        fct, sen, par, loc, cal = (read("fct_pollution"), read("dim_pollution_sensors"),
                                   read("dim_pollution_parameters"),
                                   read("dim_pollution_locations"), read("dim_calendar"))
        write_months(out, "agg_pollution_daily", gold.daily(fct, sen, par, loc, cal),
                     ["date_int", "location_id"])
        write_months(out, "agg_pollution_monthly", gold.monthly(read("agg_pollution_daily"), cal),
                     ["date_int", "location_id"])
        write_months(out, "agg_pollution_hourly", gold.hourly(fct, sen, par, loc),
                     ["date_int", "time_int", "location_id"])
        write_months(out, "agg_pollution_hourly_by_city",
                     gold.hourly_by_city(read("agg_pollution_hourly")),
                     ["date_int", "time_int", "city"])
    if "fct_weather" in facts:
        write_months(out, "agg_weather_hourly",
                     gold.weather_hourly(read("fct_weather"), read("dim_weather_locations")),
                     ["date_int", "time_int", "location_id"])


def build_lake(spark: SparkSession, sf_dir: str, root: str | None = None) -> LakeTables:
    out = LakeTables(spark, root or scratch_path(spark, "lake"))
    build_silver(Lake(spark, sf_dir), out)
    build_gold(out)
    return out


def q_gold_incremental(spark, sf_dir):
    """Build the lake from the first landing round, insert the second round
    into the fact table (first write wins, months logged), refresh only the
    touched months of gold, and serve the daily view."""
    lo_hi = Tables(spark, sf_dir).events.agg(F.min("event_id"), F.max("event_id")).first()
    mid = (int(lo_hi[0]) + int(lo_hi[1])) // 2
    out = LakeTables(spark, scratch_path(spark, "lake-inc"))
    build_silver(Lake(spark, sf_dir, F.col("event_id") < mid), out)
    build_gold(out)
    late = Lake(spark, sf_dir, F.col("event_id") >= mid).clean_measurements()
    rows = pollution_fact_rows(late, extra=["event_id"])
    changes = out.path(SILVER, "changes_fct_pollution")
    insert_new(spark, rows, out.path(SILVER, "fct_pollution"), FCT_POLLUTION.fieldNames(),
               ["event_id"], changes_path=changes, run_id="round2")
    out.expose(SILVER, "fct_pollution", partitioned=True)
    build_gold(out, touched_months(spark, changes, "round2"), ["fct_pollution"])
    return out.read("agg_pollution_daily").withColumn(
        "avg_value", F.round(F.col("avg_value"), 6))


def q_gold_tables(spark, sf_dir):
    """Build every silver and gold table, then serve the monthly view from
    its written table."""
    out = build_lake(spark, sf_dir)
    return out.read("agg_pollution_monthly").withColumn(
        "avg_value", F.round(F.col("avg_value"), 6))


def q_lake_tables(spark, sf_dir):
    """Every written table read back by name: its rows, and of its first column (a
    key or a date) the distinct values."""
    out = build_lake(spark, sf_dir)
    found = None
    for name in [*DIMENSIONS, *FACTS, *VIEWS]:
        table = out.read(name)
        part = table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                         F.count_distinct(F.col(table.columns[0])).alias("n_first"))
        found = part if found is None else found.unionByName(part)
    return found


def q_dim_calendar_rolling(spark, sf_dir):
    """The five-year calendar up to the last event day as a table: created, then
    replaced by the same rows, and read back in the order of its files."""
    out = LakeTables(spark, scratch_path(spark, "calendar"))
    last = Tables(spark, sf_dir).events.agg(F.max("ts").alias("hi"))
    days = dims.rolling_between(last, F.to_date("hi"))
    for _ in range(2):
        out.replace(SILVER, "dim_calendar", days, ["date_int"])
    return out.in_file_order("dim_calendar")


def q_dim_time_table(spark, sf_dir):
    """The time dimension as a replaced table, read back in order, with the number of
    events in each hour."""
    out = LakeTables(spark, scratch_path(spark, "time"))
    for _ in range(2):
        out.replace(SILVER, "dim_time", dims.time_of_day(spark), ["time_int"])
    hours = (Tables(spark, sf_dir).events.groupBy(time_int(F.date_trunc("hour", "ts"))
                                                  .alias("time_int"))
             .agg(F.count(F.lit(1)).alias("n_events")))
    return out.in_file_order("dim_time").join(hours, "time_int", "left")


def q_create_if_absent(spark, sf_dir):
    """The fact table with its fixed schema, made and filled; a second call (a new
    warehouse on the same root) leaves its rows."""
    root = scratch_path(spark, "create")
    fct = Lake(spark, sf_dir).fct_pollution.withColumn("sensor_id", F.col("sensor_id").cast("int"))
    made = []
    for _ in range(2):
        house = Warehouse(spark, root)
        made.append(house.create_if_absent(SILVER, "fct_pollution", FCT_POLLUTION_TABLE,
                                           partition_by=["date_month"], bucket_by=POLLUTION_KEY,
                                           comment="Fact table for pollution measurements"))
        if made[-1]:
            house.append("fct_pollution", with_partition(fct))
    return house.table("fct_pollution").drop("date_month").withColumn(
        "made", F.lit(",".join(str(m).lower() for m in made)))


SENSORS_BY_CITY_SQL = """
SELECT l.location_id AS id, floor(s.sensor_id / :block) AS sensor_block,
       array_join(sort_array(collect_list(s.sensor_id)), ',') AS sensor_id_arr,
       l.name AS name
FROM IDENTIFIER(:locations) AS l
JOIN IDENTIFIER(:sensors) AS s ON s.location_id = l.location_id
JOIN IDENTIFIER(:parameters) AS p ON p.parameter_id = s.parameter_id
WHERE p.name IN (:p1, :p2, :p3) AND l.city = :city
GROUP BY l.location_id, l.name, floor(s.sensor_id / :block)
"""


def q_sql_sensors_by_city(spark, sf_dir):
    """The per-city backfill list as parameterised Spark SQL: table names
    through ``IDENTIFIER(:name)``, values through named markers."""
    from .catalog import PLAN_CITY, PLAN_PARAMETERS

    lake = Lake(spark, sf_dir)
    names = temp_views({"locations": lake.dim_locations, "sensors": lake.dim_sensors,
                        "parameters": lake.dim_parameters})
    args = dict(names, city=PLAN_CITY, block=SENSOR_BLOCK,
                **{f"p{i + 1}": p for i, p in enumerate(PLAN_PARAMETERS)})
    return spark.sql(SENSORS_BY_CITY_SQL, args=args)


BUILD_QUERIES = {
    "sql_sensors_by_city": q_sql_sensors_by_city,
    "gold_tables": q_gold_tables,
    "gold_incremental": q_gold_incremental,
    "lake_tables": q_lake_tables,
    "dim_calendar_rolling": q_dim_calendar_rolling,
    "dim_time_table": q_dim_time_table,
    "create_if_absent": q_create_if_absent,
}
