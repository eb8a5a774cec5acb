"""Documents as a downloader leaves them -- one gzip JSON file each, named by feed,
place and period, some cut off -- and the lake that ingests them over two calls.

Stations stand for sensors, so that files are few: a station is a nation's market
segment, its id the least key of its customers; the events of all of them are its
measurements.  Records have the faults of ``raw.RawFeeds``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import chunk_name, page_file_name
from ..session import scratch_path
from ..sources.evolving import EvolvingFeed
from ..sources.landing import SPARK_PART_GLOB, land_files, land_json
from ..streaming.lake import LastingLake
from .model import hour_of
from .raw import RawFeeds, unless
from .streams import PAGE_SPAN

# Which documents come in which round.
FIRST_NATIONS = 12    # weather documents of nations up to this one come first
SECOND_REGIONS = 2    # location documents of regions up to this one come again
FIRST_BALANCE = 4500  # suppliers below this balance come first


def stations(lake: RawFeeds) -> DataFrame:
    """(c_nationkey, c_mktsegment, station)."""
    return (lake.t.customer.filter("c_nationkey is not null and c_mktsegment is not null")
            .groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("station")))


def place(lake: RawFeeds) -> DataFrame:
    n, r = lake.t.nation, lake.t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.translate("n_name", "_", " ").alias("name"),
        "n_name", "r_name", "n_regionkey")


def _local(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def measurement_files(lake: RawFeeds) -> DataFrame:
    """(file_name, round, cut, results): pages of a station's month, at most
    ``PAGE_SPAN`` events wide; earlier events come in round 1.  Each first page of a
    location's first station also has a copy that was cut off."""
    own = stations(lake)
    users = (lake.t.customer.join(own, ["c_nationkey", "c_mktsegment"])
             .select(F.col("c_custkey").alias("user_id"), "c_nationkey", "station"))
    bounds = lake.t.events.agg(F.min("event_id"), F.max("event_id")).first()
    mid = ((bounds[0] or 0) + (bounds[1] or 0)) // 2
    start, k = hour_of(F.col("ts")), F.col("k")
    end = start + F.expr("INTERVAL 1 HOUR")
    begun = unless(k == 17, start)
    record = F.struct(
        unless(k == 13, F.col("value") * 2 - 5).cast("float").alias("value"),
        F.struct(F.lit(None).cast("int").alias("id")).alias("parameter"),
        F.struct(F.when(F.col("event_type") == "error", "00:30:00").otherwise("01:00:00")
                 .alias("interval"),
                 F.struct(_local(begun).alias("local"), begun.alias("utc")).alias("datetimeFrom"),
                 F.struct(_local(end).alias("local"), end.alias("utc")).alias("datetimeTo"))
        .alias("period"))
    turn = F.when(F.col("event_id") < mid, 1).otherwise(2)
    first = own.groupBy("c_nationkey").agg(F.min("station").alias("first_station"))
    rows = (lake.events().join(users, "user_id").join(place(lake), "c_nationkey")
            .join(first, "c_nationkey"))
    chunk = chunk_name(F.col("c_nationkey"), F.col("station"), F.col("name"),
                       F.trunc("ts", "month"), F.last_day("ts"))
    page = F.floor(F.col("event_id") / PAGE_SPAN) * 2 + turn
    pages = (rows.groupBy(page_file_name(chunk, page).alias("file_name"), turn.alias("round"),
                          (F.col("station") == F.col("first_station")).alias("first"))
             .agg(F.sort_array(F.collect_list(F.struct("event_id", record.alias("r")))).alias("x"))
             .withColumn("results", F.transform("x", lambda x: x["r"])))
    copies = F.when(F.col("first") & (F.col("round") == 1),
                    F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return pages.select("file_name", "round", "results", F.explode(copies).alias("cut")).withColumn(
        "file_name", F.when(F.col("cut"), F.regexp_replace("file_name", "_page", "_page0"))
        .otherwise(F.col("file_name")))


def location_files(lake: RawFeeds) -> DataFrame:
    """(file_name, round, results): the locations of a region with their stations;
    some regions come again in round 2, with new names."""
    own, seg = stations(lake), lake.segment_ids()
    named = lake.t.customer.select(F.col("c_custkey").alias("station"), F.col("c_name"))
    sensor = F.struct(
        F.col("station").alias("id"), F.col("c_name").alias("name"),
        F.struct(F.col("parameter_id").cast("long").alias("id"),
                 F.lower("c_mktsegment").alias("name"), F.col("c_mktsegment").alias("displayName"),
                 F.lit(None).cast("string").alias("units")).alias("parameter"))
    sensors = (own.join(seg, "c_mktsegment").join(named, "station")
               .groupBy("c_nationkey").agg(F.sort_array(F.collect_list(sensor)).alias("sensors")))
    turns = F.when(F.col("n_regionkey") <= SECOND_REGIONS, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))
    rows = (place(lake).join(sensors, "c_nationkey", "left")
            .select("*", F.explode(turns).alias("round")))
    name = F.when(F.col("round") == 1, F.concat(F.lit("Old "), F.col("name"))).otherwise(
        unless(F.col("n_name").endswith("7"), F.col("name")))
    location = F.struct(
        unless(F.col("n_name") == "NATION_13", F.col("c_nationkey").cast("int")).alias("id"),
        name.alias("name"), F.col("r_name").alias("locality"),
        F.struct(F.col("n_name").alias("code")).alias("country"),
        F.struct(F.col("c_nationkey").cast("float").alias("latitude"),
                 F.col("n_regionkey").cast("float").alias("longitude")).alias("coordinates"),
        F.col("sensors").alias("sensors"))
    file_name = F.concat("r_name", F.when(F.col("round") == 1, "-locations.json")
                         .otherwise("-locations_2.json"))
    return (rows.groupBy(file_name.alias("file_name"), "round")
            .agg(F.sort_array(F.collect_list(F.struct("c_nationkey", location.alias("l"))))
                 .alias("x"))
            .select("file_name", "round", F.transform("x", lambda x: x["l"]).alias("results")))


def weather_files(lake: RawFeeds) -> DataFrame:
    """Weather documents of a nation's month: the first event of each hour.  Round 2
    holds all nations, with another elevation."""
    users = lake.t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    first = lambda fault: F.min_by(unless(F.col("k") == fault, F.col("value")), "event_id")
    hours = (lake.events().join(users, "user_id")
             .groupBy("c_nationkey", hour_of(F.col("ts")).alias("hour"))
             .agg(first(37).alias("temperature"), first(41).alias("pressure")))
    months = (hours.groupBy("c_nationkey", F.trunc("hour", "month").alias("month"))
              .agg(F.sort_array(F.collect_list(F.struct("hour", "temperature", "pressure")))
                   .alias("x")))
    turns = F.when(F.col("c_nationkey") <= FIRST_NATIONS, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(2)))
    rows = months.join(place(lake), "c_nationkey").select("*", F.explode(turns).alias("round"))
    lost = F.col("c_nationkey") > 20
    return rows.select(
        F.concat(F.lit("openmeteo_"), "r_name", F.lit("-"), F.col("c_nationkey").cast("string"),
                 F.lit("_"), F.date_format("month", "yyyy-MM-dd"), F.lit("_"),
                 F.date_format(F.last_day("month"), "yyyy-MM-dd"),
                 F.when(F.col("round") == 1, ".json").otherwise("_again.json")).alias("file_name"),
        "round", unless(lost, F.col("c_nationkey").cast("double")).alias("latitude"),
        unless(lost, F.col("n_regionkey").cast("double")).alias("longitude"),
        (F.col("round") * 100).cast("double").alias("elevation"), F.lit("GMT").alias("timezone"),
        F.struct(F.transform("x", lambda x: F.date_format(x["hour"], "yyyy-MM-dd'T'HH:mm"))
                 .alias("time"),
                 F.transform("x", lambda x: x["temperature"]).alias("temperature_2m"),
                 F.transform("x", lambda x: x["pressure"]).alias("surface_pressure"))
        .alias("hourly"))


FEEDS = {"measurements": measurement_files, "locations": location_files, "weather": weather_files}


def two_rounds(spark: SparkSession, sf_dir: str, feed: str, **options) -> LastingLake:
    """Land a feed's first round and ingest it, then the second into the same root by
    a lake of its own, as a later run would."""
    root = scratch_path(spark, f"lasting-{feed}")
    docs = FEEDS[feed](RawFeeds(spark, sf_dir))
    for turn in (1, 2):
        lake = LastingLake(spark, root)
        land_files(docs.filter(F.col("round") == turn).drop("round"), _uri(lake.landing(feed)),
                   "file_name", "cut" if "cut" in docs.columns else None)
        getattr(lake, f"ingest_{feed}")(**options)
    return lake


def _uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def q_lake_measurements(spark, sf_dir):
    """The pollution fact after two calls: a catalog table, made once."""
    return two_rounds(spark, sf_dir, "measurements").house.table("fct_pollution").drop("date_month")


def q_lake_rule_metrics(spark, sf_dir):
    """The rule counts of every micro-batch of both calls, added up."""
    return two_rounds(spark, sf_dir, "measurements").rule_counts()


def q_lake_weather(spark, sf_dir):
    """The weather fact after two calls, the second with every document again."""
    return two_rounds(spark, sf_dir, "weather").house.table("fct_weather").drop("date_month")


def q_lake_weather_locations(spark, sf_dir):
    """Weather locations merged from documents: the second call adds new ones only."""
    return two_rounds(spark, sf_dir, "weather", facts=False).house.table("dim_weather_locations")


def q_lake_locations(spark, sf_dir):
    """The location dimension as a stream: the latest row that passes the rules."""
    return two_rounds(spark, sf_dir, "locations", max_files=None).dimension("locations")


def q_lake_sensors(spark, sf_dir):
    """The sensor dimension as a stream."""
    return two_rounds(spark, sf_dir, "locations", max_files=None).dimension("sensors")


def q_download_files(spark, sf_dir):
    """What the three feeds read from files under their own globs: files, cut-off
    ones, records, records stamped with a time of the run, and the files of a
    micro-batch where these are limited to one."""
    root = scratch_path(spark, "downloads")
    lake = LastingLake(spark, root, landing=f"{root}/00_landing")
    raw, found = RawFeeds(spark, sf_dir), None
    for feed, files in FEEDS.items():
        docs = files(raw).filter(F.col("round") == 1).drop("round")
        land_files(docs, _uri(lake.landing(feed)), "file_name",
                   "cut" if "cut" in docs.columns else None)
    began = spark.sql("SELECT current_timestamp() AS t").first().t
    reports = {"locations": lake.ingest_locations(max_files=1),
               "measurements": lake.ingest_measurements(), "weather": lake.ingest_weather()}
    ended = spark.sql("SELECT current_timestamp() AS t").first().t
    widest = max((r["numInputRows"] for r in reports["locations"]), default=0)
    files = lake.rule_counts().filter(F.col("rule") == "document is complete").select(
        F.regexp_replace("rule_set", "_files$", "").alias("feed"), F.col("total_rows").alias("files"),
        F.col("failed_rows").alias("cut_off"))
    for feed, bronze in (("locations", "locations"), ("measurements", "measurements_raw"),
                         ("weather", "weather_raw")):
        part = spark.read.parquet(lake.bronze(bronze)).agg(
            F.lit(feed).alias("feed"), F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("bronze_load_ts").between(began, ended)).alias("stamped"),
            F.lit(widest if feed == "locations" else None).cast("int").alias("files_per_batch"))
        found = part if found is None else found.unionByName(part)
    return files.join(found, "feed")


def q_ingest_inferred(spark, sf_dir):
    """Undeclared documents over two calls: the second brings new fields and fractions,
    so the stored schema is widened and older rows are read with it."""
    t = RawFeeds(spark, sf_dir).t
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    first = F.col("s_acctbal") < FIRST_BALANCE
    station = [F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")]
    old = s.filter(first).select(F.struct(*station).alias("station"),
                                 F.floor("s_acctbal").alias("elevation"))
    new = s.filter(~first).select(
        F.struct(*station, F.col("n_name").alias("country")).alias("station"),
        F.col("s_acctbal").alias("elevation"), F.array("n_name", "s_name").alias("tags"))
    root = scratch_path(spark, "inferred")
    for docs in (old, new):
        feed = EvolvingFeed(spark, root, hints={"station.id": "INT"})
        land_json(docs, f"{root}/landing")
        feed.ingest(f"{root}/landing", SPARK_PART_GLOB)
    return feed.read().select(
        F.col("station.id").alias("station_id"), "station.name", "station.country", "elevation",
        F.size("tags").alias("n_tags"), "schema_version")


DOWNLOAD_QUERIES = {
    "download_files": q_download_files,
    "lake_measurements": q_lake_measurements,
    "lake_rule_metrics": q_lake_rule_metrics,
    "lake_weather": q_lake_weather,
    "lake_weather_locations": q_lake_weather_locations,
    "lake_locations": q_lake_locations,
    "lake_sensors": q_lake_sensors,
    "ingest_inferred": q_ingest_inferred,
}
