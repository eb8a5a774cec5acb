"""Keyed facts: key derivation, in-batch dedup and the insert-only upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import date_int, month_int, pollution_key, time_int, weather_key
from ..sources.schemas import WEATHER_VARIABLES
from ..sources.tables import try_read
from ..sources.warehouse import Warehouse
from .dedup import first_per_key

PARTITION_COLUMN = "date_month"


def pollution_fact_rows(clean: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Clean measurements to fact rows: hashed id, date_int, time_int."""
    ts = F.col("datetime_from")
    return clean.select(
        pollution_key(F.col("sensor_id"), F.col("location_id"), ts).alias("id"),
        date_int(ts).alias("date_int"),
        time_int(ts).alias("time_int"),
        "value", "location_id", "sensor_id", *extra,
    )


def weather_fact_rows(rows: DataFrame, extra: list[str] = ()) -> DataFrame:
    ts = F.col("datetime")
    return rows.select(
        weather_key(F.col("location_id"), ts).alias("id"),
        "location_id",
        date_int(ts).alias("date_int"),
        time_int(ts).alias("time_int"),
        *[n for n, _, _ in WEATHER_VARIABLES], *extra,
    )


def dedup_batch(batch: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """First row per key inside one batch, by ``order`` (load time, file,
    then values) -- equal ids arriving together are inserted once."""
    return first_per_key(batch, [key], order)


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, month_int(F.col("date_int")))


def insert_new(spark: SparkSession, batch: DataFrame, target_path: str, columns: list[str],
               order: list[str], key: str = "id", changes_path: str | None = None,
               run_id: str | None = None, dedup: bool = True) -> int:
    """Insert-only upsert of one batch into a parquet fact table.

    1. dedup the batch by key (first write wins, deterministic order);
    2. drop keys already in the target -- the key embeds the timestamp, so a
       match can only lie in one of the batch's own months: the target scan
       is restricted to those (partition pruning on ``date_month``; one stray
       old row adds one month, not all between) and to the key column;
    3. append the rest, partitioned by month.

    Re-running a batch (e.g. after a crash between append and commit)
    inserts nothing twice.  With ``changes_path`` the months that received
    rows are appended there as ``(run_id, date_month)`` -- the change log
    that drives an incremental gold refresh.  ``dedup=False`` skips step 1
    for a batch the caller has already reduced to one row per key.  Returns
    the rows appended.
    """
    deduped = with_partition((dedup_batch(batch, order, key) if dedup else batch)
                             .select(*columns)).persist()
    try:
        months = [r[0] for r in deduped.select(PARTITION_COLUMN).distinct().collect()]
        if not months:
            return 0
        fresh = deduped
        existing = existing_keys(spark, target_path, key, months, deduped.schema)
        if existing is not None:
            fresh = deduped.join(existing, on=key, how="left_anti")
        # Log the touched months before the append: a crash in between only
        # makes a refresh recompute a month it need not.
        if changes_path:
            (fresh.select(PARTITION_COLUMN).distinct()
             .select(F.lit(run_id).alias("run_id"), PARTITION_COLUMN)
             .write.mode("append").parquet(changes_path))
        added = Observation()
        (fresh.observe(added, F.count(F.lit(1)).alias("n"))
         .write.mode("append").partitionBy(PARTITION_COLUMN).parquet(target_path))
        return int(added.get["n"])
    finally:
        deduped.unpersist()


# The natural keys of the facts, by which their tables are bucketed; a reading starts
# on a minute, so its id is a hash of them.
POLLUTION_KEY = ["sensor_id", "location_id", "date_int", "time_int"]
WEATHER_KEY = ["location_id", "date_int", "time_int"]


def unseen(warehouse: Warehouse, table: str, batch: DataFrame, key: list[str],
           months: list[int]) -> DataFrame:
    """The rows of a batch whose natural key is not in a catalog table.

    The table is bucketed by ``key``, so only the batch is shuffled (into the
    table's buckets); of the table just these months and the key columns are read.
    """
    known = warehouse.table(table).filter(F.col(PARTITION_COLUMN).isin(months))
    return batch.join(known.select(*key), key, "left_anti")


def insert_unseen(warehouse: Warehouse, table: str, batch: DataFrame, key: list[str],
                  late: dict[str, Column]) -> int:
    """Insert-only upsert of a batch with one row per natural key into a catalog
    table; gives the rows added.  Running a batch again adds nothing.  ``late``
    columns (the hashed id) are computed for the rows that are added."""
    rows = with_partition(batch).persist()
    try:
        months = [r[0] for r in rows.select(PARTITION_COLUMN).distinct().collect()]
        if not months:
            return 0
        fresh = unseen(warehouse, table, rows, key, months)
        return warehouse.append(table, fresh.withColumns(late))
    finally:
        rows.unpersist()


def existing_keys(spark: SparkSession, path: str, key: str, months: list[int], schema):
    """Keys of the fact table at ``path`` in these months only (one value per
    month, so the list is short); None when there is no table yet."""
    t = try_read(spark, path, schema)
    if t is None:
        return None
    known = [m for m in months if m is not None]
    wanted = F.col(PARTITION_COLUMN).isin(known)
    if len(known) < len(months):
        wanted = wanted | F.col(PARTITION_COLUMN).isNull()
    return t.filter(wanted).select(key)


def touched_months(spark: SparkSession, changes_path: str, run_id: str) -> list[int]:
    """Months changed by one run (a handful of values: one per month)."""
    log = try_read(spark, changes_path)
    if log is None:
        return []
    rows = log.filter(F.col("run_id") == run_id).select(PARTITION_COLUMN).distinct().collect()
    return sorted(int(r[0]) for r in rows)
