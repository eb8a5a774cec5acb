"""One row per key of a stream, chosen by an order and not by arrival.

For each key the row with the least (or greatest) tuple of order and payload columns
is kept.  ``keyed_stream`` holds these rows as streaming state, ``merge_batch``
compares a micro-batch with the table; either writes what changes to the folder of
its micro-batch, which a replay overwrites.  Readers reduce those rows the same way, so
the table does not depend on the order in which files arrive, and a key's row is
replaced when a better one comes late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import try_read
from .ingest import run_available


def _ranked(columns: list[str], keys: list[str], order: list[str]) -> list[str]:
    """The columns that rows of a key are compared by: ``order``, then the others."""
    return [*order, *[c for c in columns if c not in keys and c not in order]]


def _best(rows: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    ranked = _ranked(rows.columns, keys, order)
    pick = F.max if latest else F.min
    return (rows.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_w"))
            .select(*keys, *[F.col(f"_w.`{c}`").alias(c) for c in ranked]))


def keyed_stream(rows: DataFrame, keys: list[str], order: list[str], checkpoint: str, path: str,
                 latest: bool = False) -> list:
    """Run ``rows`` into the table at ``path``: the row with the least ``order`` per
    key, or the greatest with ``latest``; equal ones by their other columns.  Gives
    the progress reports."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run_available(_best(rows, keys, order, latest), checkpoint, foreach_batch=each_batch)


def merge_batch(rows: DataFrame, keys: list[str], order: list[str], path: str, batch_id: int,
                latest: bool = False) -> None:
    """The same without state, for small tables, as a step of a ``foreachBatch``: of a
    micro-batch the rows that are new, or better than the table's row."""
    best = _best(rows, keys, order, latest)
    known = try_read(rows.sparkSession, path, f"{rows.schema.toDDL()}, batch bigint")
    if known is not None:
        # A replay must not compare its rows with themselves.
        known = known.filter(F.col("batch") != batch_id).drop("batch")
        new = F.struct(*_ranked(known.columns, keys, order))
        old = _best(known, keys, order, latest).select(*keys, new.alias("_old"))
        better = new > F.col("_old") if latest else new < F.col("_old")
        best = best.join(old, keys, "left").filter(F.col("_old").isNull() | better).drop("_old")
    best.select(*rows.columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_keyed(spark: SparkSession, path: str, schema, keys: list[str], order: list[str],
               latest: bool = False) -> DataFrame:
    """The table that ``keyed_stream`` keeps; empty before its first row."""
    changes = try_read(spark, path, schema)
    if changes is None:
        return spark.createDataFrame([], schema)
    return _best(changes.select(*schema.fieldNames()), keys, order, latest)
