"""Keep one row per key, deterministically."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(items):
    return [F.col(c) if isinstance(c, str) else c for c in items]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Top-1 row per key by ``order`` (e.g. load time DESC plus tie-breaks).

    ``row_number() ... = 1``: Catalyst inserts a partial window-group limit
    before the shuffle, so every task forwards at most one row per key and a
    hot key cannot pile up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple per key (first write wins).

    Written as an aggregate, so each task reduces its rows to one per key
    before the shuffle (partial aggregation) and a key holding a third of
    all rows costs one row per task on the wire.  With one order column and
    fixed-width payload columns it is ``min_by(col, order)`` per column,
    which runs as a hash aggregate; otherwise ``min(struct(order...,
    payload...))`` (sort-based).  Order columns must be non-NULL and
    identify a row within a key.
    """
    payload = [c for c in df.columns if c not in keys and c not in order]
    types = {f.name: f.dataType for f in df.schema.fields}
    if len(order) == 1 and all(isinstance(types[c], FIXED_WIDTH) for c in payload + order):
        o = F.col(order[0])
        aggs = [F.min(o).alias(order[0])] + [F.min_by(F.col(c), o).alias(c) for c in payload]
        return df.groupBy(*keys).agg(*aggs).select(*df.columns)
    best = F.min(F.struct(*_cols(order), *_cols(payload))).alias("_w")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + payload])
            .select(*df.columns))


PREFIX = 3  # characters by which values are told apart before they are numbered


def dense_places(df: DataFrame, column: str, name: str) -> DataFrame:
    """(``column``, ``name``): each distinct non-NULL value and its dense rank, from 1.

    Values are numbered within their first ``PREFIX`` characters, which sort as the
    values do, and moved on by the number of values with lesser ones: no task orders
    more than the values of one prefix, or the counts of all prefixes.
    """
    values = (df.filter(F.col(column).isNotNull()).select(column).distinct()
              .withColumn("_p", F.substring(column, 1, PREFIX)))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = values.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select(
        "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(column))
    return (values.withColumn("_at", within).join(counts, "_p")
            .select(column, (F.col("_before") + F.col("_at")).cast("int").alias(name)))
