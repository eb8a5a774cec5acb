"""Audits of declared keys and references (the DDL constraints of the
source are informational only, so they are checked here)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _any_null(cols):
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in cols))


def key_audit_one(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total rows, distinct keys, duplicated keys, rows under
    duplicated keys and rows with a NULL key part.

    Counting per key is a partial aggregate, so a key holding a third of
    the rows is reduced map-side before the shuffle.
    """
    per_key = (df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("null_key", _any_null(keys)))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long")
        .alias("rows_in_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("null_key"), F.col("n"))), F.lit(0)).cast("long")
        .alias("null_key_rows"),
    )


def key_audit(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [key_audit_one(*t) for t in tables])


KEY = ["relation", "number", "text"]
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _references(tables: list[tuple[DataFrame, list[tuple[int, str, bool]]]],
                parent: bool) -> DataFrame:
    """(relation, number, text, parent) of the non-NULL keys of each relation.

    A key is a number or, where a relation's columns are not both whole numbers, a
    text; the other column holds a constant.  A table is read once for all its
    relations: every row gives one key per relation.
    """
    parts = []
    for table, columns in tables:
        keys = F.array(*[F.struct(
            F.lit(relation).alias("relation"),
            (F.col(column).cast("long") if whole else F.when(F.col(column).isNotNull(), 0)
             .cast("long")).alias("number"),
            (F.lit("") if whole else F.col(column).cast("string")).alias("text"))
            for relation, column, whole in columns])
        parts.append(table.select(F.explode(keys).alias("k")).select("k.*")
                     .filter("number is not null").withColumn("parent", F.lit(parent)))
    return reduce(DataFrame.unionByName, parts)


def _by_table(columns: list[tuple[DataFrame, int, str, bool]]) -> list:
    """(table, relation, column, whole) grouped by table, as ``_references`` takes it."""
    out: dict[int, tuple[DataFrame, list]] = {}
    for table, *rest in columns:
        out.setdefault(id(table), (table, []))[1].append(tuple(rest))
    return list(out.values())


def orphan_audit(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per relation ``(name, child, child column, parent, parent column)`` the keys
    and rows of the child whose (non-NULL) reference has no parent row.

    Every child and every parent is read once, however many relations it has
    (tables count as one when they are the same DataFrame object); all relations
    share one aggregate of their keys, counted in the same task before the shuffle.
    """
    # Relations go by number and whole keys as such: a key is held in as few bytes
    # as it has, however long the names are.  Children and parents meet in one hash
    # aggregate, so a task sorts nothing and holds every key once.
    whole = [all(isinstance(t.schema[col].dataType, WHOLE) for t, col in ((c, cc), (p, pc)))
             for _, c, cc, p, pc in relations]
    child = _references(_by_table([(c, i, col, whole[i])
                                   for i, (_, c, col, _, _) in enumerate(relations)]), False)
    parent = _references(_by_table([(p, i, col, whole[i])
                                    for i, (_, _, _, p, col) in enumerate(relations)]), True)
    orphans = (child.unionByName(parent).groupBy(*KEY)
               .agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("parent"))
               .filter(~F.col("parent")))
    # One global row first, so a relation without orphans is reported too.
    mine = lambda i: F.col("relation") == i
    sums = orphans.agg(*[c for i in range(len(relations)) for c in (
        F.count_if(mine(i)).alias(f"k{i}"), F.sum(F.when(mine(i), F.col("n"))).alias(f"n{i}"))])
    rows = [F.struct(F.lit(r[0]).alias("relation"), F.col(f"k{i}").alias("orphan_keys"),
                     F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("long").alias("orphan_rows"))
            for i, r in enumerate(relations)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
