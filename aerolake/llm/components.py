"""Connected components of a link table, by alternating large and small stars.

Every round is two aggregations and two joins on the link table, written to
the shared folder; links become stars around the smallest id of their
component.  No neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.store import materialise


def _links(a, b) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (links.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
            .filter("v <> m").select(*_links(F.col("v"), F.col("m"))).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = (links.join(least, "a").filter("b <> m")
             .select(*_links(F.col("b"), F.col("m"))))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b) that is not itself the
    smallest of its component; links may repeat, loops are ignored."""
    now = materialise(links.filter("a <> b").select(*_links(F.col("a"), F.col("b")))
                      .distinct(), f"{folder}/links-0")
    turn, before = 0, None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        turn, before = turn + 1, mark
        now = materialise(_small_star(_large_star(now)), f"{folder}/links-{turn}")
