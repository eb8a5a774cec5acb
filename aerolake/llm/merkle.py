"""Merkle manifest of a table, with witnesses that grow as leaves are appended.

Every row is a leaf; the leaves of one group (source) are a tree with runs of
``FANOUT`` siblings, and the groups' roots are the leaves of one more tree, whose
root stands for the table.  A leaf's witness is the digests beside its path,
level by level, left to right.

Leaves are numbered within their group by a range sort and cut into aligned
blocks of ``FANOUT ** LEVELS``.  A task appends the leaves of a block one after
the other: a node joins the open subtrees of its level, takes the digests of
those to its left, and hands its own to their witnesses; a full run becomes a
node of the next level.  A finished block is again one digest, appended to the
tree of block roots in the same way, until each group has one.  Witnesses of a
block's leaves then go on with that of the block.  No task holds more than one
block and no join key more rows than one block, however large a group is.

Digests are the lower-case hex of SHA-256 where they are hashed again, bytes
where they are stored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, run_folder

FANOUT = 3
LEVELS = 7  # of a block: 2,187 leaves
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
NO_GROUP = "-"  # sorts before "s", which begins the key of every named group


def digest(parts) -> bytes:
    """SHA-256 of the parts' hex texts, one after the other."""
    return sha256("".join(p.hex() for p in parts).encode()).digest()


class Appender:
    """The open subtrees of one block, each with its leaves' witnesses."""

    def __init__(self):
        self.open: list[list[tuple[bytes, list[bytearray]]]] = [[]]

    def append(self, leaf: bytes) -> bytearray:
        """Append a leaf; gives its witness, which later calls extend."""
        witness = bytearray()
        self._add(0, leaf, [witness])
        return witness

    def _add(self, level: int, node: bytes, witnesses: list[bytearray]) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        left = b"".join(d for d, _ in run)
        for w in witnesses:
            w += left
        for _, others in run:
            for w in others:
                w += node
        run.append((node, witnesses))
        if len(run) == FANOUT:
            self._close(level)

    def _close(self, level: int) -> None:
        """The run of a level, full or not, becomes a node of the next."""
        run, self.open[level] = self.open[level], []
        self._add(level + 1, digest(d for d, _ in run), [w for _, ws in run for w in ws])

    def root(self, levels: int | None = None) -> bytes:
        """Close what is open up to ``levels``, or to the single node that is left."""
        level = 0
        while level != levels:
            if levels is None and level == len(self.open) - 1 and len(self.open[level]) == 1:
                break
            if level < len(self.open) and self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0][0]


def runs(rank: int, total: int):
    """(place in its run, size of the run) of a leaf's path, level by level."""
    while total > 1:
        yield rank % FANOUT, min(FANOUT, total - rank // FANOUT * FANOUT)
        rank, total = rank // FANOUT, -(-total // FANOUT)


def fold(leaf: bytes, witness: bytes, *places: tuple[int, int]) -> bytes:
    """The root that ``leaf`` and its witness lead to; ``places`` holds (rank,
    number of leaves) in its own tree and in the tree of groups."""
    at = 0
    for rank, total in places:
        for place, size in runs(rank, total):
            stop = at + 32 * (size - 1)
            beside = [witness[i:i + 32] for i in range(at, stop, 32)]
            leaf, at = digest([*beside[:place], leaf, *beside[place:]]), stop
    return leaf


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the values, each ``-`` if NULL, else its UTF-8 byte count,
    ``:`` and its text."""
    parts = []
    for c in columns.values():
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def ranked(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``rows`` (with ``tree``) with ``rank`` and ``total`` in their tree by
    ``order``, NULL first.  A range sort numbers each partition; the counts of
    (tree, partition) before it shift the numbers."""
    # Written: the numbers hold only for this one dealing of the rows.
    dealt = materialise(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
        .withColumn("_n", F.monotonically_increasing_id()), f"{folder}/sorted")
    part = F.shiftright("_n", 33).alias("_part")
    counts = dealt.groupBy("tree", part).agg(F.min("_n").alias("_first"),
                                             F.count(F.lit(1)).alias("_size"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("tree", "_part",
                           (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first"))
                           .alias("_shift"), F.sum("_size").over(tree).alias("total"))
    return (dealt.withColumn("_part", part).join(shifts, ["tree", "_part"])
            .withColumn("rank", F.col("_n") + F.col("_shift")).drop("_part", "_n", "_shift"))


def append_blocks(nodes: DataFrame, folder: str) -> DataFrame:
    """``nodes`` (tree, rank, total, node, ...) with ``witness`` inside their
    block, ``block`` and ``block_root``; written below ``folder``."""
    size = FANOUT ** LEVELS
    kept = nodes.schema.fieldNames()
    where = {c: i for i, c in enumerate(kept)}

    def appended(batches):
        now, held, tree = None, [], None

        def done():
            root = tree.root(LEVELS if held[0][0][where["total"]] > size else None)
            columns = [pa.array(c, t) for c, t in zip(zip(*(row for row, _ in held)), types)]
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([bytes(w) for _, w in held], pa.binary()),
                 pa.array([now[1]] * n, pa.int64()), pa.array([root] * n, pa.binary())],
                names=[*kept, "witness", "block", "block_root"])

        for batch in batches:
            types = [f.type for f in batch.schema]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key = row[where["tree"]], row[where["rank"]] // size
                if key != now:
                    if held:
                        yield done()
                    now, held, tree = key, [], Appender()
                held.append((row, tree.append(row[where["node"]])))
        if held:
            yield done()

    # A block's rows are together in one partition and in order.
    dealt = nodes.repartition("tree", F.floor(F.col("rank") / size)).sortWithinPartitions(
        "tree", "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return materialise(dealt.mapInArrow(
        appended, f"{schema}, witness binary, block long, block_root binary"), folder)


def witnesses(nodes: DataFrame, folder: str) -> DataFrame:
    """``nodes`` (tree, rank, total, node, ...) with the whole ``witness`` in
    their tree and its ``top``; one row per tree has rank 0.

    Block roots are the next table's nodes until every tree is one block; then
    the witnesses are joined from the top down, on (tree, block)."""
    size = FANOUT ** LEVELS
    levels = [append_blocks(nodes, f"{folder}/0")]
    while levels[-1].filter(F.col("total") > size).limit(1).count():
        heads = levels[-1].filter(F.col("rank") % size == 0)
        up = heads.select("tree", F.col("block").alias("rank"),
                          F.ceil(F.col("total") / size).cast("long").alias("total"),
                          F.col("block_root").alias("node"))
        levels.append(append_blocks(up, f"{folder}/{len(levels)}"))
    whole = levels[-1].withColumn("top", F.col("block_root"))
    for below in reversed(levels[:-1]):
        above = whole.select("tree", F.col("rank").alias("block"), F.col("witness").alias("_more"),
                             "top")
        whole = (below.join(above, ["tree", "block"])
                 .withColumn("witness", F.concat("witness", "_more")).drop("_more"))
    return whole.drop("block", "block_root")


def manifest(docs: DataFrame, folder: str, id_column: str = "doc_id",
             group_column: str = "source", columns: list[str] = COLUMNS,
             presented: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``leaf``, ``subroot``, ``root``,
    ``witness`` (binary), the places ``rank``, ``total``, ``group_rank``,
    ``groups``, and ``presented`` (binary).

    Leaves hash ``columns``; ``presented`` replaces some of them by what a reader
    was given, and its digest is given too (``leaf`` without).  Leaves are in
    order of the id, those without one first, and of their digests where ids are
    equal; repeated rows are equal leaves, each with its own witness.  Rows with no
    group are a group, before all others.  No rows give no rows.
    """
    named = {c: F.col(c) for c in columns}
    given = leaf_digest(named | presented) if presented else F.lit(None).cast("binary")
    leaves = materialise(docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group_column).cast("string")),
                   F.lit(NO_GROUP)).alias("tree"),
        F.col(id_column).alias("id"), leaf_digest(named).alias("node"), given.alias("presented")),
        f"{folder}/leaves")
    whole = materialise(witnesses(ranked(leaves, ["id", "node"], f"{folder}/rows"),
                                  f"{folder}/trees"), f"{folder}/whole")
    # The groups' roots, one row each, are leaves in turn.
    tops = whole.filter("rank = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                           F.col("top").alias("node"))
    groups = witnesses(ranked(tops, ["name"], f"{folder}/groups"), f"{folder}/forest")
    # A group may hold a third of all rows: its row goes to the blocks first.
    size = FANOUT ** LEVELS
    block = F.floor(F.col("rank") / size).alias("block")
    heads = whole.filter(F.col("rank") % size == 0).select("tree", block)
    above = heads.join(groups.select(
        F.col("name").alias("tree"), F.col("rank").alias("group_rank"),
        F.col("total").alias("groups"), F.col("witness").alias("_more"), F.col("top").alias("root")),
        "tree")
    return (whole.withColumn("block", block).join(above, ["tree", "block"]).select(
        "id", F.col("node").alias("leaf"), F.coalesce("presented", "node").alias("presented"),
        F.col("top").alias("subroot"), "root", F.concat("witness", "_more").alias("witness"),
        "rank", "total", "group_rank", "groups"))


def verified(rows: DataFrame) -> DataFrame:
    """Rows of a manifest with ``folded``: the root that what was presented and
    the witness lead to, and ``proof``: the digest of the witness's hex text."""
    def folded(batches):
        for batch in batches:
            given, kept, rank, total, group, groups = (
                batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("presented", "witness", "rank", "total", "group_rank", "groups"))
            roots = [fold(*x) for x in zip(given, kept, zip(rank, total), zip(group, groups))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(roots, pa.binary()),
                 pa.array([sha256(w.hex().encode()).digest() for w in kept], pa.binary())],
                names=[*batch.schema.names, "folded", "proof"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(folded, f"{schema}, folded binary, proof binary")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a changed one folds to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = verified(manifest(docs, run_folder(spark, "merkle"), presented={"text": changed}))
    text = lambda c: F.lower(F.hex(c))
    return rows.select(
        F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"),
        text("root").alias("root"), text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
