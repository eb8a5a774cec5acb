"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one group (label and length) are scaled to unit length, so that a
cosine of ``least`` or more is a distance of at most epsilon.  Their
coordinates on the leading principal dimensions give a grid cell of that
width, and the vectors are sorted by cell (the epsilon grid order) and cut
into blocks, each one file.  Two blocks whose boxes, over all principal
dimensions, lie further apart than epsilon are skipped; others are joined in
halves, recursively, skipping halves in the same way, and the rest is decided
by the cosine in double precision.

Equal vectors are one class and are joined once.  A join gives, for every
class, the number of vectors linked, and a spanning forest of the links
found, never the links themselves, so a group of n near copies costs O(n)
rows for each pair of its blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.components import components
from aerolake.llm.store import materialise, open_new, open_old, run_folder

BLOCK = 4096
LEAF = 512
SLACK = 1e-6  # far above rounding, for tests that only skip


def usable(vector) -> str:
    """SQL: a vector that can have links."""
    return (f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null"
            f" and not isnan(x) and abs(x) < double('infinity')) and exists({vector}, x -> x <> 0)")


def matrix(column) -> np.ndarray:
    """The vectors of an Arrow list column whose entries have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest entry first, so that neither
    very large nor very small ones leave the range of doubles."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal dimensions (rows, leading ones first) for each vector length.

    Every task adds up one matrix of products for each length.  Lengths are a
    property of the embedding model: there are few, whatever the row count.
    """
    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            for n in np.unique(lengths):
                rows = unit(matrix(column.filter(pa.array(lengths == n))))
                sums[int(n)] = sums.get(int(n), 0) + rows.T @ rows
        yield pa.RecordBatch.from_pylist(
            [{"n": n, "products": s.ravel().tolist()} for n, s in sums.items()],
            pa.schema([("n", pa.int32()), ("products", pa.list_(pa.float64()))]))

    parts = classes.select("vector").mapInArrow(partial, "n int, products array<double>")
    total = parts.select("n", F.posexplode("products").alias("at", "v")).groupBy("n", "at").agg(
        F.sum("v").alias("v"))
    axes = {}
    for row in total.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("at", "v")))
                                      .alias("v")).collect():
        square = np.array([x.v for x in row.v]).reshape(row.n, row.n)
        axes[row.n] = np.linalg.eigh(square)[1].T[::-1].copy()
    return axes


def apart(low_a, high_a, low_b, high_b) -> float:
    """Squared distance of two boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap)


class Forest:
    """Disjoint sets of places."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        at = self.up[at]
        while True:
            above = self.up[at]
            if (above == at).all():
                return at
            at = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of a[i] and b[i], in rounds of one minimum each."""
        while len(a):
            x, y = self.roots(a), self.roots(b)
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))


def join_blocks(a: dict, b: dict, least: float, same: bool) -> tuple[np.ndarray, np.ndarray, list]:
    """Linked weight for each row of both blocks, and edges of a spanning forest."""
    reach = 2 - 2 * least + SLACK
    n_a, n_b = len(a["id"]), len(b["id"])
    count_a, count_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    forest = Forest(n_a + n_b)

    def recurse(a0, a1, b0, b1):
        pa_, pb = a["proj"][a0:a1], b["proj"][b0:b1]
        if apart(pa_.min(0), pa_.max(0), pb.min(0), pb.max(0)) > reach:
            return
        if a1 - a0 > LEAF or b1 - b0 > LEAF:
            if a1 - a0 >= b1 - b0:
                mid = (a0 + a1) // 2
                recurse(a0, mid, b0, b1)
                recurse(mid, a1, b0, b1)
            else:
                mid = (b0 + b1) // 2
                recurse(a0, a1, b0, mid)
                recurse(a0, a1, mid, b1)
            return
        if same and b1 <= a0:
            return  # the mirrored half is done the other way round
        cosine = a["unit"][a0:a1] @ b["unit"][b0:b1].T
        linked = cosine >= least
        if same:
            linked &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
        i, j = np.nonzero(linked)
        if not len(i):
            return
        i, j = i + a0, j + b0
        np.add.at(count_a, i, b["weight"][j])
        np.add.at(count_b, j, a["weight"][i])
        forest.link(i, j if same else j + n_a)

    recurse(0, n_a, 0, n_b)
    if same:
        count_a, count_b = count_a + count_b, np.zeros(n_b, np.int64)
    every = np.arange(n_a + n_b)
    root = forest.roots(every)
    ids = np.concatenate([a["id"], b["id"]])
    moved = np.flatnonzero(root != every)
    return count_a, count_b, list(zip(ids[moved].tolist(), ids[root[moved]].tolist()))


def load_block(uri: str, axes: np.ndarray) -> dict:
    with open_old(uri) as source:
        table = pa.ipc.open_file(source).read_all()
    rows = unit(matrix(table.column("vector")))
    return {"id": table.column("id").to_numpy(), "weight": table.column("weight").to_numpy(),
            "unit": rows, "proj": rows @ axes.T}


def write_blocks(classes: DataFrame, axes: dict[int, np.ndarray], folder: str, least: float,
                 leading: int, block: int) -> DataFrame:
    """Sort by group and cell, cut into blocks, write each as a file; gives
    (path, label, length, low, high): one row for each block."""
    width = math.sqrt(2 - 2 * least)

    def cells(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("vector"))
            lengths = np.diff(column.offsets.to_numpy())
            cell = [None] * len(column)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                proj = unit(matrix(column.take(pa.array(at)))) @ axes[int(n)][:leading].T
                for k, row in zip(at, np.floor(proj / width).astype(int).tolist()):
                    cell[k] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths, pa.int32()),
                 pa.array(cell, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "length", "cell"])

    def cut(batches):
        held, group = [], None

        def flush():
            rows = np.array([r[1] for r in held], np.float64)
            table = pa.table({"id": pa.array([r[0] for r in held], pa.int64()),
                              "weight": pa.array([r[2] for r in held], pa.int64()),
                              "vector": pa.array(list(rows), pa.list_(pa.float64()))})
            proj = unit(rows) @ axes[group[1]].T
            uri, out = open_new(f"{folder}/blocks", "block", ".arrow")
            with out, pa.ipc.new_file(out, table.schema) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_pylist([{
                "path": uri, "label": group[0], "length": group[1],
                "low": proj.min(0).tolist(), "high": proj.max(0).tolist()}], pa.schema([
                    ("path", pa.string()), ("label", pa.int64()), ("length", pa.int32()),
                    ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]))

        for batch in batches:
            for name, vector, weight, label, length in zip(
                    *(batch.column(i).to_pylist() for i in range(5))):
                if held and ((label, length) != group or len(held) >= block):
                    yield flush()
                    held = []
                group = (label, length)
                held.append((name, vector, weight))
        if held:
            yield flush()

    celled = materialise(classes.select("id", "vector", "weight", "label").mapInArrow(
        cells, "id long, vector array<double>, weight long, label long, length int, "
               "cell array<int>"), f"{folder}/celled")
    order = ["label", "length", "cell", "id"]
    return materialise(
        celled.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("id", "vector", "weight", "label", "length")
        .mapInArrow(cut, "path string, label long, length int, low array<double>, "
                         "high array<double>"), f"{folder}/index")


def near_vectors(rows: DataFrame, folder: str, least: float = 0.93, id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label",
                 leading: int = 6, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component) of each vector.

    Two vectors are linked if their labels are equal and not NULL and their
    cosine is at least ``least``.  Vectors that are NULL, empty, zero or hold
    NULL or non-finite entries are linked with nothing, as are vectors of other
    lengths.  Repeated rows count once; rows that share an id but not a vector
    are vectors of one document: one row, their links added up.  Rows without
    an id count as one vector each and have no component.  Other columns are
    ignored; an empty table gives no rows.
    """
    named = rows.select(F.col(id_column).cast("long").alias("id"),
                        F.col(label_column).cast("long").alias("label"),
                        F.col(vector_column).cast("array<double>").alias("vector"))
    # -0.0 and 0.0 are one value.
    good = (named.filter("id is not null and label is not null").filter(usable("vector"))
            .withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).distinct())
    keyed = good.withColumn("key", F.xxhash64("vector"))
    classes = materialise(
        keyed.groupBy("label", "key", "vector").agg(
            F.min("id").alias("id"), F.count("*").alias("weight"))
        .withColumn("slot", F.xxhash64("label", "vector", "id")), f"{folder}/classes")
    members = materialise(
        keyed.select("id", "label", "key", "vector").join(
            classes.select("label", "key", "vector", "slot", "weight", F.col("id").alias("stand")),
            ["label", "key", "vector"]).select("id", "slot", "stand", "weight"),
        f"{folder}/members")
    slots = classes.select(F.col("slot").alias("id"), "vector", "weight", "label")
    axes = principal_axes(slots)
    blocks = write_blocks(slots, axes, folder, least, leading, block)

    # Block pairs of one group whose boxes are near; a box is two arrays of
    # the vector's length, so this table is 1 / block of the input.
    reach = 2 - 2 * least + SLACK
    gap = F.zip_with(
        F.zip_with("low", "high_b", lambda x, y: x - y),
        F.zip_with("low_b", "high", lambda x, y: x - y),
        lambda x, y: F.greatest(F.lit(0.0), x, y))
    other = blocks.select("label", "length", F.col("path").alias("path_b"),
                          F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    near = (blocks.join(other, ["label", "length"]).filter("path <= path_b")
            .filter(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= reach)
            .select("length", "path", "path_b"))
    # A block meets a few others at a time, so a hot label is spread over tasks.
    work = near.withColumn("share", F.pmod(F.xxhash64("path_b"), F.lit(16)))
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = (work.groupBy("length", "path", "share").agg(F.collect_list("path_b").alias("others"))
            .repartition(spread, "path", "share"))

    def join(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            for task in batch.to_pylist():
                axis = axes[task["length"]]
                mine = load_block(task["path"], axis)
                total = np.zeros(len(mine["id"]), np.int64)
                for path in task["others"]:
                    same = path == task["path"]
                    theirs = mine if same else load_block(path, axis)
                    count_a, count_b, edges = join_blocks(mine, theirs, least, same)
                    total += count_a
                    hit = np.flatnonzero(count_b)
                    a = [*theirs["id"][hit].tolist(), *(e[0] for e in edges)]
                    b = [*[None] * len(hit), *(e[1] for e in edges)]
                    n = [*count_b[hit].tolist(), *[None] * len(edges)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in (a, b, n)], schema=schema)
                hit = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine["id"][hit], pa.int64()), pa.nulls(len(hit), pa.int64()),
                     pa.array(total[hit], pa.int64())], schema=schema)

    found = materialise(work.mapInArrow(join, "a long, b long, n long"), f"{folder}/found")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("slot")).agg(
        F.sum("n").alias("n"))
    stand = members.select("slot", "stand").distinct()
    edges = (found.filter("b is not null").select("a", "b").distinct()
             .join(stand.select(F.col("slot").alias("a"), F.col("stand").alias("x")), "a")
             .join(stand.select(F.col("slot").alias("b"), F.col("stand").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b"))
             .unionAll(members.filter("id <> stand").select(F.col("id").alias("a"),
                                                            F.col("stand").alias("b"))))
    comps = components(edges, f"{folder}/components")
    linked = (members.join(counts, "slot", "left")
              .groupBy("id").agg(F.sum(F.col("weight") - 1 + F.coalesce("n", F.lit(0)))
                                 .alias("n_links")))
    every = named.filter("id is not null").select("id").distinct()
    alone = named.filter("id is null").select("id", F.lit(0).cast("long").alias("n_links"),
                                              F.lit(None).cast("long").alias("component"))
    return (every.join(linked, "id", "left").join(comps, "id", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component")).unionAll(alone))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate embeddings."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return near_vectors(rows, run_folder(spark, "grid")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))
