"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the least of its inner s-mers,
by hash, is the first or the last one.  Whether it is chosen depends on its
own characters alone, so an edit moves only the anchors that it touches, and
of any ``k - s`` neighbouring k-mers at least one is chosen.  The fingerprint
is a MinHash over the set of anchors, each coordinate with the place of its
anchor's first occurrence as a part of the text, written as hexadecimal.

Two fingerprints are matched by position: of the coordinates whose anchors
agree, those count that lie in one order in both texts, the longest chain of
places that grow together.  An insertion, a cut or an edit shifts places but
keeps their order, so it costs only the anchors it touches; a passage that
was moved counts only if it is the longer part.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.planes import text_slices
from aerolake.llm.shingles import mix
from aerolake.llm.store import materialise, run_folder

K, S, COORDS = 8, 3, 64
PIECE = 1 << 18
FINGERPRINTS = ("n_chars long, edited_sha256 string, fingerprint binary, "
                "edited_fingerprint binary, near_edited double, near_next double")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _grams(values: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` values."""
    n = len(values) - width + 1
    total = np.zeros(n, np.uint64)
    for j in range(width):
        factor = mix(np.array([salt + j], np.uint64)) | np.uint64(1)
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[j:j + n] * factor
    return mix(total + np.uint64(salt))


def _piece_anchors(points: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    values = points.astype(np.uint64) + np.uint64(1)
    inner = _grams(values, s, 11)
    n, span = len(points) - k + 1, k - s + 1
    least = inner[:n].copy()
    for j in range(1, span):
        np.minimum(least, inner[j:j + n], out=least)
    chosen = np.flatnonzero((inner[:n] == least) | (inner[span - 1:span - 1 + n] == least))
    return chosen, _grams(values, k, 101)[chosen]


def anchors(points: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers, piece by piece.  A text
    shorter than ``k`` is one anchor; an empty one has none."""
    if not len(points):
        return np.zeros(0, int), np.zeros(0, np.uint64)
    if len(points) < k:
        return np.zeros(1, int), _grams(points.astype(np.uint64) + np.uint64(1), len(points), 211)
    found = []
    for at in range(0, len(points) - k + 1, PIECE):
        place, hashed = _piece_anchors(points[at:at + PIECE + k - 1], k, s)
        found.append((place + at, hashed))
    places, hashes = zip(*found)
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    if not len(places):  # can be if a text is hardly longer than k
        return np.zeros(1, int), _grams(points.astype(np.uint64) + np.uint64(1), len(points), 211)
    return places, hashes


def _inverse(odd: np.ndarray) -> np.ndarray:
    """The inverse of odd numbers modulo 2^64."""
    found = odd.copy()
    for _ in range(6):
        found *= np.uint64(2) - odd * found
    return found


SALTS = mix(np.arange(1, COORDS + 1, dtype=np.uint64)) | np.uint64(1)
BACK = _inverse(SALTS)
SKETCH = np.dtype([("hash", ">u2"), ("place", ">u2")])


def sketch(places: np.ndarray, hashes: np.ndarray, n_chars: int) -> np.ndarray:
    """Under each coordinate 16 bits of the least hash of the set, and where
    its anchor first stands, in steps of 1/65536 of the text."""
    if not len(hashes):
        return np.zeros(0, SKETCH)
    hashes, first = np.unique(hashes, return_index=True)
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[at:at + 1024, None] * SALTS).min(axis=0))
    # A product with an odd number can be undone: it names its anchor.
    place = places[first[np.searchsorted(hashes, least * BACK)]].astype(np.int64)
    out = np.zeros(COORDS, SKETCH)
    out["hash"] = mix(least) & np.uint64(0xFFFF)
    out["place"] = place * 65536 // n_chars
    return out


def fingerprint(points: np.ndarray) -> np.ndarray:
    """The sketch of a text's code points."""
    return sketch(*anchors(points), len(points))


def chain(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest chain of places (a, b) that never fall in both."""
    tails: list[int] = []
    for value in b[np.lexsort((b, a))].tolist():
        at = bisect.bisect_right(tails, value)
        tails[at:at + 1] = [value]
    return len(tails)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of coordinates that agree in anchors of one order; two empty sets
    are alike, an empty and another one are not."""
    if len(a) != len(b):
        return 0.0
    same = a["hash"] == b["hash"]
    return chain(a["place"][same], b["place"][same]) / len(a) if len(a) else 1.0


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last third of ``points`` replaced by the first as many of ``following``."""
    third = len(points) // 3
    return np.concatenate([points[:len(points) - third], following[:third]])


def _compared(points, mine, following, theirs) -> tuple:
    text = edited(points, following)
    other = fingerprint(text)
    return (len(points), hashlib.sha256(text.astype("<u4").tobytes().decode("utf-32-le")
                                        .encode()).hexdigest(),
            mine.tobytes(), other.tobytes(),
            likeness(mine, other), likeness(mine, theirs))


def fingerprints(docs: DataFrame, folder: str, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited text, and how like it is to the
    edited text's and to the next document's.

    The next document is the one after it by descending id, and the first after
    the last.  Texts are range-partitioned once; a task compares its neighbours,
    and writes its first and last text for the pairs across partitions: one such
    pair for each partition.  A single document is its own next one.  NULL texts
    count as empty; NULL ids come last, rows with equal ids follow each other by
    text; other columns are ignored.
    """
    names = [f.split()[0] for f in FINGERPRINTS.split(", ")]
    schema = pa.schema([
        ("id", pa.int64()), ("part", pa.int32()), ("first_text", pa.string()),
        ("last_text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def neighbours(batches):
        part, last, rows = TaskContext.get().partitionId(), None, []
        first = None
        for ids, texts in text_slices(batches):
            for name, text in zip(ids, texts):
                points = code_points(text or "")
                mine = fingerprint(points)
                if last is None:
                    first = text or ""
                else:
                    rows.append((last[0], part, None, None,
                                 *_compared(last[1], last[2], points, mine)))
                last = (name, points, mine)
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
        if last is not None:
            rows.append((last[0], part, first, last[1].tobytes().decode("utf-32-le"),
                         *[None] * len(names)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def across(batches):
        for batch in batches:
            rows = []
            for name, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = code_points(text), code_points(following)
                rows.append((name, *_compared(a, fingerprint(a), b, fingerprint(b))))
            own = [schema.field("id"), *(schema.field(n) for n in names)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), own)], schema=pa.schema(own)) \
                if rows else pa.RecordBatch.from_pylist([], pa.schema(own))

    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), "text"]
    rows = materialise(
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .repartitionByRange(spread, *order[:2]).sortWithinPartitions(*order)
        .mapInArrow(neighbours, "id long, part int, first_text string, last_text string, "
                    + FINGERPRINTS), f"{folder}/neighbours")
    inner = rows.filter("last_text is null").select("id", *names)
    # One row for each partition that has documents.
    edges = rows.filter("last_text is not null").select("id", "part", "first_text", "last_text")
    heads = edges.select("part", "first_text")
    follow = edges.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")),
        F.min("part").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    pairs = (edges.select("id", "part", "last_text").join(follow, "part")
             .join(heads.select(F.col("part").alias("next"), "first_text"), "next")
             .select("id", "last_text", "first_text"))
    return inner.unionByName(pairs.mapInArrow(across, "id long, " + FINGERPRINTS)).select(
        F.col("id").alias(id_column), *(
            F.lower(F.hex(n)).alias(n) if n.endswith("fingerprint") else n for n in names))


def anchor_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 k: int = K, s: int = S) -> DataFrame:
    """(id, place, anchor) of every closed syncmer, for positional matching:
    texts that share a passage have equal anchors at places of one distance."""
    def rows(batches):
        for ids, texts in text_slices(batches):
            for name, text in zip(ids, texts):
                places, hashes = anchors(code_points(text or ""), k, s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(places), pa.int64()), pa.array(places, pa.int64()),
                     pa.array(hashes.view(np.int64), pa.int64())],
                    names=[id_column, "place", "anchor"])

    return docs.select(F.col(id_column).cast("long"), text_column).mapInArrow(
        rows, f"{id_column} long, place long, anchor long")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fingerprints(docs, run_folder(spark, "syncmers"))
