"""Ranked search with the Best Position Algorithm over impact lists.

One pass over all documents writes, for each, its number of terms and the
postings of the queries' terms; N, L and df are sums over that table.  A task
then takes its documents in shards of bounded size.  Within a shard every query
term has a list of its documents by falling impact.  All lists of a query are
read downwards side by side; each document met is looked up at once in the
query's other lists (direct access), which gives its score, and its places there
count as seen too.  A list's best position is the end of its unbroken run of seen
places from the top: it lies at or below the last place read, so the sum of
weighted impacts at the best positions bounds the unseen documents more tightly
than the sum at the last-read ones.  Reading stops when that bound is strictly
below the k-th best score, so ties at the edge are never lost.

Each task gives its ``k`` best documents of each query; the best of these are the
answer.  Documents are never grouped by term, so a term that every document
holds is no hot key.  Queries go in blocks of bounded expected size against all
documents.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, run_folder

BLOCK_ITEMS = 1000  # queries of one pass, as expected; and their characters
BLOCK_CHARS = 4_000_000
SHARD_POSTINGS = 2_000_000
STEP = 32  # places of each list that are read first; doubled every round
NO_ID = np.iinfo(np.int64).max
# ASCII letters and digits and all bytes from 0x80 belong to terms, A-Z as a-z.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_FOLD).split()


class Query(NamedTuple):
    """A query's row of the item table and its terms' numbers with repeats."""
    item: int | None
    terms: dict[int, int]


class Shard:
    """Impact lists of some documents, with direct access by document."""

    def __init__(self, ids: np.ndarray, lengths: list[int], counts: np.ndarray,
                 words: np.ndarray, tfs: np.ndarray, n_docs: int, n_terms: int):
        """``counts`` holds the number of postings of each document; ``words`` and
        ``tfs`` the postings, document by document."""
        self.ids = ids
        norm = np.array([100 - 75 + 75 * n * n_docs // n_terms for n in lengths], np.int64)
        doc = np.repeat(np.arange(len(ids)), counts)
        by_doc = np.argsort(words, kind="stable")
        words, self.docs, tf = words[by_doc], doc[by_doc], tfs[by_doc].astype(np.int64)
        self.impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[self.docs])
        down = np.lexsort((-self.impacts, words))
        numbers, first = np.unique(words, return_index=True)
        self.lists = {int(w): (int(a), int(b)) for w, a, b in
                      zip(numbers, first, [*first[1:], len(words)])}
        self.order = down  # postings of each list by falling impact
        self.place = np.empty(len(down), np.int64)
        self.place[down] = np.arange(len(down))

    def best(self, query: Query, weights: np.ndarray, k: int, floor: int = 0):
        """(scores, documents) of the ``k`` best documents with a score above 0
        and not below ``floor``, best first, equal scores by id; and the depth
        that was read."""
        lists = [(*self.lists[t], int(weights[t]) * n) for t, n in query.terms.items()
                 if t in self.lists and weights[t] > 0]
        longest = max((b - a for a, b, _ in lists), default=0)
        met = np.zeros(len(self.ids), bool)
        seen = [np.zeros(b - a + 1, bool) for a, b, _ in lists]
        best = [0] * len(lists)
        scores, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, STEP
        while depth < longest:
            fresh = np.concatenate([self.docs[self.order[a + depth:min(a + depth + step, b)]]
                                    for a, b, _ in lists if a + depth < b])
            fresh = np.unique(fresh[~met[fresh]])
            met[fresh] = True
            total = np.zeros(len(fresh), np.int64)
            bound = 0
            for i, (a, b, weight) in enumerate(lists):
                at = np.minimum(np.searchsorted(self.docs[a:b], fresh), b - a - 1) + a
                hit = self.docs[at] == fresh
                at = at[hit]
                total[hit] += weight * self.impacts[at]
                seen[i][self.place[at] - a] = True
                best[i] += int(np.argmin(seen[i][best[i]:]))
                if best[i] < b - a:  # beyond the end of a list there is nothing unseen
                    bound += weight * int(self.impacts[self.order[a + best[i] - 1]])
            scores, docs = np.concatenate([scores, total]), np.concatenate([docs, fresh])
            keep = np.lexsort((self.ids[docs], -scores))[:k]
            scores, docs = scores[keep], docs[keep]
            depth, step = depth + step, step * 2
            limit = max(floor, int(scores[-1]) if len(scores) == k else 0)
            if bound < limit:
                break
        keep = (scores > 0) & (scores >= floor)
        return scores[keep], docs[keep], min(depth, longest)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str,
             text_column: str) -> DataFrame:
    """(id, n, words, tfs) of every document with a term: its number of terms
    with repeats, and the numbers and counts of those in ``vocabulary``."""
    def counted(batches):
        for batch in batches:
            kept = [[], [], [], []]
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(map(vocabulary.get, terms(text.as_py())))
                size = found.total()
                if size:
                    found.pop(None, None)
                    for column, value in zip(kept, (name, size, list(found), list(found.values()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.int64()),
                 pa.array(kept[2], pa.list_(pa.int32())), pa.array(kept[3], pa.list_(pa.int32()))],
                names=["id", "n", "words", "tfs"])

    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("binary")).mapInArrow(
        counted, "id long, n long, words array<int>, tfs array<int>")


def _task_best(queries: list[Query], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """A function over the batches of one task: its best documents of each query."""
    def search(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        held, size = [], 0

        def finish():
            column = lambda c: pa.chunked_array([b.column(c) for b in held]).combine_chunks()
            words, tfs = column(2), column(3)
            shard = Shard(column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False),
                          column(1).to_pylist(), words.value_lengths().to_numpy(),
                          words.flatten().to_numpy(), tfs.flatten().to_numpy(), n_docs, n_terms)
            for i, query in enumerate(queries):
                scores, ids = best[i]
                more, docs, _ = shard.best(query, weights, k,
                                           int(scores[-1]) if len(scores) == k else 0)
                scores = np.concatenate([scores, more])
                ids = np.concatenate([ids, shard.ids[docs]])
                keep = np.lexsort((ids, -scores))[:k]
                best[i] = scores[keep], ids[keep]

        for batch in batches:
            # Pieces of bounded size, one document at least.
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
            at = 0
            while at < len(ends):
                base = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(
                    ends, base + max(SHARD_POSTINGS - size, 0), "right")))
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1] - base)
                at = stop
                if size >= SHARD_POSTINGS or len(ends) > at:
                    finish()
                    held, size = [], 0
        if held:
            finish()
        for i, (scores, ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(ids), pa.int32()),
                     pa.array([queries[i].item] * len(ids), pa.int64()),
                     pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(scores, pa.int64())],
                    names=["query", "item_id", "doc_id", "score"])

    return search


def rank(docs: DataFrame, items: DataFrame, folder: str, k: int = 10, id_column: str = "doc_id",
         text_column: str = "text", item_id_column: str = "item_id",
         item_text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    Scores are exact over all documents; those without a score above 0 are never
    given, equal ones go by ascending id, documents without an id last.  NULL and
    empty texts hold no term: such a document counts nowhere, such an item has no
    rows.  Repeated document rows are documents of their own; items with equal id
    and text count once, other texts under one id are ranked apart.
    """
    items = items.select(F.col(item_id_column).cast("long").alias("item_id"),
                         F.col(item_text_column).alias("text")).filter(
        "text is not null").distinct()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-(size.chars or 0) // BLOCK_CHARS))
    found = None
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        vocabulary: dict[bytes, int] = {}
        queries = []
        # A block of queries: bounded, whatever the number of documents.
        for row in mine.orderBy("item_id", "text").collect():
            held = Counter(terms(row.text))
            if held:
                queries.append(Query(row.item_id, {
                    vocabulary.setdefault(t, len(vocabulary)): n for t, n in held.items()}))
        table = materialise(postings(docs, vocabulary, id_column, text_column),
                            f"{folder}/postings-{block}")
        sums = table.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        n_docs, n_terms = sums.docs, sums.terms or 1
        df = np.zeros(len(vocabulary), np.int64)
        # One row for each of the block's terms.
        for row in table.select(F.explode("words").alias("word")).groupBy("word").count().collect():
            df[row[0]] = row[1]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1)))
                            for d in df.tolist()], np.int64)
        best = table.mapInArrow(_task_best(queries, weights, n_docs, n_terms, k),
                                "query int, item_id long, doc_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
               .select("item_id", "rank", "doc_id", "score"))
        found = top if found is None else found.unionByName(top)
    return found


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                spark.read.parquet(f"{sf_dir}/benchmark.parquet"), run_folder(spark, "ranked"))
