"""Quality by a factorisation machine over words, structure and metadata.

A text's features are its hashed words (damped counts, unit length), some shares
that describe its structure (capitals, signs, repeated words and lines, ...) and
numbers from other columns, the latter two as one feature for each range that a
value can fall in.  Every feature i has a weight and a short vector v_i; a text
scores the weights' sum and the products of all pairs of its features' vectors.
By the sum-of-squares identity the pairs cost no more than the features:

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

The machine is fitted on a bounded sample of labelled texts by AdaGrad steps on
the log loss; all texts are then scored whole, in batches of Arrow rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.shingles import mix, text_words

WORDS = 1 << 15  # buckets of hashed words
RANK = 8
METADATA = ["n_chars"]
# Ranges of a share (the last one is "all"), and of the base-2 log of a number.
SHARES = np.array([1e-9, 0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.4, 0.6, 0.8, 0.95])
LOGS = np.arange(1.0, 24.0)
BINS = len(LOGS) + 2  # one more for "not known"
KINDS = ["upper", "lower", "digit", "space", "newline", "sign", "bar", "bang", "mark", "high"]
STRUCTURE = [*KINDS, "again", "distinct", "line_again", "word_length", "words", "lines"]
_KIND = np.zeros(256, np.intp)
for _i, _k in enumerate(KINDS):
    for _c in range(256):
        if _c >= 0x80:
            held = _k == "high"
        else:
            ch = chr(_c)
            held = {"upper": ch.isupper(), "lower": ch.islower(), "digit": ch.isdigit(),
                    "space": ch in " \t\r\v\f", "newline": ch == "\n", "bar": ch in "|<>{}[]\\/",
                    "bang": ch in "!?", "mark": ch in ".,;:'\"()-_",
                    "sign": not ch.isalnum() and not ch.isspace()
                    and ch not in "|<>{}[]\\/!?.,;:'\"()-_", "high": False}[_k]
        if held:
            _KIND[_c] = _i
PIECE = 1 << 22
SIZE = WORDS + (len(STRUCTURE) + 8) * BINS  # room for eight metadata columns


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray  # (SIZE,)
    factors: np.ndarray  # (SIZE, RANK)


def _structure(data: bytes, words: np.ndarray) -> list[tuple[float, bool]]:
    """(value, whether it is a share) in the order of ``STRUCTURE``."""
    view, counts = np.frombuffer(data, np.uint8), np.zeros(len(KINDS), np.int64)
    for at in range(0, len(view), PIECE):
        counts += np.bincount(_KIND[view[at:at + PIECE]], minlength=len(KINDS))
    size, n = max(len(view), 1), len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    shares = [c / size for c in counts]
    shares.append(float(np.mean(words[1:] == words[:-1])) if n > 1 else 0.0)
    shares.append(len(np.unique(words)) / n if n else 0.0)
    shares.append(1 - len(set(lines)) / len(lines) if lines else 0.0)
    numbers = [len(view) / n if n else 0.0, n, len(lines)]
    return [(s, True) for s in shares] + [(float(x), False) for x in numbers]


def features(data: bytes, metadata: list[float | None]) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of one whole text and its row's other numbers."""
    words = text_words(data)
    bucket, count = np.unique(mix(words) % np.uint64(WORDS), return_counts=True)
    value = np.log1p(count)
    value = value / max(np.sqrt((value * value).sum()), 1e-9)
    places = []
    found = _structure(data, words) + [
        (x, False) for x in metadata]
    for field, (x, share) in enumerate(found):
        if x is None or not np.isfinite(x):
            at = BINS - 1
        else:
            at = int(np.searchsorted(SHARES, x, "right") if share
                     else np.searchsorted(LOGS, np.log2(max(x, 0) + 1), "right"))
        places.append(WORDS + field * BINS + at)
    return (np.concatenate([bucket.astype(np.int64), np.array(places, np.int64)]),
            np.concatenate([value, np.full(len(places), 0.5)]))


def margins(parts: list[tuple[np.ndarray, np.ndarray]], machine: Machine) -> np.ndarray:
    """The machine's sums for some texts' features, in linear time."""
    first = np.cumsum([0] + [len(i) for i, _ in parts[:-1]])
    index = np.concatenate([i for i, _ in parts])
    value = np.concatenate([v for _, v in parts])
    linear = np.add.reduceat(machine.weights[index] * value, first)
    mapped = machine.factors[index] * value[:, None]
    total = np.add.reduceat(mapped, first, axis=0)
    square = np.add.reduceat(mapped * mapped, first, axis=0)
    return machine.bias + linear + 0.5 * (total * total - square).sum(axis=1)


def train(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12,
          batch: int = 32, rate: float = 0.1, decay: float = 1e-4, seed: int = 5) -> Machine:
    """AdaGrad on the log loss.  ``labels`` holds 0 and 1."""
    rnd = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    bias, bias_sum = float(np.log(share / (1 - share))), 1.0
    w, w_sum = np.zeros(SIZE), np.full(SIZE, 1e-2)
    v, v_sum = rnd.normal(0, 0.05, (SIZE, RANK)), np.full((SIZE, RANK), 1e-2)
    for _ in range(epochs):
        order = rnd.permutation(len(parts))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            now = [parts[r] for r in rows]
            sizes = np.array([len(i) for i, _ in now])
            first = np.cumsum(sizes) - sizes
            index = np.concatenate([i for i, _ in now])
            value = np.concatenate([x for _, x in now])
            mapped = v[index] * value[:, None]
            total = np.add.reduceat(mapped, first, axis=0)
            square = np.add.reduceat(mapped * mapped, first, axis=0)
            margin = (bias + np.add.reduceat(w[index] * value, first)
                      + 0.5 * (total * total - square).sum(axis=1))
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)
            bias_sum += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(bias_sum)
            each = np.repeat(slope, sizes)
            # Equal features of a batch add up before a step is taken.
            touched, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, each * value, len(touched)) + decay * w[touched]
            inner = each[:, None] * value[:, None] * (np.repeat(total, sizes, axis=0) - mapped)
            turn = np.stack([np.bincount(place, inner[:, f], len(touched)) for f in range(RANK)],
                            axis=1) + decay * v[touched]
            w_sum[touched] += step * step
            w[touched] -= rate * step / np.sqrt(w_sum[touched])
            v_sum[touched] += turn * turn
            v[touched] -= rate * turn / np.sqrt(v_sum[touched])
    return Machine(bias, w, v)


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(3)) == 1


def _inputs(text_column: str, metadata: list[str]) -> list[Column]:
    return [F.coalesce(F.col(text_column), F.lit("")).cast("binary"),
            F.array(*[F.col(c).cast("double") for c in metadata]).cast("array<double>")]


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", metadata: list[str] = METADATA, sample_rows: int = 4000,
        sample_chars: int = 20_000_000) -> Machine:
    """Learn from labelled rows that are not held out.

    The sample is bounded: at most ``sample_rows`` labelled rows, those with the
    least hashes, and of them only as many as hold ``sample_chars`` characters.
    Repeated labels of an id count once, the larger; rows with one id are rows of
    the sample each.  Where there is but one label every score is that label,
    without any it is 0.5.  ``labels``, ids and all columns but the text and
    ``metadata`` are no input of a score.
    """
    marks = (labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).cast("long").alias("id"))
             .agg(F.max(F.col(label_column).cast("int")).alias("label"))
             .filter(~held_out(F.col("id"))))
    text, numbers = _inputs(text_column, metadata)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"),
                       numbers.alias("numbers"))
    # The least hashes by id first, so that texts are carried for few rows only.
    sizes = (rows.select("id", F.octet_length("text").alias("n")).join(marks, "id")
             .orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect())
    taken, total = {}, 0
    for row in sizes:
        if total + row.n <= sample_chars:
            taken[row.id], total = row.label, total + row.n
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame(list(taken.items()), "id long, label int"))
    sample = rows.join(chosen, "id")  # sample_rows ids at most

    def listed(batches):
        for batch in batches:
            found = [features(t, m) for t, m in zip(batch.column(0).to_pylist(),
                                                    batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([i for i, _ in found], pa.list_(pa.int64())),
                 pa.array([v for _, v in found], pa.list_(pa.float64())), batch.column(3)],
                names=["id", "indices", "numbers", "label"])

    seen = sample.select("text", "numbers", "id", "label").mapInArrow(
        listed, "id long, indices array<long>, numbers array<double>, label int").collect()
    seen.sort(key=lambda r: (r.id, r.indices, r.numbers))
    label = np.array([float(r.label > 0) for r in seen])
    if not len(label) or label.min() == label.max():
        bias = 0.0 if not len(label) else (60.0 if label[0] else -60.0)
        return Machine(bias, np.zeros(SIZE), np.zeros((SIZE, RANK)))
    return train([(np.array(r.indices), np.array(r.numbers)) for r in seen], label)


def score(docs: DataFrame, machine: Machine, text_column: str = "text",
          metadata: list[str] = METADATA, output: str = "score") -> DataFrame:
    """``docs`` with ``output``, 0 to 1, of every row's whole text.  NULL texts
    count as empty, NULL metadata as not known; a column named ``output`` is
    replaced."""
    @F.pandas_udf("double")
    def rate(texts, numbers):
        import pandas as pd

        out, part, held = [], [], 0
        for data, row in zip(texts, numbers):
            part.append(features(data, list(row)))
            held += len(part[-1][0])
            if held > 1 << 18:  # some texts at a time
                out.append(margins(part, machine))
                part, held = [], 0
        if part:
            out.append(margins(part, machine))
        found = np.concatenate(out) if out else np.zeros(0)
        return pd.Series(1 / (1 + np.exp(-np.clip(found, -30, 30))))

    return docs.withColumn(output, rate(*_inputs(text_column, metadata)))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    machine = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, machine).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
