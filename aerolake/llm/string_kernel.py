"""Toxicity by a subsequence string kernel machine with Nyström landmarks.

The kernel compares words by their subsequences of three characters, contiguous
or with gaps anywhere in the word, each weighted by ``DECAY`` to the power of
its gaps; the decay alone limits the gaps.  Words carry marks for their begin
and end; very long words are read as overlapping windows.  A word with signs in
it is also read without them, and words of one or two characters also joined
with each other and with the words beside them, so that ``i..d..i..o..t`` and
``id i ot`` are read as the plain word too.

A sentence is as toxic as its worst word.  Words of labelled sentences are
mapped to the similarities with ``landmarks`` landmark words, whitened (the
Nyström map), and a squared-hinge linear machine is fitted on them.  Its
weights fold back into one table of subsequences, which scores any word in one
pass.  A text's score is a logistic curve over its two worst words and its
number of words, fitted on labelled texts that the machine has not seen.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.shingles import mix
from aerolake.llm.store import small_batches

DECAY = 0.6
LONGEST = 32  # of a word; longer ones are cut in windows that overlap by half
WHOLE = LONGEST + 2  # reach of the kernel that is learnt and scored: word and marks
SHORT = 2  # words up to this length are also joined with their neighbours
MEMO = 200_000  # words whose margins a task keeps; beyond, those that the next texts hold too
SLICE = 1 << 21  # characters of the texts that are scored together
EDGE = "!\"#$%&'()*+,./:;<=>?@[\\]^_`{|}~-¿¡«»"


class Model(NamedTuple):
    """Sorted subsequence hashes, their weights, the bias, and the curve."""
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    curve: np.ndarray


class Table(NamedTuple):
    """A model's weights by place: ``letters`` are the sorted code points that its
    subsequences hold, ``pairs`` numbers two of them (0: none), and ``weights`` has a
    row for each pair and a column for each letter.  Place 0 is any other letter."""
    letters: np.ndarray
    pairs: np.ndarray
    weights: np.ndarray


def _bare(core: str) -> str:
    return core if core.isalnum() else "".join(filter(str.isalnum, core))


def words(text: str) -> list[str]:
    """The distinct words of a text in lower case, as the kernel reads them."""
    cores = [c for token in text.lower().split() if (c := token.strip(EDGE))]
    found = dict.fromkeys(cores)
    for core in [c for c in found if not c.isalnum()]:
        if bare := "".join(filter(str.isalnum, core)):
            found[bare] = None
    short = [i for i, c in enumerate(cores) if len(c) <= SHORT]
    at, count = 0, len(cores)
    while at < len(short):  # runs of short words, with the words beside them
        first = last = short[at]
        at += 1
        while at < len(short) and short[at] == last + 1:
            last, at = short[at], at + 1
        run = cores[first] if first == last else "".join(cores[first:last + 1])
        before = _bare(cores[first - 1]) if first else ""
        after = _bare(cores[last + 1]) if last + 1 < count else ""
        found[run] = found[before + run] = found[run + after] = found[before + run + after] = None
    for word in [w for w in found if len(w) > LONGEST]:
        del found[word]
        for start in range(0, len(word) - LONGEST // 2, LONGEST // 2):
            found[word[start:start + LONGEST]] = None
    return list(found)


def subsequences(units: list[str], reach: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, value) of all gap-weighted subsequences within ``reach``
    characters, words of length one."""
    text = "".join(f"\x02{u}\x03" for u in units)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(u) + 2 for u in units), np.int64, len(units))
    owner = np.repeat(np.arange(len(units)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    parts = []
    for b in range(2, min(reach, max(sizes, default=3))):
        at = np.flatnonzero(np.arange(len(points)) + b < ends)
        ring = (points[at] << np.uint64(42)) | points[at + b]
        for a in range(1, b):
            key = ring | (points[at + a] << np.uint64(21))
            parts.append((owner[at], key, np.full(len(at), DECAY ** (b - 2))))
    owner, key, value = (np.concatenate(x) for x in zip(*parts))
    # Equal subsequences of a word add up before its length is taken.
    order = np.argsort(mix(key) ^ mix(owner.astype(np.uint64)), kind="stable")
    owner, key, value = owner[order], key[order], value[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    value = np.add.reduceat(value, first) if len(first) else value
    owner, key = owner[first], key[first]
    norm = np.sqrt(np.bincount(owner, value * value, len(units)))
    return owner, key, value / norm[owner]


def similarities(units: list[str], landmarks: list[str], reach: int = 5) -> np.ndarray:
    """The normalised kernel of each word with each landmark."""
    out = np.zeros((len(units), len(landmarks)))
    mark, key, value = subsequences(landmarks, reach)
    order = np.argsort(key, kind="stable")
    mark, key, value = mark[order], key[order], value[order]
    for at in range(0, len(units), 512):
        own, k, v = subsequences(units[at:at + 512], reach)
        low, high = np.searchsorted(key, k, "left"), np.searchsorted(key, k, "right")
        many = high - low
        hit = np.repeat(np.arange(len(k)), many)
        place = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many) + low[hit]
        np.add.at(out, (own[hit] + at, mark[place]), v[hit] * value[place])
    return out


def machine(x: np.ndarray, positive: np.ndarray, negative: np.ndarray,
            decay: float = 1e-4, rounds: int = 30) -> np.ndarray:
    """Weights of a squared-hinge machine; each row counts ``positive`` as one
    label and ``negative`` as the other.  Newton steps on the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    scale = positive.sum() + negative.sum()
    for _ in range(rounds):
        f = x @ w
        up, down = positive * (f < 1), negative * (f > -1)
        gradient = decay * w + x.T @ (up * (f - 1) + down * (f + 1)) / scale
        hessian = decay * np.eye(len(w)) + (x.T * ((up + down) / scale)) @ x
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def table(model: Model) -> Table:
    """The model's weights by place."""
    mask = np.uint64((1 << 21) - 1)
    parts = [(model.keys >> np.uint64(42)), (model.keys >> np.uint64(21)) & mask,
             model.keys & mask]
    # A key holds the first, the middle and the last character in this order.
    letters = np.unique(np.concatenate(parts))
    first, middle, last = (np.searchsorted(letters, p) + 1 for p in parts)
    size = len(letters) + 1
    held, row = np.unique(first * size + middle, return_inverse=True)
    pairs = np.zeros(size * size, np.int64)
    pairs[held] = np.arange(1, len(held) + 1)
    weights = np.zeros((len(held) + 1, size))
    weights[row + 1, last] = model.weights
    return Table(letters, pairs, weights)


def _norms(points: np.ndarray) -> np.ndarray:
    """The kernel of each of some words of equal length with itself.

    The usual recursion adds up, for every two places, the matches before them with
    their decay: a product with one triangular matrix from either side.  As a word
    meets itself all these matrices are symmetric."""
    count, n = points.shape
    turned = np.ascontiguousarray(points.T)
    same = (turned[:, None] == turned[None]).astype(np.float32)  # place, place, word
    steps = np.arange(n)
    before = np.where(steps[:, None] > steps, DECAY ** (steps[:, None] - steps - 1.0), 0).astype(
        np.float32)
    sums = same
    for _ in range(2):
        half = (before @ sums.reshape(n, -1)).reshape(n, n, count)
        half = np.ascontiguousarray(half.swapaxes(0, 1)).reshape(n, -1)
        sums = (before @ half).reshape(n, n, count) * same
    return sums.sum(axis=(0, 1), dtype=np.float64)


def word_margins(units: list[str], model: Model, by_place: Table | None = None) -> np.ndarray:
    """The machine's value of each word: its subsequences' weights, decayed by their
    gaps, over the word's length in the kernel; words of equal length go together."""
    out = np.full(len(units), float(model.bias))
    if not len(model.keys) or not units:
        return out
    by_place = by_place or table(model)
    letters, pairs, weights = by_place
    size = len(letters) + 1
    flat, rows_of = weights.astype(np.float32).ravel(), pairs * size
    groups: dict[int, list[int]] = {}
    for i, unit in enumerate(units):
        groups.setdefault(len(unit), []).append(i)
    for length, places in groups.items():
        n = length + 2
        rows = max(16, 200_000 // (n * n))  # arrays of a part stay in the cache
        fade = DECAY ** np.arange(n, dtype=float)
        for at in range(0, len(places), rows):
            part = places[at:at + rows]
            text = "".join(f"\x02{units[i]}\x03" for i in part)
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)
            found = np.minimum(np.searchsorted(letters, points), len(letters) - 1)
            place = np.where(letters[found] == points, found + 1, 0)
            total = np.zeros(len(part))
            for j in range(1, n - 1):
                # Pairs that end at j, decayed up to it; then on to every later place.
                row = rows_of.take(place[:, :j] * size + place[:, j:j + 1])
                near = np.ascontiguousarray(fade[j - 1::-1], np.float32)
                for k in range(j + 1, n):
                    total += (flat.take(row + place[:, k:k + 1]) @ near) * fade[k - j - 1]
            norm = np.sqrt(_norms(points))  # 0 for words that hold no subsequence
            out[part] += np.divide(total, norm, out=np.zeros(len(part)), where=norm > 0)
    return out


def text_features(texts: list[str], model: Model, memo: dict[str, float] | None = None,
                  by_place: Table | None = None) -> np.ndarray:
    """Worst and second worst word, log of the number of words, 1, per text.
    ``memo`` holds margins of words seen before, and takes those of new ones."""
    memo = {} if memo is None else memo
    out = np.tile(np.array([-2.0, -2.0, 0.0, 1.0]), (len(texts), 1))
    # Words are held once, texts hold their numbers.
    number: dict[str, int] = {}
    lists = [np.array([number.setdefault(w, len(number)) for w in words(t)], np.int32)
             for t in texts]
    if len(memo) > MEMO:  # what comes again stays
        again = {w: memo[w] for w in number if w in memo}
        memo.clear()
        memo.update(again)
    every = [w for w in number if w not in memo]
    memo.update(zip(every, word_margins(every, model, by_place).tolist()))
    margins = np.fromiter(map(memo.__getitem__, number), float, len(number))
    for i, ws in enumerate(lists):
        if len(ws):
            worst = margins[ws]
            if len(worst) > 2:
                worst.partition(len(worst) - 2)
            worst = np.sort(worst[-2:])[::-1]
            out[i, :len(worst)] = np.clip(worst, -2, 2)
            out[i, 2] = np.log1p(len(ws))
    return out


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1.0, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (p * (1 - p))) @ x + decay * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - y) + decay * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(texts: list[str], model: Model, memo: dict[str, float] | None = None,
                by_place: Table | None = None) -> np.ndarray:
    margin = text_features(texts, model, memo, by_place) @ model.curve
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", sample_rows: int = 6000, sample_chars: int = 40_000_000,
        vocabulary: int = 20_000, landmarks: int = 160) -> Model:
    """Learn from labelled rows that are not held out.

    The sample is bounded: at most ``sample_rows`` labelled texts, those with
    the least hashes, and of them only as many as hold ``sample_chars``
    characters; at most ``vocabulary`` of their words and ``landmarks``
    landmarks.  Without both labels nothing can be learnt: every score is 0.
    """
    small_batches(docs.sparkSession)
    marks = (labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).cast("long").alias("id"))
             .agg(F.max(F.col(label_column).cast("int")).alias("toxic"))
             .filter(~held_out(F.col("id"))))
    rows = docs.select(F.col(id_column).cast("long").alias("id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text")).withColumns(
        {"h": F.xxhash64("id", "text"), "n": F.length("text")})
    # The least hashes first, without their texts; then the texts of the few rows taken.
    sizes = rows.select("id", "h", "n").join(marks, "id").orderBy("h", "id").limit(
        sample_rows).collect()
    taken, total = {}, 0
    for row in sizes:
        if total + row.n <= sample_chars:
            taken[row.id, row.h] = row.toxic
            total += row.n
    spark = docs.sparkSession
    # sample_rows at most; as Arrow they need no Python workers of their own.
    chosen = F.broadcast(spark.createDataFrame(pa.table({
        "id": pa.array([i for i, _ in taken], pa.int64()),
        "h": pa.array([h for _, h in taken], pa.int64()),
        "toxic": pa.array(list(taken.values()), pa.int32())})))
    sample = rows.drop("n").join(chosen, ["id", "h"])

    def listed(batches):
        for batch in batches:
            for name, text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                ws = words(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ws, pa.string()), pa.array([toxic] * len(ws), pa.int32())],
                    names=["word", "toxic"])

    # Even ids' checksums teach the words, odd ones the curve.
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    teach = sample.filter(half == 0).select("id", "text", "toxic")
    size = {r.toxic: r.n for r in teach.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -2.0, np.array([0, 0, 0, -30.0]))
    if not size.get(0) or not size.get(1):
        return none
    counts = teach.mapInArrow(listed, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("up"), F.sum(1 - F.col("toxic")).alias("down"))
    lift = F.log((F.col("up") + 0.5) / size[1]) - F.log((F.col("down") + 0.5) / size[0])
    # Half of the vocabulary by how often texts hold a word, half by chance.
    rated = counts.withColumn("lift", lift)
    often = rated.orderBy(F.desc(F.col("up") / size[1] + F.col("down") / size[0]), "word").limit(
        vocabulary // 2)
    some = rated.orderBy(F.xxhash64("word"), "word").limit(vocabulary // 2)
    rows = {r.word: r for r in often.collect() + some.collect()}
    if len(rows) < 2:
        return none
    units = sorted(rows)
    up = np.array([rows[w].up for w in units], float) / size[1]
    down = np.array([rows[w].down for w in units], float) / size[0]
    lifts = np.array([rows[w].lift for w in units])
    # Landmarks: most telling words by how often and how clearly, and common ones.
    telling = np.argsort(-(up * np.maximum(lifts, 0)), kind="stable")[:landmarks * 3 // 4]
    common = np.argsort(-down, kind="stable")[:landmarks - len(telling)]
    chosen_words = sorted({units[i] for i in (*telling, *common)})
    gram = similarities(chosen_words, chosen_words, WHOLE)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    keep = value > 1e-6
    white = vector[:, keep] / np.sqrt(value[keep])
    x = similarities(units, chosen_words, WHOLE) @ white
    w = machine(x, up, 4 * down)
    own, key, amount = subsequences(chosen_words, WHOLE)
    alpha = white @ w[:-1]
    keys, place = np.unique(key, return_inverse=True)
    model = Model(keys, np.bincount(place, amount * alpha[own], len(keys)), float(w[-1]), none.curve)

    def featured(batches):
        memo, by_place = {}, table(model)
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                rows = text_features(texts[at:at + 256], model, memo, by_place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2]),
                     pa.array(toxic[at:at + 256], pa.int32())], names=["a", "b", "n", "toxic"])

    seen = np.array([(r.a, r.b, r.n, 1.0, r.toxic) for r in sample.filter(half == 1).select(
        "text", "toxic").mapInArrow(featured, "a double, b double, n double, toxic int")
        .collect()], float).reshape(-1, 5)
    if not len(seen) or seen[:, 4].min() == seen[:, 4].max():
        return model._replace(curve=np.array([4.0, 0, 0, 0]))
    return model._replace(curve=logistic(seen[:, :4], seen[:, 4], decay=0.05))


def score(docs: DataFrame, model: Model, text_column: str = "text",
          output: str = "score") -> DataFrame:
    """``docs`` with ``output``, 0 to 1; NULL texts count as empty.  Every row
    is scored by its whole text alone; a column named ``output`` is replaced."""
    small_batches(docs.sparkSession)
    memo = {}  # each task fills its own
    by_place = table(model)

    @F.arrow_udf("double")
    def rate(texts: pa.Array) -> pa.Array:
        out, at = [], 0
        while at < len(texts):  # only a few texts at a time are held as strings
            part, size = [], 0
            while at < len(texts) and (not part or size < SLICE):
                part.append(texts[at].as_py() or "")
                size += len(part[-1])
                at += 1
            out.append(probability(part, model, memo, by_place))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(output, rate(F.col(text_column)))


def keep_clean(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
               text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``; same columns."""
    column = "_score"
    while column in docs.columns:
        column += "_"
    model = fit(docs, labels, id_column, text_column)
    return score(docs, model, text_column, column).filter(F.col(column) < threshold).drop(column)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
