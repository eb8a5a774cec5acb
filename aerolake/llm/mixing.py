"""Mixing to target weights with soft domain membership.

A classifier learnt from a labelled table gives each document a posterior over
the domains.  Document rates r then minimise the distance between the expected
token totals of the domains, the sum of tokens * rate * posterior, and their
targets, by projected gradient steps from r = 1 (with momentum), rates kept at
``least`` (0: nonnegative) or more.  The distance is weighted by the inverse of the
domains' Gram matrix, for which a step of 1 is safe.

A step needs the residuals alone, one number for each domain.  So no rates are
stored: every pass follows the residuals so far from r = 1 again, over a table
of token counts and posteriors, and adds up one row of totals for each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, run_folder

SPACES = r"[\x20\x09-\x0D]+"
# The production weights of the two domains of labels.quality.
WEIGHTS = {0: 0.2, 1: 0.8}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != "")


def add_posteriors(docs: DataFrame, labels: DataFrame, domains: list[int],
                   id_column: str = "doc_id", text_column: str = "text",
                   label_column: str = "quality", output: str = "_posterior",
                   sample_rows: int = 8000, features: int = 1 << 14) -> DataFrame:
    """``docs`` with ``output``: the probability of each of ``domains``.

    Fitted on at most ``sample_rows`` labelled rows, those with the least
    hashes.  Without labels of two domains every posterior is even, or certain
    if there is one.  NULL texts are texts without words.
    """
    marks = (labels.filter(F.col(label_column).isin(domains) & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).alias("_id")).agg(
                 F.min(label_column).cast("int").alias("_domain"))
             .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    rows = (docs.select(F.col(id_column).alias("_id"), _words(F.col(text_column)).alias("_words"))
            .join(F.broadcast(marks), "_id")  # sample_rows at most
            .select("_words", *[(F.col("_domain") == d).cast("int").alias(f"_{i}")
                                for i, d in enumerate(domains)])
            .withColumn("_label", sum((F.col(f"_{i}") * i for i in range(len(domains))),
                                      F.lit(0)).cast("double")).select("_words", "_label"))
    seen = [int(r._label) for r in rows.select("_label").distinct().collect()]
    if len(seen) < 2:
        share = [1.0 / len(domains)] * len(domains) if not seen else [
            float(i == seen[0]) for i in range(len(domains))]
        return docs.withColumn(output, F.array(*map(F.lit, share)))
    model = Pipeline(stages=[
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features, binary=True),
        IDF(inputCol="_counts", outputCol="_weighed", minDocFreq=2),
        Normalizer(inputCol="_weighed", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", probabilityCol="_chance",
                           rawPredictionCol="_raw", predictionCol="_best", maxIter=40,
                           regParam=1e-3, family="multinomial")]).fit(rows)
    # Read back from its files the model comes without its training summary, which
    # holds the session and, once that has observed a write, cannot be sent to tasks.
    saved = f"{run_folder(docs.sparkSession, 'posteriors')}/model"
    model.write().overwrite().save(saved)
    model = PipelineModel.load(saved)
    held = docs.withColumn("_words", _words(F.col(text_column)))
    chance = vector_to_array("_chance")
    # The model knows labels up to the largest one seen.
    full = F.concat(chance, F.array_repeat(F.lit(0.0), len(domains) - 1 - max(seen)))
    return model.transform(held).select(*docs.columns, full.alias(output))


def _rates(p: np.ndarray, steps: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates after ``steps``, and the point ahead of them from which the
    next step is taken (Nesterov's momentum)."""
    rate = ahead = np.ones(len(p))
    for n, step in enumerate(steps):
        before, rate = rate, np.maximum(least, ahead - p @ step)
        ahead = rate + n / (n + 3) * (rate - before)
    return rate, ahead


def _totals(members: DataFrame, steps: list[np.ndarray], least: float, k: int) -> np.ndarray:
    """Sums over all documents of tokens * posterior * rate (two rows: at the
    rates, and at the point ahead), then of tokens * posterior * posterior."""
    def add(batches):
        total = np.zeros((2 + k, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy(zero_copy_only=False)
            p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            for row, rate in enumerate(_rates(p, steps, least)):
                total[row] += (t * rate) @ p
            total[2:] += (p.T * t) @ p
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "v"])

    rows = members.select("tokens", "p").mapInArrow(add, "at int, v double").groupBy("at").agg(
        F.sum("v").alias("v")).collect()
    out = np.zeros((2 + k) * k)
    for r in rows:
        out[r["at"]] = r["v"]
    return out.reshape(2 + k, k)


def fit_steps(members: DataFrame, weights: list[float], least: float = 0.0,
              total: float | None = None, rounds: int = 200, tolerance: float = 1e-6):
    """(steps, targets, totals reached) of the projected gradient descent over
    ``members`` (tokens, p).  ``total`` is the sum of the targets; by default
    that of all tokens, or, with ``least`` at 1 or more, the smallest for which
    no domain would have to shrink below ``least``."""
    k = len(weights)
    share = np.array(weights, float) / sum(weights)
    now, ahead, *gram = _totals(members, [], least, k)
    whole = now.sum() if total is None else total
    if total is None and least >= 1:
        whole = max((least * now[share > 0] / share[share > 0]).max(), least * now.sum())
    targets, steps = share * whole, []
    metric = np.linalg.pinv(np.array(gram), rcond=1e-9, hermitian=True)
    for _ in range(rounds):
        if not whole or np.abs(now - targets).max() <= tolerance * whole:
            break
        steps.append(metric @ (ahead - targets))
        before = now
        now, ahead, *_ = _totals(members, steps, least, k)
        if np.abs(now - before).max() <= 1e-3 * tolerance * whole:
            break
    return steps, targets, now


def document_rates(docs: DataFrame, labels: DataFrame, folder: str,
                   weights: dict[int, float] | None = None, least: float = 0.0,
                   id_column: str = "doc_id", text_column: str = "text",
                   label_column: str = "quality", output: str = "_rate",
                   total: float | None = None) -> DataFrame:
    """``docs`` with tokens, posterior and ``output``: the rate at which to take
    each row.  Rows without words have no tokens; their rate follows from the
    posterior of an empty text.  Repeated rows get equal rates, NULL ids are
    rows like others, extra columns stay (``_tokens``, ``_posterior`` and
    ``output`` are replaced), an empty table stays empty.
    """
    weights = WEIGHTS if weights is None else weights
    domains = sorted(weights)
    rated = materialise(
        add_posteriors(docs, labels, domains, id_column, text_column, label_column)
        .withColumn("_tokens", F.size(_words(F.col(text_column))).cast("double")),
        f"{folder}/posteriors")
    members = rated.select(F.col("_tokens").alias("tokens"), F.col("_posterior").alias("p"))
    steps, _, _ = fit_steps(members, [weights[d] for d in domains], least, total)

    @F.arrow_udf("double")
    def rate(posterior: pa.Array) -> pa.Array:
        p = np.array(posterior.to_pylist(), float).reshape(-1, len(domains))
        return pa.array(_rates(p, steps, least)[0])

    return rated.withColumn(output, rate("_posterior"))


def mix(docs: DataFrame, labels: DataFrame, folder: str,
        weights: dict[int, float] | None = None, least: float = 1.0,
        id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every row taken as often as its rate says: the whole part,
    and once more if a hash of its id and text falls below the rest.  With
    ``least`` at 1 every row stays."""
    rated = document_rates(docs, labels, folder, weights, least, id_column, text_column)
    chance = F.pmod(F.xxhash64(id_column, text_column, F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    times = F.floor("_rate") + (chance < F.col("_rate") - F.floor("_rate")).cast("long")
    return (rated.withColumn("_times", times.cast("int"))
            .withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
            .select(*docs.columns))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of every document for the production weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return document_rates(docs, labels, run_folder(spark, "mixing")).select(
        "doc_id", F.col("_tokens").cast("long").alias("n_tokens"),
        F.col("_posterior")[0].alias("poor"), F.col("_posterior")[1].alias("good"),
        F.col("_rate").alias("rate"))
