"""The training-data pipeline: toxicity, near-duplicates, secrets, mixing, pieces.

Every stage takes all that the one before kept, written as Parquet and read
again.  Texts judged toxic go; of each group of near-duplicates the document
with the smallest id stays; secrets are blanked in the texts; documents are
repeated until the expected tokens of good and poor ones have the target
ratio, none is dropped; what is left is encoded to pieces and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import minhash, mixing, pieces, secret_scan, string_kernel
from aerolake.llm.store import materialise, run_folder


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    return string_kernel.keep_clean(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id.  Rows
    without an id stay; of rows that share id and text one does."""
    groups = minhash.near_duplicates(docs, run_folder(spark, "stage-minhash"))
    kept = groups.filter("id = component").select(F.col("id").alias("doc_id"))
    return (docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
            .unionByName(docs.filter("doc_id is null")).select(*docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets blanked and ``n_chars`` counted again where any was."""
    blank = secret_scan.redact(docs.withColumn("_old", F.col("text")))
    return blank.withColumn("n_chars", F.when(
        F.col("text") != F.col("_old"), F.char_length("text").cast("long"))
        .otherwise(F.col("n_chars"))).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, some of them repeated."""
    return mixing.mix(docs, _labels(spark, sf_dir), run_folder(spark, "stage-mixing"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and checksum of pieces, and whether the text came back."""
    import public_tokenizers

    return pieces.digest(docs, run_folder(spark, "stage-pieces"),
                         public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mixing_stage),
    ("sentencepiece", piece_ids),
]

# Trained models and the lattice search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    folder = run_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for turn, (name, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"{folder}/{turn}-{name}")
    return docs
