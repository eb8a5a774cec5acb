import shutil

import corpus_pipeline
from aerolake.llm import secret_scan
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "secret_scans", "mixing", "sentencepiece"]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).cache()
        assert now.columns == docs.columns
        assert 0 < now.count()
        if name == "secret_scans":
            assert secret_scan.find_secrets(now).filter(F.size("secrets") > 0).count() == 0
            assert now.filter("n_chars <> char_length(text)").count() == 0
            before = now
    assert before.exceptAll(now).count() == 0  # mixing drops nothing


def test_run_on_rows_of_nulls_and_on_none(spark, tmp_path):
    for name, n in (("some", 1), ("none", 0)):
        d = tmp_path / name
        d.mkdir()
        shutil.copy(f"{SF}/labels.parquet", d / "labels.parquet")
        docs = spark.createDataFrame(
            [(None, None, None, None, None), (1, None, "en", None, None), (2, "", "en", "s", 0),
             (2, "", "en", "s", 0), (3, "one two three four five six", "en", "s", 27),
             (4, "one two three four five six", "en", "s", 27)] * n,
            "doc_id long, text string, lang string, source string, n_chars long")
        docs.write.parquet(f"{d}/documents.parquet")
        rows = corpus_pipeline.run(spark, str(d)).collect()
        assert {r.doc_id for r in rows} == ({None, 1, 2, 3} if n else set())
        assert all(r.exact for r in rows)
