"""Exact round trips of the two file formats."""

import zlib

import numpy as np
import public_tokenizers
import tokenizers
from aerolake.llm import planes, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_planes_round_trip():
    ids = np.arange(1000, dtype=np.uint32) * 4_294_967
    for bits in (False, True):
        assert (planes.join_planes(planes.split_planes(ids, bits), 1000, bits) == ids).all()


def test_token_files_equal_the_library(spark, folder, odd_docs, empty_docs):
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    for bits in (False, True):
        manifest = planes.write_token_files(docs, f"{folder}/{bits}", TOKENIZER, block_ids=100,
                                            bits=bits, file_ids=5000)
        rows = sorted(planes.read_token_files(manifest).collect(), key=lambda r: r.doc_id)
        texts, at = {r.doc_id: r.text or "" for r in docs.collect()}, 0
        assert len(rows) == len(texts)
        for r in rows:
            want = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
            raw = np.array(want, "<u4").tobytes()
            assert r.start == at and zlib.crc32(bytes(r.ids)) == zlib.crc32(raw)
            at += len(want)
    assert planes.write_token_files(empty_docs, f"{folder}/none", TOKENIZER).count() == 0
    every = planes.write_token_files(odd_docs, f"{folder}/all", TOKENIZER)
    assert planes.read_token_files(every).count() == odd_docs.count()


def test_archives_round_trip(spark, folder):
    pages = [(1, "http://a b/\n", "<p>é</p>"), (2, None, None), (3, "u", "<p>é</p>"), (4, "u", ""),
             (None, "u", "<p>é</p>"), (5, "u", "long " * 50_000), (5, "u", "long " * 50_000)]
    pages += [(10 + i, f"http://h/{i}", f"<html><body>page {i} of many pages</body></html>" * 9)
              for i in range(60)]
    docs = spark.createDataFrame([(*p, "k") for p in pages],
                                 "page_id long, url string, html string, path string")
    index = warc.write_archives(docs, folder, file_bytes=2000)
    rows = warc.read_archives(index).collect()
    assert len(rows) == len(pages)
    by_id = {r.page_id: r for r in rows}
    for page_id, _, html in pages:
        raw = (html or "").encode()
        r = by_id[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), warc.digest(raw))
        assert r.record_type == "revisit" or bytes(r.payload) == raw
    assert [(by_id[i].record_type, by_id[i].refers_to) for i in (1, 2, 3, 4)] == [
        ("response", None), ("response", None), ("revisit", 1), ("revisit", 2)]
    with warc.open_old(index.first().path) as source:
        assert int.from_bytes(source.read_at(4, 0), "little") == warc.DICTIONARY_MAGIC


def test_no_pages(spark, folder):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none, folder)).count() == 0
