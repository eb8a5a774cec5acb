"""WARC archives with records compressed one by one under a shared dictionary.

A file begins with a skippable frame (magic 0x184D2A5D) whose content is the
Zstandard dictionary; every record follows as a frame of its own compressed
with it, so one record can be read by its offset and length alone.  The
dictionary is built from a bounded sample of the records to be archived.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with
the smallest id is a ``response``; the others are ``revisit`` records, without
the payload, that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, open_new, open_old, run_folder

DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, path string, at long, size long"
# What a header line may not hold.
UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    """The page id of a record id."""
    digits = name[len("<urn:page:"):-1]
    return int(digits) if digits else None


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None,
           date: str) -> bytes:
    """One WARC record; ``first`` is the page that a revisit refers to."""
    body = HTTP + payload if first is None else HTTP
    lines = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body)))]
    if url:
        lines.insert(3, ("WARC-Target-URI", UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if first is not None:
        lines += [("WARC-Refers-To", record_id(first)), ("WARC-Profile", PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return VERSION + head + b"\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; checks lengths and the digest."""
    head, _, body = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version + b"\r\n" != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    body, end = body[:int(headers["Content-Length"])], body[int(headers["Content-Length"]):]
    payload = body.partition(b"\r\n\r\n")[2]
    if end != b"\r\n\r\n":
        raise ValueError("a record has a wrong length")
    if headers["WARC-Type"] == "response" and (
            headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}"):
        raise ValueError("a record has a wrong digest")
    return headers, payload


def train_dictionary(records: DataFrame, rows: int, row_bytes: int, size: int) -> bytes:
    """A dictionary from the heads of at most ``rows`` records, those with the
    least hashes; empty if there is too little to learn from."""
    sample = (records.select(F.xxhash64("page_id", "payload").alias("h"),
                             F.substring("payload", 1, row_bytes).alias("head"))
              .orderBy("h").limit(rows).select("head").collect())
    parts = [HTTP + bytes(r.head) for r in sample]
    if len(parts) < 8 or sum(map(len, parts)) < 4 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(
            min(size, sum(map(len, parts)) // 8), parts, k=256, d=8, level=3).as_bytes()
    except zstandard.ZstdError:  # nothing in them recurs
        return b""


def with_originals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``pages`` with ``first``: the smallest page with an equal payload, NULL
    where a record is its own original.  Payloads meet by digest and length."""
    large = pages.filter(F.length("payload") >= min_bytes)
    shared = (large.groupBy("sha1", F.length("payload").alias("bytes"))
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1 and first is not null").select("sha1", "bytes", "first"))
    return (pages.withColumn("bytes", F.length("payload"))
            .join(shared, ["sha1", "bytes"], "left")
            .withColumn("first", F.expr(
                "case when page_id = first or page_id is null then null else first end")))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, sample_rows: int = 512,
                   sample_bytes: int = 16_384, dictionary_bytes: int = 65_536, level: int = 3,
                   file_bytes: int = 1 << 28, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and give
    the index: page_id, file, offset and length of each record.

    NULL html is an empty payload, a NULL url leaves out its header line, rows
    without a page_id are responses of their own without a number, and rows
    that repeat the smallest page_id of a payload are responses too.  Other
    columns are ignored; an empty table writes no file.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    learnt = train_dictionary(rows, sample_rows, sample_bytes, dictionary_bytes)

    def write(batches):
        part, out = TaskContext.get().partitionId(), None
        words = zstandard.ZstdCompressionDict(learnt) if learnt else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=words)
        schema = pa.schema([("page_id", pa.int64()), ("path", pa.string()),
                            ("at", pa.int64()), ("size", pa.int64())])
        for batch in batches:
            index = []
            for page_id, url, payload, first in zip(*batch.columns):
                if out is None:
                    path, out = open_new(f"{folder}/warc", f"part-{part:06d}", ".warc.zst")
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(learnt)) + learnt)
                    at = 8 + len(learnt)
                frame = packer.compress(record(page_id.as_py(), url.as_py(), payload.as_py(),
                                               first.as_py(), date))
                out.write(frame)
                index.append((page_id.as_py(), path, at, len(frame)))
                at += len(frame)
                if at >= file_bytes:
                    out.close()
                    out = None
            if index:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*index), schema)], schema=schema)
        if out is not None:
            out.close()

    return materialise(
        with_originals(rows.withColumn("sha1", F.sha1("payload")), min_bytes)
        .select("page_id", "url", "payload", "first").mapInArrow(write, INDEX),
        f"{folder}/index")


def read_archives(index: DataFrame) -> DataFrame:
    """The records of the archives that ``index`` names: page_id, record_type,
    url, payload_digest, payload_bytes, refers_to and the payload itself
    (NULL for a revisit).  Files are read in parallel, frame by frame; each
    brings its dictionary along."""
    def read(batches):
        schema = pa.schema([
            ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path, frames in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                with open_old(path) as source:
                    magic, size = struct.unpack("<II", source.read_at(8, 0))
                    if magic != DICTIONARY_MAGIC:
                        raise ValueError("an archive without its dictionary frame")
                    words = source.read_at(size, 8)
                    unpacker = zstandard.ZstdDecompressor(
                        dict_data=zstandard.ZstdCompressionDict(words) if size else None)
                    rows, held = [], 0
                    for frame in frames:
                        raw = unpacker.decompress(source.read_at(frame["size"], frame["at"]))
                        head, payload = parse(raw)
                        first = head.get("WARC-Refers-To")
                        rows.append({
                            "page_id": page_of(head["WARC-Record-ID"]),
                            "record_type": head["WARC-Type"], "url": head.get("WARC-Target-URI"),
                            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "payload_bytes": int(head["WARC-Payload-Length"]),
                            "refers_to": page_of(first) if first else None,
                            "payload": None if first else payload})
                        held += len(raw)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # Neighbouring records of a file are read together, a few MB at a time.
    runs = index.groupBy("path", F.expr("at div 4194304").alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("at", "size"))).alias("frames"))
    return runs.select("path", "frames").mapInArrow(
        read, "page_id long, record_type string, url string, payload_digest string, "
              "payload_bytes long, refers_to long, payload binary")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page and read the archives back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages, run_folder(spark, "warc"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
