"""Token ids in bit-plane-shuffled binary files.

A file holds a stream of token ids cut into blocks of ``block_ids`` ids.  A
block is transposed into byte planes (the four bytes of a little-endian
unsigned 32-bit id) or bit planes (its 32 bits) and each plane is compressed
by zstandard on its own, so the high planes of a small vocabulary shrink to
nothing.  The footer has the chunk index (place, ids and plane sizes of each
block) and the documents (id and length), compressed too::

    magic | planes of block 0 | planes of block 1 | ... | footer | length, magic

Documents may cross blocks.  Writer and reader hold one block and the
document at hand, whatever the size of a file.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, open_new, open_old

MAGIC = b"IDPLANE1"
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, n_bytes long"


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte or bit planes of little-endian unsigned 32-bit ids."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [p.tobytes() for p in np.ascontiguousarray(rows.T)]
    every = np.unpackbits(rows, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(every.T), axis=1)]


def join_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The ids whose planes ``split_planes`` made."""
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        every = np.unpackbits(rows, axis=1, count=n) if n else np.zeros((32, 0), np.uint8)
        rows = np.packbits(np.ascontiguousarray(every.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).reshape(-1).view("<u4")[:n]


class PlaneWriter:
    """Writes documents' ids to one file."""

    def __init__(self, out, block_ids: int, bits: bool, level: int):
        self.out, self.block, self.bits = out, block_ids, bits
        self.packer = zstandard.ZstdCompressor(level=level)
        self.held, self.n_held, self.at = [], 0, len(MAGIC)
        self.chunks, self.docs = [], []
        self.n_ids = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids) // 4))
        self.held.append(ids)
        self.n_held += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        stop = len(ids) if last else len(ids) // self.block * self.block
        for at in range(0, stop, self.block):
            part = ids[at:min(at + self.block, stop)]
            planes = [self.packer.compress(p) for p in split_planes(part, self.bits)]
            self.chunks.append((self.at, len(part), [len(p) for p in planes]))
            for p in planes:
                self.out.write(p)
                self.at += len(p)
        self.held, self.n_held = [ids[stop:].tobytes()], len(ids) - stop

    def close(self) -> int:
        """Ends the file; gives its size."""
        self._flush(True)
        known, names, sizes = (np.array(x, d) for x, d in zip(
            zip(*self.docs) if self.docs else ((), (), ()), ("<u1", "<i8", "<i8")))
        table = np.array([(at, n, *sizes_) for at, n, sizes_ in self.chunks], "<i8")
        head = struct.pack("<BQQQ", self.bits, self.block, len(self.chunks), len(self.docs))
        foot = self.packer.compress(
            head + table.tobytes() + known.tobytes() + names.tobytes() + sizes.tobytes())
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)
        self.out.close()
        return self.at + len(foot) + 16


class PlaneReader:
    """Reads a file of ``PlaneWriter``: its chunk index, blocks and documents."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token plane file")
        n, = struct.unpack("<Q", tail[:8])
        self.unpacker = zstandard.ZstdDecompressor()
        foot = self.unpacker.decompress(source.read_at(n, size - 16 - n))
        bits, self.block, n_chunks, n_docs = struct.unpack_from("<BQQQ", foot)
        self.bits, at, wide = bool(bits), 25, 2 + (32 if bits else 4)
        self.chunks = np.frombuffer(foot, "<i8", n_chunks * wide, at).reshape(-1, wide)
        at += n_chunks * wide * 8
        self.known = np.frombuffer(foot, "<u1", n_docs, at)
        self.names = np.frombuffer(foot, "<i8", n_docs, at + n_docs)
        self.sizes = np.frombuffer(foot, "<i8", n_docs, at + 9 * n_docs)

    def ids(self, chunk: int) -> np.ndarray:
        """The ids of one block, found by the chunk index alone."""
        at, n, *sizes = (int(x) for x in self.chunks[chunk])
        raw, planes = self.source.read_at(sum(sizes), at), []
        for size in sizes:
            planes.append(self.unpacker.decompress(raw[:size]))
            raw = raw[size:]
        return join_planes(planes, n, self.bits)

    def documents(self):
        """(doc_id, first id's place in the file, its ids as bytes), in order."""
        held, chunk, at = b"", 0, 0
        for known, name, size in zip(self.known.tolist(), self.names.tolist(),
                                     self.sizes.tolist()):
            parts, need = [held], 4 * size - len(held)
            while need > 0:
                parts.append(self.ids(chunk).tobytes())
                need -= len(parts[-1])
                chunk += 1
            whole = b"".join(parts)
            held = whole[4 * size:]
            yield (name if known else None), at, whole[:4 * size]
            at += size


# White space of the byte-level pattern (the Unicode White_Space property).
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# The pattern splits every text at these places, so each unit encodes alone:
# all white space but its last character, a word with one space before it,
# and a last white character other than a space.
UNITS = re.compile(f"[{WHITE}]+(?![^{WHITE}])| ?[^{WHITE}]+|[{WHITE}]")


ODD = re.compile(f"[{WHITE.translate({32: None, 10: None})}]|^\n?$")
# A unit of Latin letters, digits and ASCII signs without an apostrophe (which
# may begin a contraction): the pattern cuts it into runs of one kind.
PLAIN = re.compile("\n?[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
RUNS = re.compile("[A-Za-z\u00c0-\u024f]+|[0-9]+|[!-/:-@[-`{-~]+")
# Byte-level models write the bytes that do not print as characters from 256 on.
HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
SHOWN = {b: 256 + i for i, b in enumerate(HIDDEN)}
SPACE = chr(SHOWN[0x20])


class ByteLevelEncoder:
    """Whole texts to little-endian 32-bit ids by a byte-level ``tokenizers`` file.

    Words recur, so the library encodes a unit once and its ids are kept in
    two generations of at most ``keep`` units each: a full young one becomes
    the old one, and units found in the old one move up.  That bounds memory
    and changes no result.  A plain unit's runs go to the library's model one
    by one, any other unit goes through the whole library.  So do texts with a
    special token's string; those with unusual white space go by ``UNITS``.
    """

    def __init__(self, path: str, keep: int = 600_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        top = max(self.library.get_vocab().values()) + 1
        self.packed = [i.to_bytes(4, "little") for i in range(top)]
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.line, = self._ids(["\n"])
        self.keep, self.young, self.old, self.runs = keep, {}, {}, {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x)}I", *x) for x in (e.ids for e in found)]

    def _run(self, run: str, before: str = "") -> bytes:
        """The ids of one run that the pattern does not cut."""
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(SHOWN)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(before + run)])

    def _later(self, runs: list[str]) -> bytes:
        """The ids of runs with no space before them, which few units hold."""
        known = list(map(self.runs.get, runs))
        for at, ids in enumerate(known):
            if ids is None:
                if len(self.runs) >= self.keep // 8:
                    self.runs = {}
                known[at] = self.runs[runs[at]] = self._run(runs[at])
        return b"".join(known)

    def _unit(self, unit: str) -> bytes:
        """The ids of a unit that the young generation lacks, kept there."""
        ids = self.old.get(unit)
        if ids is None:
            if unit.isalpha() and unit.isascii():
                ids = self._run(unit, SPACE)
            elif PLAIN.fullmatch(unit):
                runs = RUNS.findall(unit)
                if unit[0] == "\n":
                    ids = self.line + self._later(runs)
                else:
                    ids = (self.young.get(runs[0]) or self.old.get(runs[0])
                           or self._run(runs[0], SPACE))
                    if len(runs) > 1:
                        ids += self._later(runs[1:])
            else:
                ids, = self._ids([unit if unit[0] == "\n" else f" {unit}"])
        if len(self.young) >= self.keep:
            self.old, self.young = self.young, {}
        self.young[unit] = ids
        return ids

    def _text(self, text: str) -> bytes:
        """A unit is a word that means itself with one space before it, or
        itself with the line end that it starts with."""
        units = ("\n" + text).replace("\n", " \n").split(" ")[1:]
        known = list(map(self.young.get, units))
        if None in known:
            for at, ids in enumerate(known):
                if ids is None:
                    unit = units[at]
                    ids = self.young.get(unit)
                    if ids is None:
                        if not unit.isalnum() and ODD.search(unit):
                            return b"".join(self._ids(UNITS.findall(text)))
                        ids = self._unit(unit)
                    known[at] = ids
        return b"".join(known)[4:]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        return [b"" if not text else self._ids([text])[0]
                if any(s in text for s in self.special) else self._text(text)
                for text in texts]


@functools.cache
def encoder(path: str) -> ByteLevelEncoder:
    """One for each Python worker, so tasks share what earlier ones learnt."""
    return ByteLevelEncoder(path)


def text_slices(batches, chars: int = 1 << 21):
    """(ids, texts) lists of Arrow batches, of about ``chars`` bytes of text:
    what is made of texts stays small beside the batch."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        ends = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1,
                             4 * texts.offset) if len(texts) else np.zeros(1, int)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + chars)))
            yield ids[at:stop].to_pylist(), texts[at:stop].to_pylist()
            at = stop


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0,
                      id_column: str = "doc_id", text_column: str = "text",
                      block_ids: int = 65_536, bits: bool = False, level: int = 3,
                      file_ids: int = 1 << 26) -> DataFrame:
    """Encode ``docs`` and write them to files in ascending ``id_column`` order.

    Gives the manifest: one row for each file, in order of (part, seq).  A
    range partition makes one file, and a further one after ``file_ids`` ids.
    NULL texts count as empty (only the end id), NULL ids come first, rows
    with equal ids follow each other by text; other columns are ignored and
    an empty table makes no file.
    """
    def write(batches):
        part, seq, now = TaskContext.get().partitionId(), 0, None
        end = b"" if end_id is None else struct.pack("<I", end_id)

        def encoded(batches):
            for names, texts in text_slices(batches):
                yield from zip(names, encoder(tokenizer).encode(texts))

        def row():
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "path": uri, "n_docs": len(now.docs),
                "n_ids": now.n_ids, "n_bytes": now.close()}], pa.schema([
                    ("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                    ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        for name, ids in encoded(batches):
            if now is None:
                uri, out = open_new(f"{folder}/ids", f"part-{part:06d}-{seq:04d}", ".idp")
                now = PlaneWriter(out, block_ids, bits, level)
            now.add(name, ids + end)
            if now.n_ids >= file_ids:
                yield row()
                seq, now = seq + 1, None
        if now is not None:
            yield row()

    text = F.col(text_column)
    ordered = (docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
               .repartitionByRange(F.col("id"), F.xxhash64("text"))
               .sortWithinPartitions("id", F.xxhash64("text"), "text"))
    return materialise(ordered.mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_token_files(manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents of the files: id, ``start`` (ids of all documents before it)
    and ``ids`` (little-endian unsigned 32-bit integers).

    The running count is over one row for each file; files are read in
    parallel, block by block.
    """
    def read(batches):
        schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for file in batch.to_pylist():
                with open_old(file["path"]) as source:
                    rows, size = [], 0
                    for name, at, ids in PlaneReader(source).documents():
                        rows.append({"id": name, "start": file["start"] + at, "ids": ids})
                        size += len(ids) + 64
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
                            .alias("start"))
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(spread).mapInArrow(
        read, f"{id_column} long, start long, ids binary")


def token_digest(rows: DataFrame) -> DataFrame:
    """Length and unsigned crc32 of each document's ids."""
    return rows.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to plane files and read back."""
    import public_tokenizers

    from aerolake.llm.store import run_folder

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_token_files(docs, run_folder(spark, "ids"),
                                 public_tokenizers.path("byte_bpe_50k.json"))
    return token_digest(read_token_files(manifest))
