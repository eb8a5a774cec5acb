"""SentencePiece encoding and decoding with a max-plus scan over giant texts.

A text is segmented into the pieces of a SentencePiece model with the greatest
sum of scores (unigram segmentation; at equal sums the longer last piece
wins), with byte pieces for characters that no piece holds.  Scores are added
in fixed point, so sums are exact and the same in any order.  No piece goes on
past a character before a word mark, nor holds a character outside the
alphabet, so such places cut the text into segments that can be looked up.

Texts longer than ``chunk`` are cut in chunks.  The state at a boundary is how
far the piece that crosses it reaches into the next chunk.  Each chunk gives a
matrix of the best sums from state to state.  The product of matrices in the
max-plus algebra is associative: blocks of ``BLOCK`` chunks are multiplied on
their own, a scan over the blocks gives the best sums in front of each block,
and from these those in front of each chunk.  With them every chunk tells, for
each state at its end, the state at its begin that a single pass over the whole
text would trace back to, equal sums included.  Following these from the end
gives the state at every boundary, and then each chunk is backtraced on its own
between its two states.  The ids are those of one pass, whatever the chunks.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import struct

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.planes import text_slices
from aerolake.llm.store import materialise, run_folder

MARK = "▁"
NONE = -(1 << 60)
UNKNOWN_PENALTY = 10  # fixed value: below the least score
POINT = 1 << 20  # steps of a score's unit, where scores are not all whole numbers
BLOCK = 256  # chunks whose matrices are multiplied together
KEPT = 250_000  # segments whose ids a worker keeps
ENCODED = "id long, text_sha256 string, ids binary"


class Pieces:
    """The pieces of a model, with scores in fixed point."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        scores, self.ids, self.bytes, self.shown = {}, {}, {}, shown_bytes(model)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                scores[piece], self.ids[piece] = model.get_score(i), i
        point = 1 if all(float(x).is_integer() for x in scores.values()) else POINT
        self.scores = {p: round(x * point) for p, x in scores.items()}
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY * point
        # Pieces by their characters: (what may follow, score if it is a piece).
        self.tree = self._tree(sorted(self.scores), 0)
        self.longest = max(map(len, self.scores))
        self.states = self.longest
        alphabet = {c for p in self.scores for c in p}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.scores):
            raise ValueError("a piece holds a word mark after another character")
        inner = re.escape("".join(sorted(alphabet - {MARK})))
        # A segment: word marks and what follows, or one foreign character.
        self.segment = re.compile(f"{MARK}+[{inner}]*|[{inner}]+|.", re.S)
        self.foreign = re.compile(f"[^{MARK}{inner}]", re.S)
        self.known: dict[str, bytes] = {}

    def _tree(self, sorted_pieces: list[str], depth: int) -> dict[str, tuple]:
        groups = itertools.groupby(sorted_pieces, key=lambda p: p[depth])
        out = {}
        for char, group in groups:
            group = list(group)
            whole = len(group[0]) == depth + 1
            out[char] = (self._tree(group[whole:], depth + 1),
                         self.scores[group[0]] if whole else None)
        return out

    def from_here(self, text: str, at: int) -> list[tuple[int, int]]:
        """(end, score) of the pieces that start at ``at``; the character
        alone, as bytes, if it is no piece."""
        found, below = [], self.tree
        if text[at] not in self.scores:
            found.append((at + 1, self.unknown))
        for end, char in enumerate(text[at:at + self.longest], at + 1):
            node = below.get(char)
            if node is None:
                break
            below, score = node
            if score is not None:
                found.append((end, score))
        return found

    def path(self, text: str, limit: int | None = None) -> bytes:
        """Ids of the best segmentation of ``text`` whose pieces start before
        ``limit``, as little-endian unsigned 32-bit integers."""
        n, tree, longest, scores = len(text), self.tree, self.longest, self.scores
        best, back = [NONE] * (n + 1), [0] * (n + 1)
        best[0] = 0
        for at in range(n if limit is None else limit):
            here, below = best[at], tree
            if here == NONE:
                continue
            if text[at] not in scores and here + self.unknown > best[at + 1]:
                best[at + 1], back[at + 1] = here + self.unknown, at
            end = at
            for char in text[at:at + longest]:  # as from_here does
                node = below.get(char)
                if node is None:
                    break
                below, score = node
                end += 1
                if score is not None and here + score > best[end]:
                    best[end], back[end] = here + score, at
        out, at, ids = [], n, self.ids
        while at:
            start = back[at]
            known = ids.get(text[start:at])
            if known is None:
                out.extend([self.bytes[b] for b in reversed(text[start:at].encode())])
            else:
                out.append(known)
            at = start
        return struct.pack(f"<{len(out)}I", *reversed(out))

    def encode(self, text: str) -> bytes:
        """Ids of a text that starts and ends at cuts."""
        parts, known = [], self.known
        for segment in self.segment.findall(text):
            ids = known.get(segment)
            if ids is None:
                ids = self.path(segment)
                if len(segment) <= 64:
                    if len(known) >= KEPT:
                        known.clear()
                    known[segment] = ids
            parts.append(ids)
        return b"".join(parts)

    def total(self, ids: bytes) -> int:
        """The sum of scores; a foreign character's bytes count once."""
        values, out, at = np.frombuffer(ids, "<u4"), 0, 0
        while at < len(values):
            shown = self.shown[values[at]]
            if int(values[at]) in self._byte_ids:
                out += self.unknown
                lead = shown[0]
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            else:
                out += self._score_of[values[at]]
                at += 1
        return out

    @functools.cached_property
    def _byte_ids(self) -> set[int]:
        return set(self.bytes.values())

    @functools.cached_property
    def _score_of(self) -> dict[int, int]:
        return {i: self.scores[p] for p, i in self.ids.items()}

    def cuts(self, text: str) -> tuple[int | None, int | None]:
        """The first cut at or after the last state, and the last cut."""
        def is_cut(at):
            return ((text[at] == MARK and text[at - 1] != MARK)
                    or bool(self.foreign.match(text[at]) or self.foreign.match(text[at - 1])))

        first = next((i for i in range(self.states, len(text)) if is_cut(i)), None)
        if first is None:
            return None, None
        return first, next(i for i in range(len(text) - 1, first - 1, -1) if is_cut(i))

    def reach(self, text: str, limit: int, begin: np.ndarray) -> np.ndarray:
        """Best sums at ``limit`` and the states beyond it; ``begin`` has a row
        of lanes for each first place."""
        lanes = begin.shape[1]
        best = np.full((max(limit + self.states, len(begin)), lanes), NONE, np.int64)
        best[:len(begin)] = begin
        for at in range(limit):
            here = best[at]
            if here.max() <= NONE // 2:
                continue
            for end, score in self.from_here(text, at):
                np.maximum(best[end], here + score, out=best[end])
        return best[limit:limit + self.states]

    def matrix(self, body: str, ahead: str) -> np.ndarray:
        """Entry (i, j): the best sum from state i at the chunk's begin to
        state j at its end; ``ahead`` is what follows the chunk."""
        n, s = len(body), self.states
        lanes = np.full((s, s), NONE, np.int64)
        np.fill_diagonal(lanes, 0)
        first, last = self.cuts(body) if n > s else (None, None)
        if first is None:
            return level(self.reach(body + ahead, n, lanes).T)
        head = self.reach(body[:first], first, lanes)[0]
        middle = self.total(self.encode(body[first:last]))
        tail = self.reach((body + ahead)[last:], n - last, np.zeros((1, 1), np.int64))[:, 0]
        return level(head[:, None] + middle + tail[None, :])

    def origins(self, body: str, ahead: str, front: np.ndarray) -> np.ndarray:
        """For each state at the chunk's end the state at its begin that one pass
        over the whole text comes from; ``front`` has the best sums there."""
        n, s = len(body), self.states
        text, first = body + ahead, self.cuts(body)[0] if n > s else None
        limit = n if first is None else first  # all ways go through a cut
        best, origin = front.tolist() + [NONE] * limit, list(range(s)) + [0] * limit
        for at in range(limit):
            here = best[at]
            if here != NONE:
                for end, score in self.from_here(text, at):
                    if here + score > best[end]:
                        best[end], origin[end] = here + score, origin[at]
        return np.array(origin[limit:limit + s] if first is None else origin[first:first + 1] * s,
                        np.int32)

    def between(self, body: str, ahead: str, enter: int, leave: int) -> bytes:
        """Ids of a chunk from state ``enter`` to state ``leave``."""
        text, n = body[enter:] + ahead[:leave], len(body) - enter
        last = self.cuts(body)[1] if len(body) > self.states else None
        if last is None or last < enter:
            return self.path(text, n)
        return self.encode(text[:last - enter]) + self.path(text[last - enter:], len(body) - last)

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the mark put before it."""
        return text_of(ids, self.shown)


def shown_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes that each piece of a model stands for."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            silent = model.is_control(i) or model.is_unknown(i)
            out.append(b"" if silent else piece.replace(MARK, " ").encode())
    return out


def text_of(ids: bytes, shown: list[bytes]) -> str:
    raw = b"".join([shown[i] for i in np.frombuffer(ids, "<u4").tolist()])
    return raw.decode("utf-8", "replace")[1:]


@functools.cache
def pieces(path: str) -> Pieces:
    """One for each Python worker."""
    return Pieces(sentencepiece.SentencePieceProcessor(model_file=path))


@functools.cache
def shown(path: str) -> list[bytes]:
    """What a worker that only decodes holds of a model: no scores and no tree."""
    return shown_bytes(sentencepiece.SentencePieceProcessor(model_file=path))


def marked(text: str) -> str:
    """Spaces become word marks, and one is put before; empty stays empty."""
    return MARK + text.replace(" ", MARK) if text else ""


def level(sums: np.ndarray) -> np.ndarray:
    """``sums`` less their greatest, which changes no choice and keeps them
    small in a text of any length; what cannot be reached stays ``NONE``."""
    return np.where(sums <= NONE // 2, NONE, sums - sums.max())


def compose(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices, or of a row and a matrix."""
    return level((left[..., :, None] + right).max(axis=-2))


def first_front(size: int) -> np.ndarray:
    """The sums in front of a text: it begins in state 0."""
    return np.where(np.arange(size) == 0, 0, NONE)


def fronts(front: np.ndarray, matrices: list[np.ndarray]) -> list[np.ndarray]:
    """The best sums in front of each matrix, the first ones being ``front``."""
    out = [front]
    for m in matrices[:-1]:
        out.append(compose(out[-1], m))
    return out


def states(origins: list[np.ndarray]) -> list[int]:
    """The state at every boundary, followed from the end of the text."""
    out = [0]
    for before in reversed(origins):
        out.append(int(before[out[-1]]))
    return out[::-1]


def encode(docs: DataFrame, folder: str, model: str, id_column: str = "doc_id",
           text_column: str = "text", chunk: int = 1 << 17) -> DataFrame:
    """(id, text_sha256, ids) of each row; NULL texts count as empty, which have
    no ids.  Repeated rows and NULL ids keep their rows; other columns are
    ignored.

    Texts of up to ``chunk`` characters are encoded where they are read, longer
    ones by the scan, with the same ids.  A task of the scan holds the matrices
    of ``BLOCK`` chunks or of one text's blocks (2 KB each), and 64 bytes for
    each chunk of a text.  ``chunk`` is at least the longest piece.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    giant = F.char_length("text") > chunk

    def whole(batches):
        for ids, texts in text_slices(batches):
            own = pieces(model)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                 pa.array([own.encode(marked(t)) for t in texts], pa.binary())],
                names=["id", "text_sha256", "ids"])
        pieces(model).known.clear()  # an idle worker holds no segments

    def cut(batches):
        size = pieces(model).states
        for batch in batches:
            for name, key, text in zip(*(batch.column(i) for i in range(3))):
                value = marked(text.as_py())
                digest = hashlib.sha256(text.as_py().encode()).hexdigest()
                for seq, at in enumerate(range(0, len(value), chunk)):
                    yield pa.RecordBatch.from_pylist([{
                        "id": name.as_py(), "key": key.as_py(), "text_sha256": digest, "seq": seq,
                        "body": value[at:at + chunk],
                        "ahead": value[at + chunk:at + chunk + size]}], pa.schema([
                            ("id", pa.int64()), ("key", pa.int64()), ("text_sha256", pa.string()),
                            ("seq", pa.int64()), ("body", pa.string()), ("ahead", pa.string())]))

    def transfer(batches):
        for batch in batches:
            for key, seq, body, ahead in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pylist([{
                    "key": key, "seq": seq, "matrix": pieces(model).matrix(body, ahead).tobytes()}],
                    pa.schema([("key", pa.int64()), ("seq", pa.int64()), ("matrix", pa.binary())]))

    def square(raw):
        size = pieces(model).states
        return np.frombuffer(raw, np.int64).reshape(size, size)

    def multiply(batches):
        for batch in batches:
            for key, block, listed in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pylist([{
                    "key": key, "block": block, "matrix": functools.reduce(
                        compose, (square(x["matrix"]) for x in listed)).tobytes()}],
                    pa.schema([("key", pa.int64()), ("block", pa.int64()),
                               ("matrix", pa.binary())]))

    def scan(batches, name):
        """The sums in front of each listed matrix, from those in front of the first."""
        for batch in batches:
            for key, front, listed in zip(*(c.to_pylist() for c in batch.columns)):
                begin = (first_front(pieces(model).states) if front is None
                         else np.frombuffer(front, np.int64))
                found = fronts(begin, [square(x["matrix"]) for x in listed])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(listed), pa.int64()),
                     pa.array([x[name] for x in listed], pa.int64()),
                     pa.array([f.tobytes() for f in found], pa.binary())],
                    names=["key", name, "front"])

    def turn(batches):
        for batch in batches:
            for key, seq, body, ahead, front in zip(*(c.to_pylist() for c in batch.columns)):
                found = pieces(model).origins(body, ahead, np.frombuffer(front, np.int64))
                yield pa.RecordBatch.from_pylist([{
                    "key": key, "seq": seq, "origins": found.tobytes()}], pa.schema([
                        ("key", pa.int64()), ("seq", pa.int64()), ("origins", pa.binary())]))

    def settle(batches):
        for batch in batches:
            for key, listed in zip(*(c.to_pylist() for c in batch.columns)):
                way = states([np.frombuffer(x["origins"], np.int32) for x in listed])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(listed), pa.int64()),
                     pa.array([x["seq"] for x in listed], pa.int64()),
                     pa.array(way[:-1], pa.int32()), pa.array(way[1:], pa.int32())],
                    names=["key", "seq", "enter", "leave"])

    def trace(batches):
        for batch in batches:
            for name, key, digest, seq, body, ahead, enter, leave in zip(
                    *(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pylist([{
                    "id": name, "key": key, "text_sha256": digest, "seq": seq,
                    "ids": pieces(model).between(body, ahead, enter, leave)}], pa.schema([
                        ("id", pa.int64()), ("key", pa.int64()), ("text_sha256", pa.string()),
                        ("seq", pa.int64()), ("ids", pa.binary())]))

    def join(batches):
        for batch in batches:
            for name, digest, listed in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pylist([{
                    "id": name, "text_sha256": digest,
                    "ids": b"".join(x["ids"] for x in listed)}], pa.schema([
                        ("id", pa.int64()), ("text_sha256", pa.string()), ("ids", pa.binary())]))

    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = materialise(
        rows.filter(giant).select("id", F.monotonically_increasing_id().alias("key"), "text")
        .mapInArrow(cut, "id long, key long, text_sha256 string, seq long, body string, "
                         "ahead string").repartition(spread, "key", "seq"), f"{folder}/chunks")
    matrices = materialise(
        chunks.select("key", "seq", "body", "ahead")
        .mapInArrow(transfer, "key long, seq long, matrix binary"), f"{folder}/matrices")

    def in_order(name, value):
        return F.sort_array(F.collect_list(F.struct(name, value))).alias("listed")

    blocks = matrices.groupBy("key", F.floor(F.col("seq") / BLOCK).alias("block")).agg(
        in_order("seq", "matrix"))
    before = (blocks.mapInArrow(multiply, "key long, block long, matrix binary")
              .groupBy("key").agg(in_order("block", "matrix"))
              .select("key", F.lit(None).cast("binary").alias("front"), "listed")
              .mapInArrow(lambda b: scan(b, "block"), "key long, block long, front binary"))
    front = (blocks.join(before, ["key", "block"]).select("key", "front", "listed")
             .mapInArrow(lambda b: scan(b, "seq"), "key long, seq long, front binary"))
    ways = materialise(
        chunks.join(front, ["key", "seq"]).select("key", "seq", "body", "ahead", "front")
        .mapInArrow(turn, "key long, seq long, origins binary")
        .groupBy("key").agg(in_order("seq", "origins"))
        .mapInArrow(settle, "key long, seq long, enter int, leave int"), f"{folder}/states")
    long = (chunks.join(ways, ["key", "seq"])
            .select("id", "key", "text_sha256", "seq", "body", "ahead", "enter", "leave")
            .mapInArrow(trace, "id long, key long, text_sha256 string, seq long, ids binary")
            .groupBy("key", "id", "text_sha256")
            .agg(F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("listed"))
            .select("id", "text_sha256", "listed").mapInArrow(join, ENCODED))
    return rows.filter(~giant).mapInArrow(whole, ENCODED).unionByName(long)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the text of its ids.  Texts come back as they were,
    but for a word mark character of their own, which is read as a space."""
    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(part.schema.get_field_index("ids")).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([text_of(i, shown(model)) for i in ids], pa.string())],
                    names=[*part.schema.names, "text"])

    return encoded.mapInArrow(read, ENCODED + ", text string")


def digest(docs: DataFrame, folder: str, model: str) -> DataFrame:
    """Encode, decode, and whether the text came back."""
    return decode(encode(docs, folder, model), model).select(
        F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        (F.sha2("text", 256) == F.col("text_sha256")).alias("exact"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and the round trip."""
    import public_tokenizers

    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), run_folder(spark, "pieces"),
                  public_tokenizers.path("piece_bpe_32k.model"))
