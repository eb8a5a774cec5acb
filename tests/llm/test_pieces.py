import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from aerolake.llm import pieces as X

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return X.pieces(MODEL)


def some_texts(n, alphabet, longest):
    rnd = random.Random(3)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(longest)))
            for _ in range(n)]


def test_equals_the_library_on_a_unigram_model(own):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # the same pieces and scores as a unigram model
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    # The library adds 32-bit floats; runs of spaces (score -1e9) would round.
    for t in some_texts(300, "aethnorsi.é", 30):
        assert np.frombuffer(own.encode(X.marked(t)), "<u4").tolist() == library.encode(t)


class Fractions:
    """A small model whose scores are no whole numbers, with many equal sums."""

    def __init__(self):
        self.list = [f"<0x{b:02X}>" for b in range(256)]
        words = ["a", "b", "c", X.MARK, "aa", "ab", "ba", "bb", "abc", "bca", "aab", X.MARK + "a"]
        self.scores = [0.0] * 256 + [-0.75 * len(w) - 0.125 * (w == "bca") for w in words]
        self.list += words

    def get_piece_size(self):
        return len(self.list)

    def id_to_piece(self, i):
        return self.list[i]

    def get_score(self, i):
        return self.scores[i]

    def is_byte(self, i):
        return i < 256

    def is_control(self, i):
        return False

    is_unknown = is_control


def by_chunks(own, text, size, block):
    """The scan without Spark, with blocks of ``block`` chunks."""
    cut = [(text[i:i + size], text[i + size:i + size + own.states])
           for i in range(0, len(text), size)]
    matrices = [own.matrix(*x) for x in cut]
    parts = [matrices[i:i + block] for i in range(0, len(matrices), block)]
    begins = X.fronts(X.first_front(own.states), [functools.reduce(X.compose, p) for p in parts])
    front = [f for begin, part in zip(begins, parts) for f in X.fronts(begin, part)]
    way = X.states([own.origins(*x, f) for x, f in zip(cut, front)])
    return b"".join(own.between(*x, a, b) for x, a, b in zip(cut, way, way[1:]))


def every_way(own, text, end):
    """All segmentations of the first ``end`` characters: (sum, pieces)."""
    if not end:
        yield 0, ()
    for start in range(max(0, end - own.longest), end):
        score = own.scores.get(text[start:end], own.unknown if end - start == 1 else None)
        if score is not None:
            for total, before in every_way(own, text, start):
                yield total + score, (*before, text[start:end])


def test_fractional_scores_and_ties_against_all_segmentations():
    own = X.Pieces(Fractions())
    for text in some_texts(60, "aabbc é", 11):
        text = X.marked(text)
        # Equal sums: the longer last piece wins, then the one before it.
        _, want = max(every_way(own, text, len(text)),
                      key=lambda x: (x[0], [len(p) for p in reversed(x[1])]))
        ids = [i for p in want for i in (
            [own.ids[p]] if p in own.ids else [own.bytes[b] for b in p.encode()])]
        assert np.frombuffer(own.path(text), "<u4").tolist() == ids
        assert own.encode(text) == own.path(text)


def test_scan_gives_the_ids_of_one_pass(own):
    for at, t in enumerate(some_texts(120, "aethnorsi", 300) + some_texts(120, "aeth no\né😀", 300)):
        t = X.marked(t)
        if t:
            assert by_chunks(own, t, 16 + at % 40, 1 + at % 5) == own.path(t) == own.encode(t)
    ties = X.Pieces(Fractions())
    for at, t in enumerate(some_texts(300, "aabbc", 200) + some_texts(100, "aabbc é", 200)):
        t = X.marked(t)
        if t:
            assert by_chunks(ties, t, 3 + at % 30, 1 + at % 5) == ties.path(t) == ties.encode(t)


def test_the_product_is_associative():
    rnd = np.random.default_rng(5)
    a, b, c = (X.level(np.where(rnd.random((6, 6)) < 0.3, X.NONE, rnd.integers(-99, 0, (6, 6))))
               for _ in range(3))
    assert (X.compose(X.compose(a, b), c) == X.compose(a, X.compose(b, c))).all()


def test_a_giant_text_has_the_same_ids_in_any_chunks(spark, folder, own):
    text = "aethnorsi" * 900 + " the end of it \n\n é " * 300 + "no" * 2000
    docs = spark.createDataFrame([(1, text), (2, text), (None, text[::-1])], "doc_id long, text string")
    for chunk in (16, 1000):  # more than BLOCK chunks, and fewer
        rows = X.encode(docs, f"{folder}/giant{chunk}", MODEL, chunk=chunk).collect()
        assert sorted((r.id or 0, bytes(r.ids)) for r in rows) == sorted(
            (i, own.path(X.marked(t))) for i, t in ((1, text), (2, text), (0, text[::-1])))


def test_round_trip_of_odd_rows(odd_docs, empty_docs, folder):
    for name, chunk in (("whole", 1 << 20), ("cut", 64)):
        out = X.decode(X.encode(odd_docs, f"{folder}/{name}", MODEL, chunk=chunk), MODEL)
        rows = out.collect()
        assert len(rows) == odd_docs.count()
        assert sorted(r.text for r in rows) == sorted(r.text or "" for r in odd_docs.collect())
    assert X.encode(empty_docs, f"{folder}/none", MODEL).count() == 0


def test_query_digest(odd_docs, folder, own):
    rows = X.digest(odd_docs.filter("doc_id < 10"), folder, MODEL).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in rows:
        ids = own.encode(X.marked(texts[r.doc_id]))
        assert (r.n_pieces, r.ids_crc32, r.exact) == (len(ids) // 4, zlib.crc32(ids), True)
