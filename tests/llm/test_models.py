"""The trained operators: held-out accuracy, exact kernel sums, totals reached."""

import random

import numpy as np
import pyarrow as pa
from aerolake.llm import mixing as M
from aerolake.llm import store as S
from aerolake.llm import string_kernel as K


def brute_kernel(a, b):
    def features(word):
        word, out = f"\x02{word}\x03", {}
        for i in range(len(word)):
            for j in range(i + 1, min(i + 4, len(word))):
                for k in range(j + 1, min(i + 5, len(word))):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + K.DECAY ** (k - i - 2)
        return out

    x, y = features(a), features(b)
    dot = sum(v * y.get(k, 0) for k, v in x.items())
    return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_kernel_matches_brute_force():
    words = ["idiot", "i.d.i.o.t", "idi-ot", "aaaa", "é", "梦😀x", "banana", "bananana"]
    got = K.similarities(words, words)
    assert np.allclose(got, [[brute_kernel(a, b) for b in words] for a in words])
    assert got[0, 2] > 0.4 > got[0, 6]


def corpus(spark, n=400):
    rnd = random.Random(2)
    base = ["alpha", "river", "stone", "house", "cloud", "green", "paper", "seven"]
    bad = ["grubnash", "grub.nash", "grubbnash", "gruxbnash"]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(base) + rnd.choice(["", "s", "er"]) for _ in range(30)]
        if i % 4 == 0:
            words[rnd.randrange(30)] = rnd.choice(bad)
        rows.append((i, " ".join(words), 9))
        labels.append((i, i % 3 // 2, int(i % 4 == 0)))
    rows += [(None, None, 9), (n, "", 9), (n + 1, None, 9), rows[0], (n + 2, "z" * 50_000, 9)]
    return (spark.createDataFrame(rows, "doc_id long, text string, _score int"),
            spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)],
                                  "doc_id long, quality int, toxic int"))


def test_toxicity_held_out(spark):
    docs, labels = corpus(spark)
    model = K.fit(docs, labels)
    rows = K.score(docs, model, output="s").collect()
    assert len(rows) == docs.count() and all(0 <= r.s <= 1 for r in rows)
    right = [(r.s >= 0.5) == (r.doc_id % 4 == 0) for r in rows
             if r.doc_id is not None and r.doc_id < 400]
    assert np.mean(right) > 0.97
    kept = K.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 1


def test_toxicity_without_labels(spark):
    docs, labels = corpus(spark, 20)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        model = K.fit(docs, none)
        assert K.score(docs, model, output="s").filter("s >= 0.5").count() == 0
    assert K.score(docs.limit(0), model).count() == 0


def test_mixing_reaches_targets(spark, folder):
    docs, labels = corpus(spark)
    rows = M.document_rates(docs, labels, folder, {0: 0.4, 1: 0.6}).collect()
    assert len(rows) == docs.count() and all(r._rate >= 0 for r in rows)
    poor = sum(r._rate * r._tokens * r._posterior[0] for r in rows)
    good = sum(r._rate * r._tokens * r._posterior[1] for r in rows)
    tokens = sum(r._tokens for r in rows)
    assert abs(poor - 0.4 * tokens) < 1e-3 * tokens and abs(good - 0.6 * tokens) < 1e-3 * tokens


def test_projected_steps_match_the_optimum(spark):
    rnd = np.random.default_rng(4)
    p = rnd.dirichlet([0.3] * 3, 300)
    members = spark.createDataFrame([(10.0, x.tolist()) for x in p],
                                    "tokens double, p array<double>")
    steps, targets, reached = M.fit_steps(members, [0.8, 0.1, 0.1])
    rate = M._rates(p, steps, 0.0)[0]
    assert (rate >= 0).all() and np.allclose((10 * rate) @ p, reached)
    assert np.abs(reached - targets).max() < 1e-3 * targets.sum()


def test_mix_keeps_every_row(spark, folder, odd_docs, empty_docs):
    docs, labels = corpus(spark)
    out = M.mix(docs, labels, folder)
    assert out.columns == docs.columns
    assert docs.exceptAll(out).count() == 0
    assert M.mix(odd_docs, labels, f"{folder}/odd").count() >= odd_docs.count()
    assert M.mix(empty_docs, labels, f"{folder}/none").count() == 0


def whole_kernel(a, b):
    """The usual recursion for three characters, gaps of any size, unit length."""
    a, b = f"\x02{a}\x03", f"\x02{b}\x03"

    def raw(x, y):
        d = K.DECAY
        inner = np.ones((len(x) + 1, len(y) + 1))
        for _ in range(2):
            grown = np.zeros_like(inner)
            for i in range(1, len(x) + 1):
                for j in range(1, len(y) + 1):
                    grown[i, j] = (d * grown[i - 1, j] + d * grown[i, j - 1]
                                   - d * d * grown[i - 1, j - 1]
                                   + d * d * inner[i - 1, j - 1] * (x[i - 1] == y[j - 1]))
            inner = grown
        return d * d * sum(inner[i, j] for i in range(len(x)) for j in range(len(y)) if x[i] == y[j])

    return raw(a, b) / np.sqrt(raw(a, a) * raw(b, b))


def test_whole_kernel_matches_the_recursion():
    words = ["idiot", "i..d..i..o..t", "i--d--i--o--t", "ixxxdxxxixxxoxxxt", "é", "q" * 32, "banana"]
    got = K.similarities(words, words, K.WHOLE)
    assert np.allclose(got, [[whole_kernel(a, b) for b in words] for a in words])
    assert got[0, 1] > K.similarities(words, words)[0, 1]


def test_gapped_and_broken_words_are_read():
    for text in ("i.d.i.o.t", "i..d..i..o..t", "i---d---i---o---t", "id i ot", "an idi o t !", "i d iot"):
        assert "idiot" in K.words(text), text


def test_recall_of_inserted_signs(spark):
    docs, labels = corpus(spark)
    model = K.fit(docs, labels)
    plain = "alpha river stone houses clouds green papers seven " * 3
    assert K.probability([plain], model)[0] < 0.5
    for n in (1, 2, 3):
        texts = [plain + (filler * n).join("grubnash") for filler in ".-_* "]
        assert (K.probability(texts, model) >= 0.5).all(), n


def test_margins_by_place_equal_the_subsequences():
    """The sums over all words of one length against one subsequence at a time."""
    rnd = random.Random(8)
    marks = ["grubnash", "idiot", "é梦x", "ab", "alpha", "zzz"]
    own, key, value = K.subsequences(marks, K.WHOLE)
    keys, place = np.unique(key, return_inverse=True)
    weights = np.bincount(place, value * np.array([1, -2, .5, 3, .1, -1])[own], len(keys))
    model = K.Model(keys, weights, 0.25, np.zeros(4))
    units = [*marks, "a", "", "q" * K.LONGEST, "g.r.u.b.n.a.s.h", "𝒳梦é",
             *("".join(rnd.choice("abgruinshé梦.") for _ in range(rnd.randrange(1, 33)))
               for _ in range(60))]
    got = K.word_margins(units, model)
    for unit, margin in zip(units, got):
        if not unit:
            continue
        _, k, v = K.subsequences([unit], K.WHOLE)
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        assert np.isclose(margin, 0.25 + (v * weights[at] * (keys[at] == k)).sum()), unit


def test_words_that_come_again_keep_their_margins(monkeypatch):
    """A full memory loses only words that the next texts do not hold."""
    asked = []
    monkeypatch.setattr(K, "MEMO", 3)
    monkeypatch.setattr(K, "word_margins", lambda units, *rest: (
        asked.append(list(units)) or np.arange(len(units)) / 10))
    model, memo = K.Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros(4)), {}
    first = K.text_features(["alpha beta gamma delta", ""], model, memo)
    again = K.text_features(["delta other", "delta"], model, memo)
    assert asked == [["alpha", "beta", "gamma", "delta"], ["other"]]
    assert set(memo) == {"delta", "other"}
    assert np.allclose(first, [[0.3, 0.2, np.log(5), 1], [-2, -2, 0, 1]])
    assert np.allclose(again, [[0.3, 0, np.log(3), 1], [0.3, -2, np.log(2), 1]])


def test_texts_go_to_python_in_small_batches(spark):
    """A partition's texts are not held whole on their way to Python."""
    key, before = S.BATCH_KEY, spark.conf.getAll.get(S.BATCH_KEY)
    docs = spark.range(0, 16, 1, 1).selectExpr("id as doc_id", "repeat('abcdefg ', 200000) as text")
    none = K.Model(np.zeros(0, np.uint64), np.zeros(0), -2.0, np.array([0, 0, 0, -30.0]))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    try:
        spark.conf.unset(key)
        assert K.score(docs, none).filter("score < 0.5").count() == 16
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 24_000_000 and max(found) < 8_000_000
        spark.conf.set(key, "1g")  # the session's own limit stays
        K.score(docs, none)
        assert spark.conf.get(key) == "1g"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_sampled_rows_need_no_python_workers(spark, monkeypatch):
    """The chosen ids go to Spark as one Arrow table, not as an RDD of Python rows."""
    docs, labels = corpus(spark)
    given, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *rest, **named: (
        given.append(type(data)) or create(self, data, *rest, **named)))
    K.fit(docs, labels)
    assert given == [pa.Table]
