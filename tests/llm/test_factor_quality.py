"""The factorisation machine: pair sums, slopes, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np

from aerolake.llm import factor_quality as Q
from aerolake.llm.queries import QUERIES


def test_identity_equals_the_pairs():
    rnd = np.random.default_rng(2)
    machine = Q.Machine(0.3, rnd.normal(size=Q.SIZE), rnd.normal(size=(Q.SIZE, Q.RANK)))
    parts = [(rnd.choice(Q.SIZE, n, replace=False), rnd.normal(size=n)) for n in (1, 2, 17)]
    for (index, value), got in zip(parts, Q.margins(parts, machine)):
        want = machine.bias + machine.weights[index] @ value
        for a in range(len(index)):
            for b in range(a):
                want += (machine.factors[index[a]] @ machine.factors[index[b]]) * value[a] * value[b]
        assert np.isclose(got, want)


def test_pairs_are_learnt():
    # The label is whether two features agree: no sum of weights can tell.
    rows = [(np.array([a, 2 + b]), np.ones(2)) for a in (0, 1) for b in (0, 1)] * 100
    label = np.array([float(i[0] + 2 == i[1]) for i, _ in rows])
    machine = Q.train(rows, label, epochs=40)
    assert ((Q.margins(rows, machine) > 0) == (label > 0)).all()


def corpus(n=600):
    rnd = random.Random(4)
    base = [a + b for a in ("al", "ri", "sto", "hou") for b in ("pha", "ver", "ne", "se", "ds")]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(base) for _ in range(rnd.randrange(3, 60))]
        kind = i % 5
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        if kind == 1 and i % 2:
            words = [w for w in words for _ in range(6)]
        docs.append((i, " ".join(words), "src", len(words)))
        labels.append((i, int(not (kind == 0 or (kind == 1 and i % 2))), 0))
    return docs, labels


def write(spark, root, docs, labels):
    spark.createDataFrame([(*d, 0.5, 1) for d in docs],
                          "doc_id long, text string, source string, n_chars long, score double, "
                          "label int").repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")


def test_query_on_held_out_and_odd_rows(spark, tmpdir_path):
    docs, labels = corpus()
    odd = [(None, None, None, None), (9001, None, None, None), (9002, "", "s", 0), docs[3], docs[3],
           (9003, "word " * 60_000, "s", -5)]
    write(spark, tmpdir_path, docs + odd, labels + [(None, 1, 1), (3, None, None), labels[4]])
    rows = QUERIES["op11_factor_machine"](spark, tmpdir_path).collect()
    assert len(rows) == len(docs) + len(odd)
    want = {i: q for i, q, _ in labels}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {
        i for i, *_ in docs + odd if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    known = [r for r in held if r.doc_id in want]
    assert np.mean([r.predicted == want[r.doc_id] for r in known]) > 0.97
    assert len({r.score for r in rows if r.doc_id == 3}) == 1


def test_held_out_labels_are_not_learnt(spark, tmpdir_path):
    docs, labels = corpus(200)
    out = {}
    for name in ("plain", "turned"):
        marks = [(i, 1 - q if name == "turned" and zlib.crc32(str(i).encode()) % 3 == 1 else q, t)
                 for i, q, t in labels]
        write(spark, f"{tmpdir_path}/{name}", docs, marks)
        out[name] = sorted(map(tuple, QUERIES["op11_factor_machine"](
            spark, f"{tmpdir_path}/{name}").collect()))
    assert out["plain"] == out["turned"]


def test_without_labels_or_rows(spark, tmpdir_path):
    docs, labels = corpus(20)
    one = [(i, 1, 0) for i, *_ in labels]
    for name, d, m, want in [("none", docs, [], {0.5}), ("one", docs, one, {1.0}),
                             ("empty", [], labels, set())]:
        write(spark, f"{tmpdir_path}/{name}", d, m)
        rows = QUERIES["op11_factor_machine"](spark, f"{tmpdir_path}/{name}").collect()
        assert len(rows) == len(d) and {round(r.score, 9) for r in rows} == want
