"""The manifest against a tree built level by level in one list."""

import random
import zlib
from hashlib import sha256

import pytest

from aerolake.llm import merkle as M
from aerolake.llm.oracle import SQL
from aerolake.llm.queries import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """Root, and of each leaf the siblings and its place, level by level."""
    paths, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        grown, under = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for j, _ in enumerate(run):
                for leaf in at[i + j]:
                    paths[leaf].append((j, run[:j] + run[j + 1:]))
            grown.append(h(*run))
            under.append([x for leaves in at[i:i + 3] for x in leaves])
        nodes, at = grown, under
    return nodes[0], paths


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    if not rows:
        return []
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf(r) for r in groups[s]]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for r, path in zip(groups[s], trees[s][1]):
            path = path + up
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf((*r[:4], text))
            for place, beside in path:
                node = h(*beside[:place], node, *beside[place:])
            proof = h(*(d for _, beside in path for d in beside))
            out.append((r[0], leaf(r), trees[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def documents(n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "ü", None, "c" if i % 50 == 0 else "a"]),
             rnd.choice(["en", None]), rnd.choice([3, None]), rnd.choice(["x\ny", "", None, "zß\n" * i]))
            for i in range(n)]
    return rows + rows[:2] + [(None, "a", None, None, None), (None, None, None, None, "n\n")]


@pytest.mark.parametrize("n,levels", [(0, 7), (1, 7), (4, 1), (40, 1), (300, 2), (300, 7)])
def test_manifest_equals_brute_force(spark, tmpdir_path, monkeypatch, n, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    rows = documents(n, n) if n > 1 else [(7, "only", None, 1, "a\nb")] * n
    data = [(*r, 5, "t", 6) for r in rows]
    spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string, "
                          "rank int, tree string, total int").repartition(4).write.parquet(
        f"{tmpdir_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_merkle_witnesses"](spark, tmpdir_path).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_appender_extends_earlier_witnesses():
    tree = M.Appender()
    first = tree.append(b"a" * 32)
    assert not first
    second = tree.append(b"b" * 32)
    assert bytes(first) == b"b" * 32 and bytes(second) == b"a" * 32
    tree.append(b"c" * 32)
    assert bytes(first) == b"b" * 32 + b"c" * 32


def test_changed_leaf_is_found(spark, folder):
    docs = spark.createDataFrame([(i, "s", f"t{i}") for i in range(20)],
                                 "doc_id long, source string, text string")
    from pyspark.sql import functions as F

    given = {"text": F.when(F.col("doc_id") == 4, "other").otherwise(F.col("text"))}
    rows = M.verified(M.manifest(docs, folder, columns=["doc_id", "text"], presented=given))
    assert [r.id for r in rows.filter("folded <> root").collect()] == [4]


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS FROM '/root/testdata/sf0.001/documents.parquet'")
    cur = con.execute(SQL["op13_merkle_witnesses"])
    names = [d[0] for d in cur.description]
    got = QUERIES["op13_merkle_witnesses"](spark, "/root/testdata/sf0.001").select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
