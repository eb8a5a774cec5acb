"""Ranked search against scores of every document, computed one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from aerolake.llm import best_position as B
from aerolake.llm.oracle import SQL
from aerolake.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return TERM.findall((text or "").translate(lower))


def brute(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        query, scores = Counter(words(text)), []
        for i, c, n in held:
            m = 25 + 75 * n * big_n // big_l
            scores.append((sum(
                times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in query.items() if t in c), i))
        best = sorted((s for s in scores if s[0] > 0),
                      key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    pool = ["The", "of", "É", "été", "x1", "ab", "Zebra", "梦", "rare", "a_b", "ſ", "K"] + [
        f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rnd.choices(pool, k=rnd.randrange(1, 50)))) for i in range(n)]
    docs += [docs[0], docs[1], (None, "rare zebra"), (n, None), (n + 1, ""), (n + 2, " .-\n"),
             (n + 3, "the " * 30_000), (n + 4, docs[2][1])] if n else []
    items = [(i, " ".join(rnd.choices(pool, k=8))) for i in range(12)]
    items += [items[0], (0, "rare"), (None, "zebra the the"), (90, None), (91, ""), (92, "nowhere")]
    return docs, items


@pytest.mark.parametrize("n,step,shard,blocks", [(0, 32, 10**6, 1000), (5, 32, 10**6, 1000),
                                                 (400, 2, 10**6, 1000), (400, 2, 300, 4)])
def test_ranks_equal_brute_force(spark, tmpdir_path, monkeypatch, n, step, shard, blocks):
    monkeypatch.setattr(B, "STEP", step)
    monkeypatch.setattr(B, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(B, "BLOCK_ITEMS", blocks)
    docs, items = corpus(n)
    spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs],
                          "doc_id long, text string, n int, words int, score int, rank int"
                          ).repartition(3).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, query int"
                          ).write.parquet(f"{tmpdir_path}/benchmark.parquet")
    got = QUERIES["op12_best_position"](spark, tmpdir_path)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_best_positions_stop_early():
    rnd = np.random.default_rng(1)
    n = 20_000
    tfs = rnd.geometric(0.4, (n, 3)).astype(np.int32)
    tfs[7] = 60
    shard = B.Shard(np.arange(n), [200] * n, np.full(n, 3), np.tile(np.arange(3), n), tfs.ravel(),
                    n, 200 * n)
    scores, docs, depth = shard.best(B.Query(0, {0: 1, 1: 1, 2: 2}), np.array([5, 7, 9]), 1)
    assert docs[0] == 7 and depth <= 4 * B.STEP


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS FROM '/root/testdata/sf0.01/{name}.parquet'")
    cur = con.execute(SQL["op12_best_position"])
    names = [d[0] for d in cur.description]
    got = QUERIES["op12_best_position"](spark, "/root/testdata/sf0.01").select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
