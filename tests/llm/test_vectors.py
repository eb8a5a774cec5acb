import numpy as np
from aerolake.llm import grid_join as G


def brute(rows, least):
    """Links and components by comparing everything."""
    ids = sorted({r[0] for r in rows})
    links = {i: set() for i in ids}
    for a, v, x in rows:
        for b, w, y in rows:
            if a == b or x is None or x != y or v is None or w is None or len(v) != len(w):
                continue
            if any(c is None or not np.isfinite(c) for c in [*v, *w]):
                continue
            p, q = np.array(v, float), np.array(w, float)
            if p.any() and q.any() and p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= least:
                links[a].add(b)
    comp = {}
    for i in ids:
        if i not in comp:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in comp:
                    comp[j] = i
                    todo += links[j]
    return {i: (len(links[i]), comp[i]) for i in ids}


def test_links_match_brute_force(spark, folder):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rnd.normal(size=8) * 0.25).tolist(), i % 2) for i in range(200)]
    rows += [(200 + i, rows[0][1], 0) for i in range(60)]  # a group of copies
    rows += [(300, [0.0] * 8, 0), (301, None, 0), (302, [float("nan")] * 8, 0), (303, [], 1),
             (304, [None] * 8, 1), (305, rows[0][1], None), (306, rows[0][1][:7], 0),
             (307, [x * 1e200 for x in rows[0][1]], 0), (308, [-0.0] + [1.0] * 7, 0),
             (309, [0.0] + [1.0] * 7, 0)]
    frame = spark.createDataFrame(
        [(i, v, x, "k") for i, v, x in [*rows, rows[3]]],
        "vec_id long, embedding array<double>, label int, key string").repartition(4)
    big = rows[267]  # its square leaves the doubles: compare a plain copy
    want = brute([r if r[0] != 307 else (307, rows[0][1], 0) for r in rows], 0.93)
    got = {r.id: (r.n_links, r.component) for r in
           G.near_vectors(frame, folder, block=16).collect()}
    assert got == want and big is not None


def test_recursion_skips_and_keeps_all(monkeypatch):
    monkeypatch.setattr(G, "LEAF", 4)
    rnd = np.random.default_rng(1)
    unit = G.unit(np.vstack([rnd.normal(size=(40, 3)), np.eye(3).repeat(9, 0)]))
    block = {"id": np.arange(67), "weight": np.ones(67, int), "unit": unit, "proj": unit}
    count, _, edges = G.join_blocks(block, block, 0.93, True)
    assert count.tolist() == ((unit @ unit.T >= 0.93).sum(1) - 1).tolist()
    assert len(edges) <= 66


def test_empty_table_and_missing_ids(spark, folder):
    schema = "vec_id long, embedding array<float>, label int"
    assert G.near_vectors(spark.createDataFrame([], schema), folder).count() == 0
    rows = spark.createDataFrame([(None, [1.0], 1), (None, [1.0], 1), (4, [1.0], 1)], schema)
    got = sorted((r.id or 0, r.n_links, r.component) for r in
                 G.near_vectors(rows, f"{folder}/b").collect() if r.id)
    assert got == [(4, 0, 4)]
