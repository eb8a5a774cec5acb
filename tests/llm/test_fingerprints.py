import hashlib
import itertools
import random

from aerolake.llm import syncmers as Y


def brute_anchors(text, k=Y.K, s=Y.S):
    """Closed syncmers, one k-mer at a time."""
    inner = [int(Y._grams(Y.code_points(text[i:i + s]).astype("u8") + 1, s, 11)[0])
             for i in range(len(text) - s + 1)]
    return [i for i in range(len(text) - k + 1)
            if min(inner[i:i + k - s + 1]) in (inner[i], inner[i + k - s])]


def test_anchors_match_brute_force(texts):
    for t in texts[:40]:
        if len(t) >= Y.K and brute_anchors(t):
            assert Y.anchors(Y.code_points(t))[0].tolist() == brute_anchors(t)


def test_pieces_do_not_show(monkeypatch, texts):
    whole = Y.anchors(Y.code_points(texts[-1]))
    monkeypatch.setattr(Y, "PIECE", 100)
    cut = Y.anchors(Y.code_points(texts[-1]))
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def words(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(n)]


def like(a, b):
    return Y.likeness(*(Y.fingerprint(Y.code_points(t)) for t in (a, b)))


def test_sketch_matches_brute_force(texts):
    """Each coordinate names the least product and the first place of its anchor."""
    for t in texts:
        points = Y.code_points(t or "")
        places, hashes = Y.anchors(points)
        got = Y.fingerprint(points)
        assert len(got) == (Y.COORDS if len(hashes) else 0)
        for (hashed, place), salt in zip(got.tolist(), Y.SALTS.tolist()):
            least, at = min(((h * salt) % 2**64, p)
                            for h, p in zip(hashes.tolist(), places.tolist()))
            assert place == at * 65536 // len(points)
            assert hashed == int(Y.mix(Y.np.array([least], "u8"))[0]) & 0xFFFF


def test_chain_matches_brute_force():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(7)] for _ in range(2))
        pairs = sorted(zip(a, b))
        want = max(n for n in range(8) for c in itertools.combinations(pairs, n)
                   if all(x[1] <= y[1] for x, y in zip(c, c[1:])))
        assert Y.chain(Y.np.array(a), Y.np.array(b)) == want


def test_positions_tell_moved_blocks_from_edits():
    """Swapped blocks keep the set of anchors but not their order."""
    w = words(1, 900)
    text, blocks = " ".join(w), [" ".join(w[i:i + 90]) for i in range(0, 900, 90)]
    assert like(text, text) == 1.0
    assert like(text, " ".join(blocks[::-1])) < 0.35
    assert like(text, " ".join(blocks[1:] + blocks[:1])) > 0.7
    assert like(text, " ".join(w[:300] + words(2, 60) + w[300:])) > 0.8
    assert like(text, " ".join(w[:450])) > 0.3
    assert like(text, " ".join(words(4, 900))) < 0.1


def test_neighbours_across_partitions(spark, folder, texts):
    docs = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)],
                                 "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in Y.fingerprints(docs, folder).collect()}
    order = [(i * 3, t or "") for i, t in enumerate(texts)][::-1]
    assert len(got) == len(order)
    for at, (name, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        third = len(text) // 3
        edit = text[:len(text) - third] + following[:third]
        row = got[name]
        mine, other, then = (Y.fingerprint(Y.code_points(t)) for t in
                             (text, edit, following))
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert row.fingerprint == mine.tobytes().hex()
        assert row.near_edited == Y.likeness(mine, other)
        assert row.near_next == Y.likeness(mine, then)


def test_odd_rows_and_empty_table(folder, odd_docs, empty_docs):
    out = Y.fingerprints(odd_docs, folder)
    assert out.count() == odd_docs.count()
    assert Y.fingerprints(empty_docs, f"{folder}/none").count() == 0
    assert Y.anchor_table(odd_docs).filter("doc_id = 0").count() > 0
