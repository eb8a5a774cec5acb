import random
import re

from aerolake.llm import minhash

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Set size and smallest linked id of each document, comparing everything."""
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_groups_match_brute_force(spark, folder):
    rnd = random.Random(11)
    base = [[f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(1, 120))] for _ in range(25)]
    texts = []
    for _ in range(260):
        words = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(90)}"
        texts.append(" ".join(words))
    texts += [None, "", " \x0b\n", "Ab cd", "aB  CD", "ÀB cd", "àB cd"] + [texts[0]] * 30
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = list(zip(order, texts))
    docs = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in [*rows, rows[0]]],
                                 "doc_id long, text string, key string, slot int, class int")
    got = {r.id: (r.n_shingles, r.component) for r in
           minhash.near_duplicates(docs.repartition(4), folder).collect()}
    want = brute(rows)
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in want.items()}
    # Links at the very threshold may agree in too few coordinates.
    assert sum(got[i] != want[i] for i in want) <= 1


def test_odd_rows_and_empty_table(folder, odd_docs, empty_docs):
    rows = minhash.near_duplicates(odd_docs, folder).collect()
    ids = [r.doc_id for r in odd_docs.collect()]
    assert len(rows) == len({i for i in ids if i is not None}) + ids.count(None)
    assert minhash.near_duplicates(empty_docs, f"{folder}/none").count() == 0


def test_documents_of_one_passage_are_not_paired(spark, folder, monkeypatch):
    """Many different texts share a passage; a few of them have near copies whose
    links only the split lists can find."""
    seen = []
    plain = minhash.across
    monkeypatch.setattr(minhash, "across", lambda left, keys: seen.append(plain(left, keys)) or seen[-1])
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    own = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(300)]
    texts = [" ".join(passage + o) for o in own]
    texts += [" ".join(passage + o[:-1] + ["z"]) for o in own[:40]]
    texts += [" ".join(passage + ["y"] + o) for o in own[20:30]]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component) for r in minhash.near_duplicates(docs, folder).collect()}
    assert got == brute(rows)
    assert sum(p.count() for p in seen) < 20 * len(rows)


def test_split_lists_lose_no_pair(spark, folder):
    """Against all pairs: whoever agrees often enough meets in a part."""
    rnd = random.Random(5)
    base = [[rnd.randrange(3) for _ in range(12)] for _ in range(4)]
    sig = {s: [v if rnd.random() < 0.7 else rnd.randrange(9) for v in rnd.choice(base)]
           for s in range(60)}
    for v in sig.values():
        v[0] = 1
    key = 1      # coordinate 0, value 1
    rows = spark.createDataFrame([(key, s, s) for s in sig], "key long, slot long, comp long")
    signed = spark.createDataFrame(list(sig.items()), "slot long, signature array<int>")
    parts = minhash.split_lists(rows, signed, 8, folder)
    pairs = {(r.b, r.a) for r in minhash.across(
        minhash.unsettled(parts, ["key", "other"]), ["key", "other"]).collect()}
    want = {(a, b) for a in sig for b in sig if a < b
            and sum(x == y for x, y in zip(sig[a], sig[b])) >= 8}
    assert want <= pairs


def test_a_large_group_of_near_copies_is_not_paired(spark, folder, monkeypatch):
    """Copies of one text with more and more edits: some are similar to each other, some
    only agree in many coordinates; no list of theirs is compared as a whole."""
    seen = []

    def counted(plain):
        return lambda *args: seen.append(plain(*args)) or seen[-1]

    for name in ("across", "similar"):
        monkeypatch.setattr(minhash, name, counted(getattr(minhash, name, None)), raising=False)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(i % 14):
            words[rnd.randrange(200)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words[:200 - i % 3])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.id: (r.n_shingles, r.component) for r in minhash.near_duplicates(docs, folder).collect()}
    want = brute(rows)
    assert len(set(c for _, c in want.values())) > 50
    assert sum(got[i] != want[i] for i in want) <= 1  # links at the very threshold
    assert sum(p.count() for p in seen) < 10 * len(rows)


def test_set_lists_lose_no_pair(spark, folder):
    """Against all pairs: similar sets of any sizes and different components meet."""
    rnd = random.Random(8)
    base = [rnd.sample(range(10**6), 60) for _ in range(4)]
    sets = {}
    for slot in range(150):
        own = [s if rnd.random() < 0.93 else rnd.randrange(10**6) for s in rnd.choice(base)]
        sets[slot] = set(own[rnd.randrange(10):60 - rnd.randrange(10)])
    sets |= {200 + i: set(range(i, i + 3 + i % 3)) for i in range(12)}
    rows = spark.createDataFrame(
        [(s, s, len(v), x, s % 90) for s, v in sets.items() for x in v],
        "slot long, own long, n long, shingle long, comp long")
    pairs = {(r.b, r.a) for r in minhash.similar(minhash.set_lists(rows, 75, folder)).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and a % 90 != b % 90
            and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(want) > 100 and want <= pairs
