import itertools

from aerolake.llm import url_rules as U
from pyspark.sql import functions as F


def test_host_path_and_rules(spark):
    cases = {
        None: ("", "", None), "nothing": ("", "", None), "http://A.Com": ("a.com", "", None),
        "http://A.Com/": ("a.com", "/", "com/"),
        "x://www.example.com/en/1?q#f": ("www.example.com", "/en/1", "www.example.com/en/"),
        "x://b.example.com/en/1": ("b.example.com", "/en/1", "example.com/en/"),
        "x://badexample.com/en/": ("badexample.com", "/en/", "com/"),
        "x://q.net/es/?a": ("q.net", "/es/", "net/es/"), "x://net/fr/": ("net", "/fr/", "net/fr/"),
        "x://q.net/es": ("q.net", "/es", None), "x://h?p=/a://b": ("h", "", None),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    rules = spark.createDataFrame([], "tokens array<bigint>, post bigint")
    got = {r.url: (r.host, r.path, r.rule) for r in U.judge_urls(pages, rules).collect()}
    assert got == cases


def test_mined_rules_match_brute_force(spark, folder):
    urls = [f"https://h{i % 3}.site{i % 4}.org/{'abc'[i % 3]}/{i}" for i in range(240)]
    labelled = spark.createDataFrame(
        [(u, i % 4 == 1 and i % 3 != 0) for i, u in enumerate(urls)] + [(None, None)],
        "url string, blocked boolean")
    rules = U.mine_rules(labelled, folder)
    held = [(set(r.t), r.blocked) for r in labelled.filter("blocked is not null").select(
        U.url_tokens(F.col("url")).alias("t"), "blocked").collect()]
    tokens = set().union(*(t for t, _ in held))
    good = []
    for n in range(1, 5):
        for combo in itertools.combinations(sorted(tokens), n):
            hit = [b for t, b in held if t.issuperset(combo)]
            if sum(hit) >= 10 and sum(hit) / len(hit) >= 0.8 and not any(
                    g < set(combo) for g in good):
                good.append(set(combo))
    assert sorted(map(sorted, good)) == sorted(sorted(r.tokens) for r in rules.collect())
    pages = labelled.withColumn("page_id", F.lit(1).cast("long")).withColumn("verdict", F.lit(3))
    for r in U.judge_urls(pages, rules).collect():
        assert r.verdict == ("block" if r.blocked else "allow")


def test_wide_pages_give_the_same_rules(spark, folder):
    """FP-growth and growth by token find the same rules; equal pages beyond COPIES count."""
    urls = [(f"https://{'ab'[i % 2]}.site{i % 5}.org/{'xyz'[i % 3]}/{'uv'[i % 4 // 2]}?q={i % 7}",
             i % 2 == 0 and i % 3 == 0 and i % 7 < 2 or i % 5 == 1 and i % 7 == 3) for i in range(3_000)]
    urls += [("https://hot.org/in/all", i % 2 == 0) for i in range(2_500)]
    labelled = spark.createDataFrame(urls, "url string, blocked boolean")
    mined, grown = ([(sorted(r.tokens), r.post, r.confidence, r.n) for r in U.mine_rules(
        labelled, f"{folder}/{widest}", widest=widest).collect()] for widest in (99, 0))
    assert sorted(mined) == sorted(grown) and max(len(t) for t, *_ in mined) > 2


def test_odd_rows_of_the_query(spark, tmp_path):
    """No pages, and pages with clashing columns, NULLs, repeats and a very long URL."""
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    odd = [(1, "http://example.com/en/a", "h"), (1, "http://example.com/en/a", "h"),
           (2, None, None), (None, "", "x"), (3, "http://l.org/" + "s/" * 20_000, "h")]
    for name, data in (("none", []), ("odd", odd)):
        where = f"{tmp_path}/{name}"
        labels.write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame(data, "page_id long, url string, host string").write.parquet(
            f"{where}/pages.parquet")
        got = U.op8(spark, where).collect()
        assert len(got) == len(data)
        assert all(r.verdict == ("block" if r.page_id == 1 else "allow") for r in got)


def test_no_labels_no_rules(spark, folder):
    none = spark.createDataFrame([], "url string, blocked boolean")
    rules = U.mine_rules(none, folder)
    assert rules.count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)],
                                  "page_id long, url string")
    assert [r.verdict for r in U.judge_urls(pages, rules).collect()] == ["allow"] * 3


def test_rules_from_every_part_of_the_url(spark, folder):
    """Pages told apart only by a late segment, a second parameter, a value or a host's suffix."""
    marks = {
        "late": ("https://h{i}.org/a/b/{i}/bad/x", "https://h{i}.org/a/b/{i}/fine/x"),
        "second": ("https://h{i}.org/a?page={i}&bad=1", "https://h{i}.org/a?page={i}&ref=1"),
        "value": ("https://h{i}.org/a?to=bad", "https://h{i}.org/a?to=fine"),
        "suffix": ("https://h{i}.s{i}.bad.co.uk/", "https://h{i}.s{i}.fine.co.uk/"),
    }
    many = "/".join(f"s{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    for name, (bad, good) in marks.items():
        urls = [(bad.format(i=chr(97 + i)), True) for i in range(20)]
        urls += [(good.format(i=chr(97 + i)), False) for i in range(20)]
        urls += [(f"https://long.org/{many}?{many.replace('/', '&')}", i % 2 == 0) for i in range(24)]
        labelled = spark.createDataFrame(urls, "url string, blocked boolean")
        rules = U.mine_rules(labelled, f"{folder}/{name}")
        verdicts = {r.url: r.verdict for r in U.judge_urls(
            labelled.withColumn("page_id", F.lit(1)), rules).collect()}
        for url, blocked in urls[:40]:
            assert verdicts[url] == ("block" if blocked else "allow"), url


def test_support_does_not_grow_with_the_pages(spark, folder):
    """Ten blocked pages of one host are a rule among 5,000 pages too."""
    urls = [(f"https://bad.org/{i}", True) for i in range(10)]
    urls += [(f"https://h{i % 700}.net/{i}", i % 3 == 0) for i in range(4_990)]
    labelled = spark.createDataFrame(urls, "url string, blocked boolean")
    rules = U.mine_rules(labelled, folder)
    assert "https://bad.org/3" in {r.url for r in U.match_rules(labelled, rules).collect()}
