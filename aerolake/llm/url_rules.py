"""URL filter: association rules mined from labelled pages, and fixed host rules.

FP-growth finds combinations of URL tokens that are frequent among labelled
pages, with the label as one more item.  A combination whose pages are blocked
with enough confidence, on enough pages, is a rule; one that holds a smaller
rule is pruned.  Rules are posted under their rarest token; a URL looks up its
tokens in that index and is blocked if it holds all tokens of a rule found.

The whole URL is tokenised, so a page may hold many tokens, and FP-growth's
list of frequent sets doubles with each of them.  Tokens that cannot change it
are taken out first, and no rule is lost by that: those on too few blocked
pages, those that are rules alone, those on every page (the rest of a set has
the same pages), and all but one of the tokens that stand on exactly the same
pages; rules are written out for the others afterwards.  Where a page still
holds more than ``WIDEST`` items, the same rules are grown token by token from
those sets only that can be or become a rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.store import materialise, run_folder

# Host, path and action of the rules given.
HOST_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"))

WIDEST = 16  # items of one page whose subsets FP-growth may list
BLOCKED = 0  # the item that blocked pages hold
COPIES = 1000  # pages of equal items that are written out at once


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z in lower case; empty for NULL or without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0),
                       upper, upper.lower())


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def host_rule(host: Column, path: Column, rules=HOST_RULES) -> Column:
    """struct<size, rule, action> of the longest fitting rule, or NULL."""
    fits = F.array(*(F.when(
        ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
        F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                 F.lit(action).alias("action"))) for h, p, action in rules))
    return F.array_max(F.filter(fits, lambda r: r.isNotNull()))


def url_tokens(url: Column) -> Column:
    """Hashes of the distinct tokens of a URL: scheme, all suffixes of the host,
    every path segment (anywhere, and in its place), the path's depth and file
    end, every parameter's name and name with value, and the fragment.  Digits
    in path segments count as ``0``; values stand as they are and so as well."""
    url = F.coalesce(url, F.lit(""))
    where, way = host(url), path(url)
    names = F.split(where, r"\.")
    segments = F.split(F.regexp_replace(way, "[0-9]+", "0"), "/")
    pairs = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "[&;]")
    fragment = F.regexp_extract(url, "#(.*)", 1)

    def named(kind, values):
        return F.transform(values, lambda v: F.when(v != "", F.xxhash64(F.lit(kind), v)))

    tokens = F.concat(
        named("scheme", F.array(F.regexp_extract(url, "^([^:]*)://", 1))),
        named("host", F.transform(names, lambda _, i: F.array_join(
            F.slice(names, i + 1, F.size(names)), "."))),
        named("segment", segments),
        F.transform(segments, lambda v, i: F.when(v != "", F.xxhash64(F.lit("place"), i, v))),
        named("depth", F.array((F.size(segments) - 1).cast("string"))),
        named("end", F.array(F.regexp_extract(way, r"\.[A-Za-z0-9]{1,8}$", 0))),
        named("name", F.transform(pairs, lambda v: F.regexp_extract(v, "^[^=]*", 0))),
        named("pair", pairs),
        named("shape", F.transform(pairs, lambda v: F.regexp_replace(v, "[0-9]+", "0"))),
        named("fragment", F.array(F.regexp_extract(fragment, "^[^=]*", 0))),
        named("fragment", F.array(fragment)))
    return F.array_distinct(F.filter(tokens, lambda t: t.isNotNull()))


def mine_rules(labelled: DataFrame, folder: str, min_pages: int = 10,
               min_confidence: float = 0.8, widest: int = WIDEST) -> DataFrame:
    """Rules (tokens, post, confidence, n) from ``labelled`` (url, blocked).

    A rule holds for at least ``min_pages`` blocked pages, however many pages
    there are, and ``min_confidence`` of the pages that hold its tokens are
    blocked.  Rows without a label are ignored; no rows, no rules.
    """
    pages = materialise(
        labelled.filter("blocked is not null")
        .select(F.sort_array(url_tokens(F.col("url"))).alias("held"), "blocked")
        .groupBy("held").agg(F.count("*").alias("n"), F.count_if("blocked").alias("b"))
        .withColumn("page", F.monotonically_increasing_id()), f"{folder}/labelled")
    n_pages = pages.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    places = pages.select("page", "n", "b", F.explode("held").alias("item"))
    # Which pages hold a token, as two sums without order.
    same = [F.bit_xor(F.xxhash64(F.lit(salt), "page")) for salt in "ab"]
    single = materialise(
        places.groupBy("item").agg(F.sum("n").alias("all"), F.sum("b").alias("freq"),
                                   same[0].alias("one"), same[1].alias("two"))
        .filter(F.col("freq") >= min_pages), f"{folder}/single")
    sure = (F.col("freq") / F.col("all")) >= min_confidence
    growing = single.filter(~sure & (F.col("all") < n_pages))
    kind = ["one", "two", "all", "freq"]
    members = materialise(growing.join(growing.groupBy(*kind).agg(F.min("item").alias("of")), kind)
                          .select("item", "of"), f"{folder}/members")
    # Pages that hold the same of the tokens that can grow are one row.
    held = materialise(
        places.join(members.filter("item = of").select("item"), "item")
        .groupBy("page").agg(F.sort_array(F.collect_list("item")).alias("held"),
                             F.first("n").alias("n"), F.first("b").alias("b"))
        .groupBy("held").agg(F.sum("n").alias("n"), F.sum("b").alias("b")), f"{folder}/held")
    n_held, wide = held.agg(F.coalesce(F.sum("n"), F.lit(0)),
                            F.coalesce(F.max(F.size("held")), F.lit(0))).first()
    alive = single.join(members.filter("item = of").select("item"), "item", "left_semi").select(
        F.array("item").alias("items"), "all", "freq")
    if not n_held:
        found = []
    elif wide <= widest:
        found = _mined(held, n_held, alive, sure, folder, min_pages)
    else:
        found = _grown(held, alive, sure, folder, min_pages)
    rules = reduce(DataFrame.unionByName, [
        single.filter(sure).select(F.array("item").alias("items"), "all", "freq"),
        *(_written_out(sets, size, members) for size, sets in enumerate(found, 2))])
    posted = (rules.select("items", F.explode("items").alias("item"))
              .join(single.select("item", "all"), "item")
              .groupBy("items").agg(F.min_by("item", F.struct("all", "item")).alias("post")))
    return materialise(
        rules.join(posted, "items").select(
            F.col("items").alias("tokens"), "post", (F.col("freq") / F.col("all")).alias("confidence"),
            F.col("freq").alias("n")), f"{folder}/rules")


def _mined(held: DataFrame, n_held: int, alive: DataFrame, sure: Column, folder: str,
           min_pages: int) -> list[DataFrame]:
    """The rules of 2, 3, ... items, from the frequent sets of FP-growth."""
    # One row for each page; those of one frequent set are spread over tasks.
    some = F.col("at") * COPIES
    pages = (held.withColumn("at", F.explode(F.expr(f"sequence(0, (n - 1) div {COPIES})")))
             .repartition(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                          "held", "at")
             .withColumn("row", F.explode(F.sequence(some, F.least(some + COPIES, "n") - 1)))
             .select(F.when(F.col("row") < F.col("b"), F.array_append("held", F.lit(BLOCKED)))
                     .otherwise(F.col("held")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / n_held).fit(pages)
    sets = materialise(model.freqItemsets.select(
        F.sort_array(F.array_remove("items", BLOCKED)).alias("items"), "freq",
        F.array_contains("items", F.lit(BLOCKED).cast("long")).alias("blocked")), f"{folder}/frequent")
    counted = materialise(
        sets.filter("blocked").select("items", "freq").join(
            sets.filter("not blocked").select("items", F.col("freq").alias("all")), "items"),
        f"{folder}/counted")
    found, size = [], 1
    while not alive.isEmpty():
        size += 1
        kept = _unpruned(counted.filter(F.size("items") == size), alive, size, f"{folder}/sets-{size}")
        found.append(kept.filter(sure))
        alive = kept.filter(~sure)
    return found


def _grown(held: DataFrame, alive: DataFrame, sure: Column, folder: str,
           min_pages: int) -> list[DataFrame]:
    """The rules of 2, 3, ... items, by one more token a turn."""
    places = held.select("held", "n", "b", F.explode("held").alias("item")).select(
        "held", "n", "b", F.array("item").alias("items"))
    found, size = [], 1
    while not alive.isEmpty():
        size += 1
        grown = places.select("n", "b", "held", "items", F.explode(F.filter(
            "held", lambda t: t > F.element_at("items", -1))).alias("item")).select(
            "n", "b", "held", F.concat("items", F.array("item")).alias("items"))
        sets = materialise(
            grown.groupBy("items").agg(F.sum("n").alias("all"), F.sum("b").alias("freq"))
            .filter(F.col("freq") >= min_pages), f"{folder}/counted-{size}")
        kept = _unpruned(sets, alive, size, f"{folder}/sets-{size}")
        found.append(kept.filter(sure))
        alive = kept.filter(~sure)
        places = materialise(grown.join(alive.select("items"), "items", "left_semi"),
                             f"{folder}/places-{size}")
    return found


def _unpruned(sets: DataFrame, alive: DataFrame, size: int, path: str) -> DataFrame:
    """The ``sets`` (items, all, freq) of ``size`` items whose smaller sets all are in
    ``alive``: none of them is a rule, and each is on more pages."""
    parts = sets.select("items", "all", "freq", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter(
            F.col("items"), lambda t, at: at != i))).alias("part"))
    return materialise(
        parts.join(alive.select(F.col("items").alias("part"), F.col("all").alias("wide")), "part")
        .groupBy("items").agg(F.first("all").alias("all"), F.first("freq").alias("freq"),
                              F.count("*").alias("parts"), F.min("wide").alias("wide"))
        .filter((F.col("parts") == size) & (F.col("wide") > F.col("all")))
        .select("items", "all", "freq"), path)


def _written_out(sets: DataFrame, size: int, members: DataFrame) -> DataFrame:
    """``sets`` with every choice of tokens that stand on the same pages."""
    for at in range(size):
        sets = (sets.withColumn("of", F.col("items")[at]).join(members, "of")
                .withColumn("items", F.transform(
                    "items", lambda t, i: F.when(i == at, F.col("item")).otherwise(t)))
                .drop("of", "item"))
    return sets.select(F.sort_array("items").alias("items"), "all", "freq")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct values of ``url`` that hold all tokens of a rule."""
    held = url_tokens(F.col("url"))
    return (urls.select("url").filter("url is not null").distinct()
            .select("url", F.explode(held).alias("post"))
            .join(rules.select("post", "tokens"), "post")
            .filter(F.size(F.array_except("tokens", held)) == 0).select("url").distinct())


def judge_urls(pages: DataFrame, rules: DataFrame, host_rules=HOST_RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are
    replaced).  The longest host rule decides; without one, a mined rule
    blocks.  NULL URLs have an empty host and path and are allowed."""
    url = F.col("url")
    hit = match_rules(pages, rules).withColumn("_mined", F.lit(True))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_mined")]
    judged = (pages.select(*kept).join(hit, "url", "left")
              .withColumn("host", host(url)).withColumn("path", path(url))
              .withColumn("_rule", host_rule(F.col("host"), F.col("path"), host_rules)))
    return judged.select(*kept, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(
        F.col("_rule.action"), F.when(F.col("_mined"), "block"), F.lit("allow")).alias("verdict"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked) of the pages that have a label: poor or toxic is blocked."""
    verdict = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("page_id"))
               .agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked")))
    return pages.select("page_id", "url").join(verdict, "page_id").select("url", "blocked")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = mine_rules(labelled_urls(pages, labels), run_folder(spark, "urls"))
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")
