"""Secrets in texts: three fixed patterns, and a sliding-window entropy test.

All of it is column expressions within one row: no shuffle, no Python worker.
Positions are code points, ends exclusive.  The place of a match follows from
the lengths of what lies between matches, summed in blocks.

The entropy test looks at every run of token characters that is ``window`` or
more long.  A run belongs to the narrowest of three character classes; as the
window moves by one character, the count of the entering and of the leaving
one among those kept changes the sum of n*log2(n), held in millionths so that
no rounding drifts.  The span goes from the first window above the class's
limit to the end of the last.  Runs are left out if the allow-list knows every
part of them; a known part beside a secret hides nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The patterns of the three base kinds, and the least length of
# the second group of the first.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 6
# A greedy run that is too short fails from each later start as well.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

# Classes from narrow to wide: pattern of the whole run, least bits a character.
CLASSES = (("[0-9a-fA-F]+", 3.0), ("[A-Z0-9]+", 3.4), ("[A-Za-z0-9+/_=-]+", 3.7))
WINDOW = 20
# Runs that are no secrets: every part between / _ = + - is a word, a number, a
# short number with letters, a time, a placeholder or counts up, or the parts are
# a UUID.  One part of another shape, and the whole run is looked at.


def _counting(signs: str, least: int) -> str:
    """``signs`` from the first on, ``least`` of them or more."""
    tail = ""
    for sign in reversed(signs[least:]):
        tail = f"(?:{sign}{tail})?"
    return signs[:least] + tail


_CONSONANT = "(?i:[bcdfghjklmnpqrstvwxz])"
_WORD = ("(?:[a-z]{1,19}|[A-Z]{1,19}|[A-Z]{0,5}[a-z]{2,19}(?:[A-Z][a-z]{2,18}){0,5}[A-Z]{0,4})"
         "[0-9]{0,4}")
_COUNT = "(?:%s)" % "|".join((
    "0?1234567890?", _counting("abcdefghijklmnopqrstuvwxyz", 6),
    _counting("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 6)))
_PARTS = (
    "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "[0-9]+", "[0-9]{8}[Tt][0-9]{4,6}[Zz]?",
    f"(?![A-Za-z]*{_CONSONANT}{{6}}){_WORD}", "[a-z]{1,2}[0-9]{1,3}[a-z]?", "[0-9]{1,3}[a-z]{1,2}",
    "[A-Za-z0-9]{0,6}(?:(?i:example|sample|placeholder|changeme|dummy)|[xX]{4,64})[A-Za-z0-9]{0,6}",
    f"[A-Za-z0-9]{{0,3}}{_COUNT}{{1,9}}[A-Za-z0-9]{{0,3}}")
# Possessive, so that long runs need no deep stack.
ALLOWED = ("(?:[/_=+-]|(?:%s)(?![A-Za-z0-9]))*+" % "|".join(_PARTS),)
MICRO = 1_000_000
BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(sizes: Column) -> Column:
    """The sum of all earlier entries, for each entry; in blocks, so that the
    work does not grow with the square of their number."""
    def scan(values):
        return F.aggregate(values, F.array(F.lit(0).cast("long")), lambda done, x: F.concat(
            done, F.array(F.element_at(done, -1) + x)))

    def total(values):
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    def joined(blocks):
        return _let(scan(F.transform(blocks, total)), lambda base: F.flatten(F.transform(
            blocks, lambda block, i: F.transform(
                F.slice(scan(block), F.lit(1), F.size(block)), lambda s: s + F.get(base, i)))))

    return _let(sizes, lambda s: F.when(F.size(s) == 0, F.array().cast("array<long>")).otherwise(
        _let(F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(s, b * BLOCK + 1, F.lit(BLOCK))), joined)))


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost matches that do not overlap."""
    def placed(gaps, hits):
        sizes = F.transform(hits, lambda h, i: (
            F.char_length(h) + F.char_length(F.get(gaps, i))).cast("long"))
        return _let(_before(sizes), lambda before: F.transform(hits, lambda h, i: F.struct(
            (F.get(before, i) + F.char_length(F.get(gaps, i))).alias("start"),
            (F.get(before, i) + F.char_length(F.get(gaps, i)) + F.char_length(h)).alias("end"),
            h.alias("hit"))))

    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return F.when(text.rlike(pattern), _let(F.split(text, pattern, -1), lambda gaps: _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: placed(gaps, hits)))).otherwise(none)


def _spans(matches: Column, rank: int) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))


def _hot(run: Column, window: int) -> Column:
    """struct<first, last>: places in ``run`` of the first and the last window
    whose entropy reaches the limit of the run's class; -1 if none does."""
    g = F.array(*(F.lit(0 if n < 2 else round(n * math.log2(n) * MICRO)).cast("long")
                  for n in range(window + 1)))
    limit = F.lit(None).cast("long")
    for pattern, bits in reversed(CLASSES):
        # Bits are enough while the sum of n*log2(n) is at most this.
        most = round(window * (math.log2(window) - bits) * MICRO)
        limit = F.when(run.rlike(f"^{pattern}$"), F.lit(most)).otherwise(limit)

    def slide(chars, most):
        head = F.slice(chars, 1, window)
        begin = F.aggregate(F.array_distinct(head), F.lit(0).cast("long"), lambda a, c: (
            a + F.get(g, F.size(F.filter(head, lambda x: x == c)))))

        def seen(total, at, first, last):
            hot = total <= most
            return F.struct(total.alias("total"),
                            F.when(hot & (first < 0), at).otherwise(first).alias("first"),
                            F.when(hot, at).otherwise(last).alias("last"))

        def step(state, at):  # the window now begins at ``at`` (0-based)
            kept = F.slice(chars, at + 1, F.lit(window - 1))
            out, new = F.get(chars, at - 1), F.get(chars, at + window - 1)
            gone = F.size(F.filter(kept, lambda x: x == out))
            had = F.size(F.filter(kept, lambda x: x == new))
            return _let(state["total"] - F.get(g, gone + 1) + F.get(g, gone)
                        + F.get(g, had + 1) - F.get(g, had),
                        lambda total: seen(total, at, state["first"], state["last"]))

        none = F.lit(-1)
        moves = F.when(F.size(chars) > window, F.sequence(
            F.lit(1), F.size(chars) - window)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(moves, _let(begin, lambda b: seen(b, F.lit(0), none, none)), step)

    return _let(F.split(run, "", -1), lambda chars: _let(limit, lambda most: slide(chars, most)))


def _entropy(text: Column, window: int) -> Column:
    runs = F.filter(_matches(text, "[A-Za-z0-9+/_=-]{%d,}" % window), lambda m: ~m["hit"].rlike(
        "^(?:" + "|".join(ALLOWED) + ")$"))
    marked = F.transform(runs, lambda m: F.struct(
        m["start"].alias("start"), _hot(m["hit"], window).alias("hot")))
    return F.transform(F.filter(marked, lambda m: m["hot"]["first"] >= 0), lambda m: F.struct(
        (m["start"] + m["hot"]["first"]).alias("start"), F.lit(3).alias("rank"),
        (m["start"] + m["hot"]["last"] + window).alias("end")))


def find_secrets(docs: DataFrame, text_column: str = "text", output: str = "secrets",
                 window: int = WINDOW) -> DataFrame:
    """``docs`` with ``output``: its secrets as array<struct<start, rank, end>>
    in order of start and kind (``rank`` is the kind's place in ``KINDS``).

    A NULL text counts as empty and has none.  Every row is judged by its own
    text, so repeated rows and NULL ids keep their rows; all columns stay, and
    one already named ``output`` is replaced.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    assign = F.filter(_matches(text, ASSIGN), lambda m: F.char_length(
        F.regexp_extract(m["hit"], ASSIGN, 2)) >= ASSIGN_VALUE)
    return docs.withColumn(output, F.sort_array(F.concat(
        _spans(assign, 0), _spans(_matches(text, ACCESS), 1), _spans(_matches(text, HEX), 2),
        _entropy(text, window))))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; overlapping
    spans become one.  A NULL text stays NULL; columns are those of ``docs``."""
    def merge(done, s):
        last = F.element_at(done, -1)
        meets = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= s["start"])
        grown = F.struct(last["start"].alias("start"),
                         F.greatest(last["end"], s["end"]).alias("end"))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.greatest(
            F.size(done) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(done, F.array(own)))

    def blank(text, spans):
        parts = F.transform(spans, lambda s, i: F.concat(F.substr(
            text, (F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1).cast("int"),
            (s["start"] - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))).cast("int")),
            F.lit(mark)))
        rest = F.substr(text, (F.element_at(spans, -1)["end"] + 1).cast("int"))
        return F.concat(F.array_join(parts, ""), rest)

    column = "_secrets"
    while column in docs.columns:
        column += "_"
    merged = F.aggregate(F.col(column), F.array().cast("array<struct<start:bigint,end:bigint>>"),
                         merge)
    text = F.col(text_column)
    return find_secrets(docs, text_column, column).withColumn(text_column, F.when(
        F.size(column) == 0, text).otherwise(
        _let(merged, lambda spans: blank(text, spans)))).select(*docs.columns)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the base kinds, their digest, all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = F.col("secrets")

    def count(rank):
        return F.size(F.filter(found, lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return find_secrets(docs).select(
        "doc_id", *counts,
        F.sha2(span_text(F.filter(found, lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        span_text(found).alias("spans"))
