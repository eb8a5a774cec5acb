"""Named row rules: drop rows failing any rule, and count failures per rule.

A rule is a SQL predicate.  A predicate that evaluates to NULL counts as
failed (the row is dropped), so a missing column value can never slip
through a comparison rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The five rule sets (rule name -> predicate), as the source
# pipeline declares them.
# ---------------------------------------------------------------------------
def _not_null(*columns: str) -> dict[str, str]:
    return {f"{c} is not null": f"{c} IS NOT NULL" for c in columns}


LOCATION_RULES = _not_null("location_id", "name", "city")
PARAMETER_RULES = _not_null("parameter_id", "name")
SENSOR_RULES = _not_null("sensor_id", "location_id", "parameter_id")
MEASUREMENT_RULES = {
    "period interval is 1 hour": "interval = '01:00:00'",
    **_not_null("datetime_from", "value", "location_id", "sensor_id"),
    "value is sensible": "value > 0 AND value < 800",
}
WEATHER_RULES = _not_null("location_id", "datetime", "temperature_2m", "surface_pressure")

RULE_SETS = {
    "locations": LOCATION_RULES,
    "parameters": PARAMETER_RULES,
    "sensors": SENSOR_RULES,
    "measurements": MEASUREMENT_RULES,
    "weather": WEATHER_RULES,
}


def passes(predicate: str) -> Column:
    """TRUE only when the predicate is TRUE (NULL counts as a failure)."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def all_pass(rules: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, (passes(p) for p in rules.values()))


def drop_failing(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep rows that satisfy every rule (expect-all-or-drop).

    The predicates are plain Catalyst expressions, so on a parquet scan the
    null checks and range bounds are pushed into the reader.
    """
    return df.filter(all_pass(rules))


def failure_columns(rules: dict[str, str]) -> list[Column]:
    return [F.count_if(~passes(p)).alias(f"r{i}") for i, p in enumerate(rules.values())]


def count_failing(df: DataFrame, rules: dict[str, str], rule_set: str) -> DataFrame:
    """One row per rule: (rule_set, rule, failed_rows, total_rows).

    A single global aggregate: each task counts its rows (partial
    aggregation), so only one small row per task is shuffled.
    """
    names = list(rules)
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), *failure_columns(rules))
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("failed_rows"))
             for i, n in enumerate(names)]
    return (agg.select("total_rows", F.explode(F.array(*pairs)).alias("p"))
            .select(F.lit(rule_set).alias("rule_set"), F.col("p.rule").alias("rule"),
                    F.col("p.failed_rows").alias("failed_rows"), "total_rows"))


def count_failing_sets(df: DataFrame, sets: list[tuple[str, dict[str, str], str | None]]) -> DataFrame:
    """``count_failing`` of several rule sets over one scan of ``df``.

    ``sets`` holds ``(rule_set, rules, struct)``; a set's columns are the
    top-level columns (``struct`` None) or the fields of struct column
    ``struct``.  Each set's predicates are evaluated in its own projection
    step, where its columns are in scope by their plain names, so two sets
    may use one column name for different things.  All counts then come
    from a single global aggregate.
    """
    structs = [st for _, _, st in sets if st]
    names = [[f"_f{i}_{j}" for j in range(len(rules))] for i, (_, rules, _) in enumerate(sets)]
    flags: list[str] = []
    cur = df
    # top-level sets first, while the top-level columns are still there
    for i in sorted(range(len(sets)), key=lambda i: sets[i][2] is not None):
        _, rules, struct = sets[i]
        scope = cur
        if struct:
            structs.remove(struct)
            scope = cur.select(*flags, *structs, f"{struct}.*")
        cur = scope.select(*flags, *structs,
                           *[passes(p).alias(n) for n, p in zip(names[i], rules.values())])
        flags += names[i]
    agg = cur.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(~F.col(n)).alias(n) for n in flags])
    pairs = [F.struct(F.lit(rule_set).alias("rule_set"), F.lit(rule).alias("rule"),
                      F.col(n).alias("failed_rows"))
             for (rule_set, rules, _), ns in zip(sets, names) for rule, n in zip(rules, ns)]
    return (agg.select("total_rows", F.explode(F.array(*pairs)).alias("p"))
            .select("p.rule_set", "p.rule", "p.failed_rows", "total_rows"))


def observe_failing(df: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """Streaming form: attach per-rule failure counts as observed metrics.

    The counts are reported per micro-batch in ``StreamingQueryProgress``
    (``observedMetrics[name]``), the open-source stand-in for pipeline
    expectation metrics.
    """
    return df.observe(name, *failure_counts(rules))


def failure_counts(rules: dict[str, str]) -> list[Column]:
    """Aggregates: all rows as ``total_rows``, and the failing rows of each rule."""
    return [F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(~passes(p)).alias(n) for n, p in rules.items()]]
