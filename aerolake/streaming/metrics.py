"""Rule counts of every micro-batch, kept as a table.

A stream observes its rows (``rules.observe_failing``); the counts come with the
progress reports and are appended here once the run has ended.  A batch that ran
twice has two reports, of which the last one counts.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import try_read

SCHEMA = ("stream string, run_id string, batch_id bigint, reported string, rule_set string, "
          "rule string, failed_rows bigint, total_rows bigint")
# Observed under the name of a rule set plus this.
SUFFIX = "_rules"


def report_rows(stream: str, reports: list) -> list[tuple]:
    """One row per rule and batch; batches without input have no counts."""
    out = []
    for report in reports:
        for name, row in (report["observedMetrics"] or {}).items():
            counts = row.asDict() if hasattr(row, "asDict") else dict(row)
            total = counts.pop("total_rows", None)
            if total is None or not report["numInputRows"]:
                continue
            out += [(stream, str(report["runId"]), int(report["batchId"]), str(report["timestamp"]),
                     name.removesuffix(SUFFIX), rule, int(failed), int(total))
                    for rule, failed in counts.items()]
    return out


def append_batch(spark: SparkSession, path: str, stream: str, batch_id: int,
                 counts: dict[str, dict[str, int]]) -> None:
    """Append the counts of one micro-batch from within it, by rule set: what an
    ``Observation`` of ``rules.failure_counts`` holds."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [(stream, "", batch_id, now, rule_set, rule, int(n), int(found["total_rows"]))
            for rule_set, found in counts.items()
            for rule, n in found.items() if rule != "total_rows"]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def append_reports(spark: SparkSession, path: str, stream: str, reports: list) -> None:
    """Append the counts of one run of ``stream`` (a row per rule and batch)."""
    rows = report_rows(stream, reports)
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each batch of each stream."""
    table = try_read(spark, path, SCHEMA)
    if table is None:
        return spark.createDataFrame([], SCHEMA)
    keys = ["stream", "batch_id", "rule_set", "rule"]
    last = F.max_by(F.struct("run_id", "reported", "failed_rows", "total_rows"),
                    F.struct("reported", "run_id")).alias("r")
    return table.groupBy(*keys).agg(last).select(*keys, "r.*")


def totals(reports: DataFrame) -> DataFrame:
    """(rule_set, rule, failed_rows, total_rows) over all batches."""
    return reports.groupBy("rule_set", "rule").agg(
        F.sum("failed_rows").cast("long").alias("failed_rows"),
        F.sum("total_rows").cast("long").alias("total_rows"))
