"""Split a date range into request periods bounded by calendar quarter ends.

The range [date_from, date_to] is cut after every quarter end q with
date_from < q <= date_to; the first and the last period may be partial.
A quarter end equal to date_from does not cut (the first period then
starts on that day), and an empty list is produced when date_to is before
date_from.  All work is array expressions on the row, so splitting needs
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_periods(date_from: Column, date_to: Column) -> Column:
    """ARRAY<STRUCT<period_from DATE, period_to DATE>> for each row."""
    f = date_from.cast("date")
    t = date_to.cast("date")
    quarter_starts = F.sequence(F.trunc(f, "quarter"), F.trunc(t, "quarter"),
                                F.expr("INTERVAL 3 MONTHS"))
    quarter_ends = F.transform(quarter_starts, lambda s: F.last_day(F.add_months(s, 2)))
    cuts = F.filter(quarter_ends, lambda q: (q > f) & (q <= t))
    bounds = F.concat(F.array(F.date_sub(f, 1)), cuts)
    bounds = F.when(F.element_at(bounds, -1) == t, bounds).otherwise(F.concat(bounds, F.array(t)))
    pairs = F.transform(
        F.sequence(F.lit(2), F.size(bounds)),
        lambda i: F.struct(F.date_add(F.element_at(bounds, i - 1), 1).alias("period_from"),
                           F.element_at(bounds, i).alias("period_to")),
    )
    empty = F.array().cast("array<struct<period_from:date,period_to:date>>")
    return F.when(t >= f, pairs).otherwise(empty)


def chunk_name(location_id: Column, sensor_id: Column, location_name: Column,
               period_from: Column, period_to: Column) -> Column:
    """Landing chunk name ``{location}_{sensor}_{name}_{from}_{to}``.

    Spaces in the location name become hyphens so the name stays one token;
    a missing part is left empty so every token keeps its position.
    """
    parts = [location_id.cast("string"), sensor_id.cast("string"),
             F.translate(location_name, " ", "-"),
             F.date_format(period_from, "yyyy-MM-dd"), F.date_format(period_to, "yyyy-MM-dd")]
    return F.concat_ws("_", *[F.coalesce(p, F.lit("")) for p in parts])


def page_file_name(chunk: Column, page: Column) -> Column:
    return F.concat(chunk, F.lit("_page"), page.cast("string"), F.lit(".json"))
