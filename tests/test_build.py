import os

from aerolake.plans.build import SILVER, build_lake
from aerolake.session import local_path

from .conftest import SF_SMALL


def test_build_lake_layout_and_statistics(spark, tmpdir_path):
    out = build_lake(spark, SF_SMALL, tmpdir_path + "/lake")
    fct_dir = local_path(out.path(SILVER, "fct_pollution"))
    parts = [d for d in os.listdir(fct_dir) if d.startswith("date_month=")]
    assert parts == ["date_month=202401"]
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {out.db}.dim_calendar").collect()
    assert any(r.col_name == "Statistics" and "rows" in r.data_type for r in stats)
    col = spark.sql(f"DESCRIBE TABLE EXTENDED {out.db}.dim_calendar date_int").collect()
    assert any(r.info_name == "distinct_count" for r in col)
    # layers are written tables: gold reads back with the expected rows
    assert out.read("agg_pollution_monthly").count() > 0
    cal = [r.date_int for r in out.read("dim_calendar").collect()]
    assert cal == sorted(cal)
    # the insert-only merge of weather locations adds nothing on a rerun
    from aerolake.operators.dims import merge_insert_only
    from aerolake.plans.model import Lake

    wl = Lake(spark, SF_SMALL).dim_weather_locations
    assert merge_insert_only(spark, wl, out.path(SILVER, "dim_weather_locations"), ["location_id"]) == 0
