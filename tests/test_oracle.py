"""Each of the library's own queries against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from aerolake.plans.catalog import QUERIES
from aerolake.plans.downloads import DOWNLOAD_QUERIES
from tools.compare import compare_one, open_duckdb

from .conftest import SF_SMALL

STREAMING = {"land_json", "ingest_measurements", "upsert_facts", "ingest_rerun",
             "ingest_locations", "ingest_sensors", "ingest_parameters", "ingest_weather",
             *DOWNLOAD_QUERIES}


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", [k for k in QUERIES if k not in STREAMING])
def test_batch_query_matches_oracle(spark, con, name):
    msgs, n, _ = compare_one(spark, con, SF_SMALL, name, queries()[name], oracle_sql()[name])
    assert not msgs, msgs


@pytest.mark.parametrize("name", ["upsert_facts", "ingest_weather", "ingest_parameters",
                                  "download_files", "lake_rule_metrics", "lake_weather_locations",
                                  "lake_locations", "ingest_inferred"])
def test_stream_query_matches_oracle(spark, con, name):
    msgs, n, _ = compare_one(spark, con, SF_SMALL, name, queries()[name], oracle_sql()[name])
    assert not msgs, msgs


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "avg_value" in df.columns


def test_every_declared_key_and_reference_is_audited(spark):
    keys = {r.table_name for q in ("key_audit", "key_audit_dimensions")
            for r in queries()[q](spark, SF_SMALL).collect()}
    assert keys >= {"fct_pollution", "dim_pollution_locations", "dim_pollution_sensors",
                    "dim_pollution_parameters", "dim_calendar", "dim_time", "dim_weather_locations"}
    links = [r.relation for q in ("orphan_audit", "orphan_audit_dimensions")
             for r in queries()[q](spark, SF_SMALL).collect()]
    assert sum(x.startswith(("fct_", "dim_")) for x in links) == 9 == len(
        {x for x in links if x.startswith(("fct_", "dim_"))})
