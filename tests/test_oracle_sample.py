"""A sample of registered jobs against their DuckDB oracles on the smallest tables
(the full set runs in tools/check_oracle.py and in the driver's gate)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from fleetscope.plans.catalog import all_specs
import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from fleetscope.sources.fixtures import BASE_TABLES  # noqa: E402

SAMPLE = ["c1_counter_delta", "c5_hourly_profile", "c10_io_function_profile", "c14_top_statements",
          "d2_data_type_matrix", "d7_constraint_matrix", "d17_lob_sizing", "d21_source_code_metrics",
          "e0_readiness_report", "f0_validation_findings", "f25_validation_summary", "g2_apply_mask",
          "g8_mask_file_name", "a8_collection_completeness", "i3_stream_counter_delta"]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, sf_small, duck, name):
    df = entry.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, rows) == rows_of(res.columns, res.fetchall())


def test_every_query_has_a_callable_and_most_have_oracles():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 150
    assert set(o) <= set(q)
    # of the library's own jobs; queries of optional subpackages have tests of their own
    assert len(set(all_specs()) - set(o)) <= 3


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
