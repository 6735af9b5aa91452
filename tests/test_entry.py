"""The driver contract, plus every query against DuckDB on the smallest data."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
FAST = ["corridor_cost_trends", "transparency_scorecard", "dedup_grain_report", "weighted_trend",
        "kpis", "check_suite", "profile_table", "scorecard_view", "top_cost_listing",
        "replace_partition_load", "load_audit", "incremental_period_run", "stream_period_load",
        "flag_duplicates", "serve_views", "write_reports", "scan_guarded", "export_marts",
        "incremental_recovery", "stream_two_files_one_period", "stream_null_period", "run_pipeline",
        "convert_full_history", "dedup_grain_split", "profile_sample"]


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "num_observations" in df.columns


def test_every_query_has_sql():
    import __spark_entry__ as E
    from lanecost.catalog.queries import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared test data not present")
@pytest.mark.parametrize("key", FAST)
def test_query_matches_duckdb(spark, key):
    import __spark_entry__ as E
    from oracle_check import digest, duck, rows_of
    sdf = E.queries()[key](spark, SF)
    s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck(SF).execute(E.oracle_sql()[key])
    cols = [c[0] for c in res.description]
    d_rows = rows_of(cols, res.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert digest(s_rows) == digest(d_rows)
