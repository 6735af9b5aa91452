"""Invariants on the derived fixture (sf0.001): nothing is lost or multiplied."""
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared test data not present")


def test_row_conservation(spark):
    from lanecost.catalog import queries as Q
    from lanecost.operators import dedup as D, model as Mo
    from lanecost.operators.splits import split_negative, split_nontransparent
    from lanecost.sources import fixtures as FX

    wide = Q.wide(spark, SF)
    long = Q.long(spark, SF)
    driving = wide.agg(F.count("cc1 denomination amount").alias("a"),
                       F.count("cc2 denomination amount").alias("b")).first()
    assert long.count() == driving["a"] + driving["b"]

    clean, report = D.dedup_grain(long)
    assert clean.count() + report.count() == long.count()

    for split in (split_negative, split_nontransparent):
        ok, bad = split(clean)
        assert ok.count() + bad.count() == clean.count()

    staged = Mo.stage_typed(Mo.conform_landing(clean))
    enriched = Mo.enrich_corridor(staged, FX.country_dim(spark, SF), FX.currency_dim(spark, SF),
                                  FX.CODE_REMAP, FX.CFA_ZONES)
    assert enriched.count() == staged.count() == clean.count()


def test_trend_mart_aggregates_partially(spark):
    from lanecost.catalog import queries as Q
    plan = Q.QUERIES["corridor_cost_trends"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_percentile" in plan
