import pytest
from pyspark.sql import types as T

from lanecost.operators import marts as M
from lanecost.operators import model as Mo


def test_conform_landing_matches_names_ignoring_case(spark):
    df = spark.createDataFrame([("x", 1, "2016_2Q", "extra")],
                               "CORRIDOR string, Cc_Number int, Period string, junk string")
    schema = T.StructType([T.StructField("corridor", T.StringType()),
                           T.StructField("cc_number", T.IntegerType()),
                           T.StructField("period", T.StringType()),
                           T.StructField("firm", T.StringType())])
    out = Mo.conform_landing(df, schema)
    assert out.columns == ["corridor", "cc_number", "period", "firm"]
    assert tuple(out.first()) == ("x", 1, "2016_2Q", None)


def test_codes_remap_and_currency_zones(spark):
    df = spark.createDataFrame([("KSVDEU", "EUR"), ("SENFRA", "CFA"), ("CMRFRA", "CFA"),
                                ("USAMEX", "CFA")], "corridor string, lcu_code string")
    out = Mo.resolve_currency(Mo.corridor_codes(df))
    got = [(r["sending_country_code"], r["receiving_country_code"], r["lcu_code_resolved"])
           for r in out.collect()]
    assert got == [("XKX", "DEU", "EUR"), ("SEN", "FRA", "XOF"), ("CMR", "FRA", "XAF"),
                   ("USA", "MEX", "CFA")]


def dims(spark, countries=(("USA", "N America", "High"), ("MEX", "LatAm", "Upper"))):
    c = spark.createDataFrame([(k, k.title(), r, i) for k, r, i in countries],
                              "country_iso3 string, country_name string, region string, income_group string")
    cur = spark.createDataFrame([("USD", "Dollar")], "currency_code string, currency_name string")
    return c, cur


def test_enrichment_keeps_rows_and_leaves_unmatched_null(spark):
    df = spark.createDataFrame([("USAMEX", "USD"), ("USAZZZ", "XXX"), ("USAMEX", "USD")],
                               "corridor string, lcu_code string")
    c, cur = dims(spark)
    out = Mo.enrich_corridor(df, c, cur)
    assert out.count() == 3
    rows = sorted(out.collect(), key=lambda r: r["receiving_country_code"])
    assert rows[0]["destination_region_current"] == "LatAm" and rows[0]["sending_currency_name"] == "Dollar"
    assert rows[2]["destination_region_current"] is None and rows[2]["sending_currency_name"] is None
    assert "lcu_code" not in out.columns and "lcu_code_raw" in out.columns
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_enrichment_rejects_duplicate_dim_keys(spark):
    df = spark.createDataFrame([("USAMEX", "USD")], "corridor string, lcu_code string")
    c, cur = dims(spark, (("USA", "a", "b"), ("USA", "c", "d")))
    with pytest.raises(ValueError, match="not unique"):
        Mo.enrich_corridor(df, c, cur)


def flagged_frame(spark):
    rows = [("yes", 10.0, 200.0, 2.0, 7.0),   # 5 + 2 = 7 -> no mismatch
            (" No ", 10.0, 0.0, 2.0, 7.0),    # zero amount -> fee null
            (None, 10.0, 200.0, 2.0, None),   # total missing
            ("maybe", 10.0, 200.0, 2.0, 7.5)]  # mismatch 0.5
    df = spark.createDataFrame(rows, "transparent string, lcu_fee double, lcu_amount double, "
                                     "fx_margin double, total_cost_pct double")
    return Mo.flag_transparency(Mo.cost_decompose(df))


def test_decompose_and_flags_three_valued(spark):
    rows = flagged_frame(spark).collect()
    assert [r["fee_cost_pct"] for r in rows] == [5.0, None, 5.0, 5.0]
    assert [r["is_disclosed_transparent"] for r in rows] == [True, False, None, None]
    assert [r["cost_mismatch_flag"] for r in rows] == [False, None, None, True]
    assert [r["cost_components_missing"] for r in rows] == [False, True, False, False]
    assert [r["transparency_flag_count"] for r in rows] == [0, 1, 1, 1]


def test_scorecard_counts_null_disclosure_as_not_disclosed(spark):
    df = spark.createDataFrame(
        [("F", "Bank", "AB", 2016, 2, True, False, False, True, 0),
         ("F", "Bank", "AC", 2016, 2, None, False, False, None, 0),
         ("F", "Bank", "AB", None, 3, False, True, False, False, 1)],
        "firm string, firm_type string, corridor string, period_year int, period_quarter int, "
        "is_disclosed_transparent boolean, total_cost_pct_missing boolean, "
        "cost_components_missing boolean, cost_mismatch_flag boolean, transparency_flag_count int")
    r = M.transparency_scorecard(df, min_sample=3).first()
    assert r["num_corridors"] == 2 and r["num_periods"] == 1  # the null-year row is skipped
    assert abs(r["pct_disclosed_transparent"] - 100 / 3) < 1e-9
    assert r["num_cost_mismatch_flagged"] == 1 and r["num_cost_mismatch_evaluable"] == 2
    assert r["pct_cost_mismatch_flagged"] == 50.0 and r["has_sufficient_sample"] is True


def test_spotlight_role_sending_wins(spark):
    cols = list(M.CHANNEL_COLUMNS)
    base = {c: None for c in cols}
    rows = []
    for s, r in (("KEN", "UGA"), ("USA", "KEN"), ("KEN", "KEN"), ("USA", "MEX")):
        d = dict(base, sending_country_code=s, receiving_country_code=r, firm="f", corridor=s + r)
        rows.append(tuple(d[c] for c in cols))
    schema = ", ".join(f"{c} string" for c in cols)
    out = M.spotlight(spark.createDataFrame(rows, schema), "KEN").collect()
    assert sorted((r["corridor"], r["spotlight_role"]) for r in out) == [
        ("KENKEN", "sending"), ("KENUGA", "sending"), ("USAKEN", "receiving")]
