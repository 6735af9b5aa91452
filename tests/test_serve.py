from lanecost.functions.expr import fmt_count, fmt_pct
from lanecost.operators import serve as S
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st


def names(spark):
    return spark.createDataFrame([("USA", "United States")], "country_iso3 string, country_name string")


def test_weighted_trend_null_value_keeps_weight(spark):
    df = spark.createDataFrame(
        [("USAMEX", "USA", "MEX", 2016, 2, 2.0, 1), ("USAMEX", "USA", "MEX", 2016, 2, None, 3),
         ("USAPHL", "USA", "PHL", 2016, 2, None, 2)],
        "corridor string, sending_country_code string, receiving_country_code string, "
        "period_year int, period_quarter int, avg_total_cost_pct double, num_observations long")
    rows = {r["corridor"]: r for r in S.weighted_trend(df, names(spark)).collect()}
    assert rows["USAMEX"]["avg_total_cost_pct"] == 0.5     # 2*1 / (1+3)
    assert rows["USAPHL"]["avg_total_cost_pct"] == 0.0     # all null -> 0, not null
    assert rows["USAMEX"]["corridor_label"] == "United States → MEX"
    assert rows["USAMEX"]["period_label"] == "2016 Q2" and rows["USAMEX"]["period_sort_key"] == 20162


def test_topk_ties_broken_by_label(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "corridor_label string, n long")
    assert [r[0] for r in S.topk(df, "corridor_label", "n", 3).collect()] == ["c", "a", "b"]


def test_firm_comparison_and_listing(spark):
    df = spark.createDataFrame([("A", "Bank", 30.0, True), ("A", "Bank", None, None),
                                ("B", "MTO", 10.0, False), ("B", "MTO", 12.0, True)],
                               "firm string, firm_type string, total_cost_pct double, "
                               "is_disclosed_transparent boolean")
    rows = S.firm_comparison(df, min_obs=1).collect()
    assert [(r["firm"], r["num_observations"], r["pct_disclosed_transparent"]) for r in rows] == [
        ("B", 2, 50.0), ("A", 1, 100.0)]
    listing = S.top_cost_listing(S.firm_comparison(df, 1), at_least=20).first()["listing"]
    assert listing == "A (n=1)"
    assert S.top_cost_listing(S.firm_comparison(df, 1), at_least=99).first()["listing"] is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=20))
def test_fmt_pct_matches_python_formatting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fmt_pct(F.col("x"))).collect()]
    want = ["–" if v is None else f"{v:.2f}%" for v in values]
    assert got == want


def test_fmt_pct_ties_and_counts(spark):
    df = spark.createDataFrame([(2.675,), (3.125,), (0.125,), (1234567.0,)], "x double")
    assert [r[0] for r in df.select(fmt_pct(F.col("x"))).collect()] == [
        f"{v:.2f}%" for v in (2.675, 3.125, 0.125, 1234567.0)]
    assert [r[0] for r in df.select(fmt_count(F.lit(1234567))).collect()][0] == "1,234,567"
