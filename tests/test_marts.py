"""Exact medians by value ranges against the plain median of each group."""

import collections
import random
import statistics

from lanecost.operators import marts as M
from lanecost.operators import serve as S


def test_median_by_ranges_equals_plain_median(spark):
    rnd = random.Random(5)
    rows = [("hot", None, round(rnd.gauss(5, 4), 2)) for _ in range(600)]      # negative values and ties too
    rows += [(None, n, float(rnd.randrange(-3, 4))) for n in (1, None) for _ in range(7)]
    rows += [("even", 1, 1.0), ("even", 1, 400.25), ("one", 1, 7.5), ("none", 1, None), ("hot", None, None)]
    rows += [("nan", 1, float("nan")), ("nan", 1, float("inf")), ("nan", 1, 2.0)]
    want = collections.defaultdict(list)
    for k1, k2, v in rows:
        if v is not None:
            want[k1, k2].append(v)
    want = {k: statistics.median(v) for k, v in want.items() if k[0] != "nan"}
    want["nan", 1] = float("inf")      # 2, inf, NaN
    df = spark.createDataFrame(rows, "k1 string, k2 int, v double").repartition(7)
    for width in (1.0, 0.25, 1000.0):
        out = M.median_by_ranges(df, ["k1", "k2"], "v", "m", width).collect()
        assert len(out) == len(want)
        assert {(r.k1, r.k2): round(r.m, 9) for r in out} == {k: round(v, 9) if v < 1e9 else v for k, v in want.items()}
    assert M.median_by_ranges(df.limit(0), ["k1", "k2"], "v", "m").collect() == []


def test_high_cost_firms_are_ordered_rows_of_the_listing(spark):
    firms = spark.createDataFrame(
        [("C", "Bank", 3, 9.4999999), ("B", "Bank", 2, 9.5), ("A", "MTO", 1, 9.50000001), ("D", "MTO", 4, 9.4), ("E", "MTO", 5, None)],
        "firm string, firm_type string, num_observations long, avg_total_cost_pct double")
    rows = S.high_cost_firms(firms, 9.5).collect()
    assert [(r.firm, r.avg_total_cost_pct) for r in rows] == [("A", 9.5), ("B", 9.5), ("C", 9.5)]
    assert S.top_cost_listing(firms, 9.5).first().listing == "A (n=1), B (n=2), C (n=3)"


def test_ranges_cut_at_quantiles_follow_the_data(spark):
    rnd = random.Random(11)
    rows = [("tail", rnd.paretovariate(0.3)) for _ in range(901)] + [("tiny", rnd.random() * 1e-9) for _ in range(400)]
    rows += [("ties", float(rnd.choice([1, 1, 1, 2]))) for _ in range(50)] + [("nan", float("nan"))] * 3
    want = collections.defaultdict(list)
    for k, v in rows:
        want[k].append(v)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for pieces in (2, 64):
        got = {r.k: r.m for r in M.median_by_ranges(df, ["k"], "v", "m", pieces=pieces).collect()}
        assert got.pop("nan") != got.get("nan")          # NaN
        assert got == {k: statistics.median(v) for k, v in want.items() if k != "nan"}


def test_groups_of_many_values_take_their_median_by_ranges(spark, monkeypatch):
    rnd = random.Random(3)
    schema = ", ".join(f"{c} string" for c in M.TREND_KEYS) + (
        ", firm string, total_cost_pct double, fee_cost_pct double, fx_margin_pct double, "
        "decomposed_cost_pct double, cost_mismatch_flag boolean")
    def row(corridor, cost):
        return (corridor, *[None] * (len(M.TREND_KEYS) - 1), "F", cost, 1.0, None, 2.0, True)
    rows = [row("hot", rnd.gauss(5, 3)) for _ in range(500)] + [row("hot", None)]
    rows += [row(None, rnd.gauss(9, 1)) for _ in range(300)]
    rows += [row("few", float(rnd.randrange(5))) for _ in range(200)] + [row("none", None)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    want = sorted(map(repr, M.corridor_cost_trends(df, ranged_median=False).collect()))
    asked = []
    plain = M.median_by_ranges
    monkeypatch.setattr(M, "median_by_ranges", lambda d, *a, **k: asked.append(d) or plain(d, *a, **k))
    got = M.corridor_cost_trends(df, max_values=100)
    short = lambda r: repr({k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()})
    assert sorted(map(short, got.collect())) == sorted(map(short, M.corridor_cost_trends(df, ranged_median=False).collect()))
    assert {r[0] for r in asked[-1].select("corridor").distinct().collect()} == {"hot", None}
    few = M.corridor_cost_trends(df)                     # nothing over the default bound
    assert len(asked) == 1 and len(few.collect()) == len(want) == 4
    assert M.corridor_cost_trends(df.limit(0)).collect() == []


def test_no_median_map_is_kept_beside_a_distinct_count(spark):
    """One aggregate with both would keep a map a group and firm."""
    schema = ", ".join(f"{c} string" for c in M.TREND_KEYS) + (
        ", firm string, total_cost_pct double, fee_cost_pct double, fx_margin_pct double, "
        "decomposed_cost_pct double, cost_mismatch_flag boolean")
    rows = [("A", *[None] * (len(M.TREND_KEYS) - 1), firm, cost, 1.0, None, 2.0, None)
            for firm, cost in [("F", 1.0), ("F", 1.0), ("G", 5.0), (None, None)]]
    for ranged in (None, False, True):
        trends = M.corridor_cost_trends(spark.createDataFrame(rows, schema), ranged_median=ranged)
        r = trends.first()
        assert (r.num_observations, r.num_providers, r.median_total_cost_pct) == (4, 2, 1.0)
        for node in trends._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1:]:
            assert not ("percentile" in node.split("\n")[0] and "distinct" in node.split("\n")[0])
