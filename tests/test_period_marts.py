"""Marts kept by period against a rebuild from all rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lanecost.operators import marts as M
from lanecost.plans.flows import ModelConfig, build_marts
from lanecost.plans.period_marts import STATES, PeriodMarts

CFG = ModelConfig(spotlight_country="KEN", min_sample=4)
TYPES = {c: "string" for c in (*M.TREND_KEYS, *M.CHANNEL_COLUMNS)} | {
    c: "int" for c in ("period_year", "period_quarter", "cc_number", "transparency_flag_count")} | {
    c: "double" for c in ("send_amount", "total_cost_pct", "fee_cost_pct", "fx_margin_pct", "decomposed_cost_pct")} | {
    c: "boolean" for c in ("is_disclosed_transparent", "cost_mismatch_flag", "total_cost_pct_missing",
                           "cost_components_missing")}
SCHEMA = ", ".join(f"{c} {t}" for c, t in TYPES.items())


def rows(seed, quarter, firms, n=60):
    rnd = random.Random(seed)
    year = None if quarter is None else 2020
    out = []
    for _ in range(n):
        s, r = rnd.choice([("KEN", "UGA"), ("USA", "KEN"), ("USA", "MEX"), (None, None)])
        v = dict.fromkeys(TYPES)
        v |= {"firm": rnd.choice(firms), "firm_type": rnd.choice(["Bank", None]), "corridor": s and s + r,
              "sending_country_code": s, "receiving_country_code": r, "period_year": year,
              "period_quarter": quarter, "cc_number": rnd.choice([1, 2]), "send_amount": 200.0,
              "total_cost_pct": rnd.choice([None, 1.5, 2.0, 7.25]), "fee_cost_pct": rnd.choice([None, 1.0]),
              "is_disclosed_transparent": rnd.choice([True, False, None]),
              "cost_mismatch_flag": rnd.choice([True, False, None]),
              "total_cost_pct_missing": rnd.choice([True, False]), "cost_components_missing": False,
              "transparency_flag_count": rnd.choice([0, 1, 3, None])}
        out.append(tuple(v.values()))
    return out


def same(got, want):
    assert set(got) == set(want)
    for name in want:
        assert got[name].columns == want[name].columns
        key = lambda r: repr(tuple(r))
        assert sorted(map(key, got[name].collect())) == sorted(map(key, want[name].collect())), name


def test_marts_after_each_period_equal_a_rebuild(spark, tmp_base):
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    kept = PeriodMarts(spark, f"{tmp_base}/m", CFG, buckets=5)
    with pytest.raises(ValueError, match="no period"):
        kept.marts()
    held = {}
    for label, quarter, firms, n in (
            ("2020_1Q", 1, ["A", "B", "C", None], 60), ("2020_2Q", 2, ["B", "C", "D"], 60),
            (None, None, ["E", "A"], 20), ("2020_1Q", 1, ["A", "F"], 25),      # reloaded with other firms
            ("2020_2Q", 2, ["B"], 0)):                                         # taken out
        held[label] = rows(len(held), quarter, firms, n)
        kept.load(frame(held[label]).repartition(3), label)
        assert kept.stale_buckets() == []
        want = build_marts(frame([r for part in held.values() for r in part]).coalesce(1), CFG)
        same(kept.marts(), want)


def test_a_load_reads_the_states_of_its_own_buckets_only(spark, tmp_base, monkeypatch):
    kept = PeriodMarts(spark, f"{tmp_base}/m", CFG, buckets=64)
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    kept.load(frame(rows(1, 1, [f"firm{i}" for i in range(12)], 200)), "2020_1Q")
    seen = []
    plain = M.scorecard_of_states
    monkeypatch.setattr(M, "scorecard_of_states", lambda df, n: seen.append(df) or plain(df, n))
    kept.load(frame(rows(2, 2, ["firm3"], 30)), "2020_2Q")
    firms = {r[0] for r in seen[-1].select("firm").distinct().collect()}
    buckets = {json.loads(r[0])[-1] for r in seen[-1].select("__slot").distinct().collect()}
    assert "firm3" in firms and len(buckets) <= 2 and len(firms) < 6        # two firm types, two buckets
    all_states = kept._table(STATES, kept.log.records()).state()
    assert len({json.loads(s)[-1] for s in all_states}) > 10


def test_load_that_dies_is_not_seen_and_loads_side_by_side_lose_nothing(spark, tmp_base, monkeypatch):
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    base = f"{tmp_base}/m"
    one, two, three = (rows(i, i, ["A", "B"], 40) for i in (1, 2, 3))
    kept = PeriodMarts(spark, base, CFG, buckets=3)
    kept.load(frame(one), "2020_1Q")

    def die(record):
        raise OSError("lost")

    dying = PeriodMarts(spark, base, CFG)
    monkeypatch.setattr(dying.log, "append", die)
    with pytest.raises(OSError, match="lost"):
        dying.load(frame(two), "2020_2Q")
    same(kept.marts(), build_marts(frame(one), CFG))

    # a load that read the log before another one was published
    late = PeriodMarts(spark, base, CFG)
    before = late.log.records()
    kept.load(frame(two), "2020_2Q")
    monkeypatch.setattr(late.log, "records", lambda: before)
    late.load(frame(three), "2020_3Q")
    assert kept.stale_buckets() != []
    same(kept.marts(), build_marts(frame([*one, *two, *three]), CFG))
    kept.load(frame(three), "2020_3Q")
    assert kept.stale_buckets() == []


def test_quarters_split_between_periods_are_refused(spark, tmp_base):
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    kept = PeriodMarts(spark, f"{tmp_base}/m", CFG)
    with pytest.raises(ValueError, match="several quarters"):
        kept.load(frame(rows(1, 1, ["A"], 3) + rows(2, 2, ["A"], 3)), "2020_1Q")
    kept.load(frame(rows(1, 1, ["A"], 3)), "2020_1Q")
    with pytest.raises(ValueError, match="holds the quarter"):
        kept.load(frame(rows(1, 1, ["A"], 3)), "1st of 2020")
