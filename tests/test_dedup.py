import pytest

from lanecost.operators.dedup import dedup_grain, flag_duplicates

SCHEMA = "id long, corridor string, firm string, `payment instrument` string, period string, send_amount double, `fx margin` double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("strategy", ["aggregate", "split"])
def test_no_duplicates(spark, strategy):
    df = frame(spark, [(1, "A", "F", "Cash", "2016_2Q", 200.0, 1.0),
                       (2, "A", "F", "Cash", "2016_2Q", 500.0, 1.0)])
    clean, report = dedup_grain(df, strategy=strategy)
    assert clean.count() == 2 and report.count() == 0
    assert clean.columns == df.columns


@pytest.mark.parametrize("strategy", ["aggregate", "split"])
def test_first_kept_triplicate_reports_two_with_count_three(spark, strategy):
    df = frame(spark, [(3, "A", "F", "Cash", "2016_2Q", 200.0, 3.0),
                       (1, "A", "F", "Cash", "2016_2Q", 200.0, 1.0),
                       (2, "A", "F", "Cash", "2016_2Q", 200.0, 2.0),
                       (9, "B", "F", "Cash", "2016_2Q", 200.0, 9.0)])
    clean, report = dedup_grain(df, strategy=strategy)
    assert sorted(r["id"] for r in clean.collect()) == [1, 9]
    rep = sorted((r["id"], r["duplicate_count"]) for r in report.collect())
    assert rep == [(2, 3), (3, 3)]
    assert report.columns == df.columns + ["duplicate_count"]
    assert not any(c.startswith("_") for c in clean.columns + report.columns)


@pytest.mark.parametrize("strategy", ["aggregate", "split"])
def test_null_keys_group_together_and_identical_copies(spark, strategy):
    df = frame(spark, [(1, None, "F", "Cash", "2016_2Q", None, 1.0),
                       (1, None, "F", "Cash", "2016_2Q", None, 1.0),
                       (1, None, "F", "Cash", "2016_2Q", None, 1.0),
                       (0, None, "F", "Cash", "2016_2Q", None, 5.0)])
    clean, report = dedup_grain(df, strategy=strategy)
    assert [(r["id"], r["fx margin"]) for r in clean.collect()] == [(0, 5.0)]
    assert sorted((r["id"], r["duplicate_count"]) for r in report.collect()) == [(1, 4)] * 3
    assert clean.count() + report.count() == df.count()


def test_order_is_total_not_file_order(spark):
    rows = [(1, "A", "F", "Cash", "2016_2Q", 200.0, m) for m in (7.0, 3.0, None, 5.0)]
    a, _ = dedup_grain(frame(spark, rows))
    b, _ = dedup_grain(frame(spark, list(reversed(rows))).repartition(3))
    assert a.collect() == b.collect()
    assert a.first()["fx margin"] is None  # nulls first in the tie-break


def test_flag_duplicates_flags_every_member(spark):
    df = frame(spark, [(1, "A", "F", "Cash", "2016_2Q", 200.0, 1.0),
                       (2, "A", "F", "Cash", "2016_2Q", 200.0, 2.0),
                       (3, "A", "F", "Cash", "2016_2Q", 200.0, 3.0),
                       (4, "B", "F", "Cash", "2016_2Q", 200.0, 1.0)])
    clean, flagged = flag_duplicates(df)
    assert [r["id"] for r in clean.collect()] == [4]
    assert sorted((r["id"], r["duplicate_count"]) for r in flagged.collect()) == [(1, 3), (2, 3), (3, 3)]
    assert clean.columns == df.columns


def test_dedup_plan_has_no_window(spark):
    df = frame(spark, [(1, "A", "F", "Cash", "2016_2Q", 200.0, 1.0)])
    clean, _ = dedup_grain(df)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_min" in plan  # map-side combine before the shuffle


def test_replicate_spreads_large_counts_in_chunks(spark):
    from lanecost.operators.util import replicate
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), ("d", 9)], "k string, n long")
    out = replicate(df, "n", ["k"], chunk=3)
    got = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
    assert got == {"b": 1, "c": 7, "d": 9}
    assert out.columns == ["k", "n"]


from collections import Counter  # noqa: E402

from hypothesis import given, settings, strategies as st  # noqa: E402

_small = st.one_of(st.none(), st.sampled_from(["A", "B"]))
_row = st.tuples(st.one_of(st.none(), st.integers(0, 3)), _small, st.just("F"), _small,
                 st.just("2016_2Q"), st.one_of(st.none(), st.sampled_from([200.0, 500.0])),
                 st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])))


def _brute(rows):
    """First row per grain by (id, then every other column), nulls first."""
    nf = lambda v: (0,) if v is None else (1, v)
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[2], r[3], r[4], r[5]), []).append(r)
    clean, report = Counter(), Counter()
    for members in groups.values():
        members = sorted(members, key=lambda r: (nf(r[0]), nf(r[6])))
        clean[members[0]] += 1
        for r in members[1:]:
            report[r + (len(members),)] += 1
    return clean, report


@settings(max_examples=25, deadline=None)
@given(st.lists(_row, min_size=1, max_size=12), st.sampled_from(["aggregate", "split", "filter"]))
def test_dedup_matches_brute_force(spark, rows, strategy):
    clean, report = dedup_grain(frame(spark, rows), strategy=strategy)
    want_clean, want_report = _brute(rows)
    assert Counter(tuple(r) for r in clean.collect()) == want_clean
    assert Counter(tuple(r) for r in report.collect()) == want_report


def test_filter_dedup_neither_shuffles_nor_sorts_unique_rows(spark):
    df = spark.range(1000).selectExpr("id", "id % 990 as k", "cast(id as string) as wide")
    clean, report = dedup_grain(df, ["k"], ["id"], strategy="filter")
    assert clean.count() == 990 and report.count() == 10
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    unique = plan.split("Union", 1)[1].split("Aggregate", 1)[0]
    assert "Join LeftOuter" in unique and "rightHint=(strategy=broadcast)" in unique


def test_filter_dedup_with_a_full_array(spark, monkeypatch):
    from lanecost.operators import dedup
    monkeypatch.setattr(dedup, "MOST_BITS", 64)
    df = spark.range(1000).selectExpr("id", "id % 400 as k", "cast(id as string) as wide")
    clean, report = dedup_grain(df, ["k"], ["id"], strategy="filter")
    assert sorted(r["id"] for r in clean.collect()) == list(range(400)) and report.count() == 600


@settings(max_examples=15, deadline=None)
@given(st.lists(_row, min_size=1, max_size=12))
def test_marked_dedup_matches_brute_force(spark, rows):
    clean, report = dedup_grain(frame(spark, rows), strategy="marked")
    want_clean, want_report = _brute(rows)
    assert Counter(tuple(r) for r in clean.collect()) == want_clean
    assert Counter(tuple(r) for r in report.collect()) == want_report


def test_rows_of_unique_keys_are_never_shuffled(spark, monkeypatch):
    from lanecost.operators import row_marks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as with many repeated keys
    try:
        df = spark.range(20000).selectExpr("id", "id % 19000 as k", "cast(id as string) as wide").repartition(7)
        dedup, _ = dedup_grain(df, ["k"], ["id"], strategy="marked", with_report=False)
        clean, flagged = flag_duplicates(df, ["k"])
        for frame_, n in ((dedup, 19000), (clean, 18000), (flagged, 2000)):
            assert frame_.count() == n == frame_.select("id").distinct().count()
        for frame_ in (dedup, clean):
            unique = frame_._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1].split("FileScan", 1)[0]
            assert "Exchange" not in unique.split("BroadcastHashJoin")[0] and "Sort" not in unique
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(row_marks, "MOST_CHUNKS", 1)                  # past the bound every row may be repeated
    assert sorted(r["id"] for r in dedup_grain(df, ["k"], ["id"], strategy="marked")[0].collect()) == list(range(19000))
    assert flag_duplicates(df, ["k"])[1].count() == 2000


@pytest.mark.parametrize("strategy", ["marked", "filter"])
def test_of_a_repeated_key_only_the_leading_rows_are_aggregated_whole(spark, monkeypatch, strategy):
    from lanecost.operators import dedup
    seen, whole = [], dedup._Grouped.first_per_group
    monkeypatch.setattr(dedup._Grouped, "first_per_group",
                        lambda self, rows: seen.append(rows.count()) or whole(self, rows))
    df = spark.range(1000).selectExpr("id", "if(id < 900, 0, id) as k", "cast(id as string) as wide")
    clean, report = dedup_grain(df, ["k"], ["id"], strategy=strategy)
    assert seen == [1]                                   # of 900 rows of the one repeated key
    assert sorted(r["id"] for r in clean.collect()) == [0, *range(900, 1000)]
    assert sorted((r["id"], r["duplicate_count"]) for r in report.collect()) == [(i, 900) for i in range(1, 900)]


@pytest.mark.parametrize("strategy", ["marked", "filter"])
def test_leading_rows_with_nulls_ties_and_keys_of_one_hash(spark, strategy):
    # xxhash64 skips nulls, so the keys (A, null) and (null, A) share their hash
    rows = [(5, "A", None, "x"), (2, "A", None, "y"), (7, None, "A", "z"), (7, None, "A", "w"),
            (None, "B", "B", "v"), (1, "B", "B", "u"), (3, "C", "C", "t")]
    df = spark.createDataFrame(rows, "id long, a string, b string, wide string")
    clean, report = dedup_grain(df, ["a", "b"], ["id"], strategy=strategy)
    assert {tuple(r) for r in clean.collect()} == {(2, "A", None, "y"), (7, None, "A", "w"), (None, "B", "B", "v"),
                                                   (3, "C", "C", "t")}
    assert {tuple(r) for r in report.collect()} == {(5, "A", None, "x", 2), (7, None, "A", "z", 2), (1, "B", "B", "u", 2)}


def test_filter_dedup_computes_its_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    df = spark.range(100).selectExpr("id", "id % 90 as k").mapInArrow(count, "id long, k long")
    clean, _ = dedup_grain(df, ["k"], ["id"], strategy="filter", with_report=False)
    assert clean.count() == 90 and made.value == 100


def test_wide_chains_run_from_small_methods_and_the_setting_is_put_back(spark, monkeypatch):
    from lanecost import session
    key, limit = session.HUGE_METHOD_LIMIT
    before = spark.conf.get(key)
    with session.small_methods(spark):                   # this session compiles huge methods
        assert spark.conf.get(key) == before
    monkeypatch.setattr(session, "JIT_OPTIONS", "-XX:-NotGiven")
    with pytest.raises(KeyError), session.small_methods(spark):
        assert spark.conf.get(key) == limit
        raise KeyError
    assert spark.conf.get(key) == before


def test_the_report_shuffles_its_rows_once_and_names_each_copy(spark, monkeypatch):
    from lanecost.operators import row_marks
    df = spark.createDataFrame([(1, "A", "x")] * 3 + [(2, "A", "x"), (1, "B", "y"), (1, "B", "x"), (4, "C", "z")],
                               "id long, k string, wide string")
    want = Counter({(1, "A", "x", 4): 2, (2, "A", "x", 4): 1, (1, "B", "y", 2): 1})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as with many repeated keys
    try:
        for most in (row_marks.MOST_CHUNKS, 0):                      # past the bound the first rows leave by a join
            monkeypatch.setattr(row_marks, "MOST_CHUNKS", most)
            clean, report = dedup_grain(df, ["k"], ["id"], strategy="marked")
            assert Counter(tuple(r) for r in clean.collect()) == Counter([(1, "A", "x"), (1, "B", "x"), (4, "C", "z")])
            assert Counter(tuple(r) for r in report.collect()) == want
            plan = report._jdf.queryExecution().optimizedPlan().toString()
            if most:
                assert plan.count("Join Inner") == 1 and "Aggregate" not in plan and "Generate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
