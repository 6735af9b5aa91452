"""Period loads: nothing lost, failures audited whole and recoverable."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lanecost.operators import clean as C
from lanecost.plans import flows
from lanecost.session import shared_root
from lanecost.sinks import writers as W
from lanecost.sources import scan as S


def quotes(spark, periods):
    rows = [(i, p, f"c{i}") for i, p in enumerate(periods)]
    return spark.createDataFrame(rows, "id long, period string, corridor string")


@pytest.mark.parametrize("message", ["", "x" * 2000, "first line\nsecond line\n" + "y" * 1500])
def test_failed_load_keeps_old_rows_and_the_whole_message(spark, tmp_base, monkeypatch, message):
    schema = quotes(spark, []).schema
    target, audit = f"{tmp_base}/landing", f"{tmp_base}/audit"
    W.replace_partition_load(spark, quotes(spark, ["2016_2Q"]), target, "2016_2Q", audit, schema)

    def broken(*a, **k):
        raise RuntimeError(message)
    monkeypatch.setattr(W.VersionedTable, "publish", broken)
    with pytest.raises(RuntimeError):
        W.replace_partition_load(spark, quotes(spark, ["2016_2Q"] * 5), target, "2016_2Q", audit, schema)
    monkeypatch.undo()
    assert W.read_landing(spark, target, schema).count() == 1
    last = W.read_audit(spark, audit).orderBy(F.desc("load_id")).first()
    assert (last["status"], last["row_count"], last["error_message"]) == ("FAILED", 0, message or "RuntimeError")


def test_failed_audit_does_not_hide_the_error(spark, tmp_base, monkeypatch):
    def broken(*a, **k):
        raise OSError("no audit")
    monkeypatch.setattr(W, "append_audit", broken)
    with pytest.raises(ValueError, match="no source rows"):
        W.replace_partition_load(spark, quotes(spark, ["2016_2Q"]), f"{tmp_base}/t", "2099_1Q", f"{tmp_base}/a",
                                 quotes(spark, []).schema)


def test_null_period_loads(spark, tmp_base):
    schema = quotes(spark, []).schema
    target, audit = f"{tmp_base}/landing", f"{tmp_base}/audit"
    df = quotes(spark, ["2016_2Q", None, None])
    assert W.replace_partition_load(spark, df, target, ["2016_2Q", None], audit, schema) == 3
    assert W.replace_partition_load(spark, quotes(spark, [None]), target, None, audit, schema) == 2
    assert W.VersionedTable(spark, target).periods() == ["2016_2Q", None]
    assert sorted(map(tuple, W.read_landing(spark, target, schema).collect()), key=str) == [(0, "2016_2Q", "c0"), (0, None, "c0")]
    assert W.loaded_periods(spark, audit).count() == 1      # the null period has no label


def test_reports_survive_a_failed_write(spark, tmp_base):
    W.write_reports({"r": quotes(spark, ["2016_2Q"])}, tmp_base, periods=["2016_2Q"])
    bad = quotes(spark, ["2016_2Q"]).withColumn("id", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        W.write_reports({"r": bad}, tmp_base, periods=["2016_2Q"])
    assert spark.read.parquet(f"{tmp_base}/quality_reports/r").count() == 1


def test_period_write_makes_few_files(spark, tmp_base):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = quotes(spark, [f"20{y}_1Q" for y in range(10, 30)] * 40).repartition(8)
        path = W.write_by_period(df, tmp_base)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [len(glob.glob(f"{p}/*.parquet")) for p in glob.glob(f"{path}/period=*")]
    assert len(files) == 20 and max(files) == 1


def test_run_pipeline_guards_writes_and_warns(spark, tmp_base, caplog):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("shared test data not present")
    from lanecost.sources.fixtures import wide_quotes
    w = wide_quotes(spark, sf)
    w.write.parquet(f"{tmp_base}/drop")
    with pytest.raises(ValueError, match="Column count mismatch"):
        flows.run_pipeline(spark, f"{tmp_base}/drop", tmp_base, expected_columns=3)
    with caplog.at_level("WARNING"):
        counts = flows.run_pipeline(spark, f"{tmp_base}/drop", tmp_base, expected_columns=len(w.columns))
    assert set(counts) == set(flows.REPORT_NAMES)
    assert sorted(os.listdir(f"{tmp_base}/quality_reports")) == sorted(flows.REPORT_NAMES)
    warned = {n for n in counts if any(n in r.getMessage() for r in caplog.records)}
    assert warned == {n for n, c in counts.items() if c}


@pytest.mark.parametrize("files", [1, 2])
def test_period_without_curated_rows_is_audited_and_stops_nothing(spark, tmp_base, files):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("shared test data not present")
    from lanecost.sources.fixtures import wide_quotes
    from lanecost.streaming.drop_watch import stream_period_loads
    w = wide_quotes(spark, sf).filter(F.col("period").isin("1995_1Q", "1995_2Q"))
    gone = F.col("period") == "1995_2Q"
    w = w.withColumns({c: F.when(~gone, F.col(f"`{c}`")) for c in w.columns if c.endswith(C.DRIVING_FIELD)})
    for i in range(files):
        w.filter(F.pmod("id", F.lit(files)) == i).coalesce(1).write.mode("append").parquet(f"{tmp_base}/drop")
    stream_period_loads(spark, f"{tmp_base}/drop", w.schema, f"{tmp_base}/out", max_files_per_trigger=1)
    landed = W.read_landing(spark, f"{tmp_base}/out/landing")
    assert landed.count() == flows.curate(w)[0].count() > 0
    status = {(r["quarter_label"], r["status"]) for r in W.read_audit(spark, f"{tmp_base}/out/audit").collect()}
    assert status == {("1995_1Q", "SUCCESS"), ("1995_2Q", "EMPTY")}


def test_convert_full_history_is_strict(spark, tmp_base):
    df = quotes(spark, ["a", "b"])
    assert S.convert_full_history(spark, df, f"{tmp_base}/h", 2, 3, ("id",)).schema["id"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="Row count"):
        S.convert_full_history(spark, df, f"{tmp_base}/h", 3, 3)


def test_tier_numbers_have_any_number_of_digits(spark):
    df = spark.createDataFrame([(1, 5.0, 6.0, 7.0)], ["id", "cc1 denomination amount", "cc10 denomination amount",
                                                      "cc11 denomination amount"])
    out = C.unpivot_sides(df, ("cc1 ", "cc10 ", "cc11 ")).collect()
    assert sorted((r["cc_number"], r["send_amount"]) for r in out) == [(1, 5.0), (10, 6.0), (11, 7.0)]
    with pytest.raises(ValueError):
        C.unpivot_sides(df, ("cc1 ", "cc10 "), numbers=[1, 1])


def test_shared_folder_is_required_off_one_process(spark):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://cluster:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_split_dedup_does_not_sort_unique_rows(spark):
    from lanecost.operators.dedup import dedup_first
    df = spark.range(1000).selectExpr("id", "id % 990 as k", "cast(id as string) as wide")
    out = dedup_first(df, ["k"], ["id"], strategy="split")
    assert out.count() == 990
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    union = plan.split("Union", 1)[1]
    unique = union.split("LeftAnti", 1)[1].split("Aggregate", 1)[0]
    assert "Sort" not in unique


def _wide_rows(spark):
    """300 quotes of three periods, one of them null; every tenth repeats the grain of another."""
    from lanecost.catalog import oracle as O
    i = F.col("n")
    known = {"id": i, "period": F.when(i % 3 > 0, F.concat(F.lit("201"), (i % 3).cast("string"), F.lit("_2Q"))),
             "date": F.lit("2016-01-01 00:00:00"), "corridor": F.lit("KENUGA"),
             "firm": F.concat(F.lit("f"), F.when(i % 10 == 9, i - 6).otherwise(i).cast("string")), "transparent": F.lit("no"),
             "cc1 denomination amount": F.lit(200.0), "cc1 fx margin": F.when(i % 2 == 0, -1.0).otherwise(1.0)}
    numbers = ("amount", "fee", "rate", "margin", "%", "fx")
    return spark.range(300).withColumnRenamed("id", "n").select(*[
        known.get(c, F.lit(None).cast("double" if c.endswith(numbers) else "string")).alias(c) for c in O.WIDE_COLUMNS])


@pytest.fixture
def rebalanced(monkeypatch, spark):
    """The columns by which frames are dealt out again before a write."""
    seen, frame = [], type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *of: (
        seen.append(len(self.columns)) if name == "rebalance" else None, hint(self, name, *of))[1])
    return seen


def test_a_drop_by_period_is_curated_without_shuffling_rows_by_it(spark, tmp_base, rebalanced):
    w = _wide_rows(spark)
    w.write.partitionBy("period").parquet(f"{tmp_base}/drop")
    counts = flows.run_pipeline(spark, f"{tmp_base}/drop", tmp_base, expected_columns=len(w.columns))
    assert counts == {"grain_duplicates": 30, "fx_margin": 150, "transparency": 270, "duplicate_check": 0}
    assert len(rebalanced) == 2                          # the duplicates and the check, which come by key
    clean = flows.curate(w)[0]
    got = spark.read.schema(clean.schema).parquet(f"{tmp_base}/clean")
    assert sorted(map(repr, got.select(*clean.columns).collect())) == sorted(map(repr, clean.collect()))


@pytest.mark.parametrize("files", [1, 3])
def test_the_stream_shuffles_no_rows_by_period(spark, tmp_base, rebalanced, files):
    from lanecost.operators.model import conform_landing
    from lanecost.streaming.drop_watch import stream_period_loads
    w = _wide_rows(spark)
    w.repartition(files, "id").write.parquet(f"{tmp_base}/drop")
    stream_period_loads(spark, f"{tmp_base}/drop", w.schema, f"{tmp_base}/out")
    assert len(rebalanced) == 2
    want = conform_landing(flows.curate(w)[0])
    got = W.read_landing(spark, f"{tmp_base}/out/landing")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 270
    assert len(os.listdir(f"{tmp_base}/out/curated/quality_reports/transparency")) >= 3


def test_quotes_are_dealt_out_before_they_are_wide(spark, tmp_base, rebalanced, monkeypatch):
    from lanecost.catalog import queries as Q
    from lanecost.sources.fixtures import wide_quotes
    made = {"lineitem": "select id l_orderkey, 1L l_partkey, 1L l_suppkey, cast(id % 7 + 1 as int) l_linenumber, double(id % 5) l_quantity, "
                        "0.1D l_discount, 0.02D l_tax, 'R' l_returnflag, 'F' l_linestatus, timestamp'1996-02-03' l_shipdate from range(40)",
            "orders": "select id o_orderkey, id % 3 o_custkey, 'O' o_orderstatus, timestampadd(month, cast(id as int), timestamp'1996-01-01') "
                      "o_orderdate, '1-URGENT' o_orderpriority from range(40)",
            "customer": "select id c_custkey, cast(id as int) c_nationkey, 'AUTO' c_mktsegment from range(3)",
            "supplier": "select 1L s_suppkey, 's' s_name, 4 s_nationkey"}
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{tmp_base}/{name}.parquet")
    w = wide_quotes(spark, tmp_base)
    path, _ = Q.staged_drop(spark, tmp_base)
    assert len(rebalanced) == 1 and rebalanced[0] < len(w.columns) / 2
    got = spark.read.schema(w.schema).parquet(path).select(*w.columns)
    assert w.count() == 40 and sorted(map(repr, got.collect())) == sorted(map(repr, w.collect()))
    builds = []
    curate = flows.dedup_marked
    monkeypatch.setattr(flows, "dedup_marked", lambda *a, **k: builds.append(1) or curate(*a, **k))
    assert Q.QUERIES["run_pipeline_clean"](spark, tmp_base).count() > 0 and len(builds) == 1
