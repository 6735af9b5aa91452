import os

import pytest
from pyspark.sql import functions as F

from lanecost.plans.incremental import incremental_period_run, paths
from lanecost.sinks import writers as W
from lanecost.sources import scan as S


def quotes(spark, periods):
    rows = [(i, p, f"c{i}") for i, p in enumerate(periods)]
    return spark.createDataFrame(rows, "id long, period string, corridor string")


def test_write_by_period_layout_and_partial_rewrite(spark, tmp_base):
    df = quotes(spark, ["2016_2Q", "2016_2Q", "2016_3Q", None])
    path = W.write_by_period(df, tmp_base + "/")
    assert path == f"{tmp_base}/clean"
    assert os.path.isdir(f"{path}/period=2016_2Q") and os.path.isdir(f"{path}/period=2016_3Q")
    # the null period is kept in the default partition
    assert spark.read.parquet(path).filter(F.col("period").isNull()).count() == 1
    W.write_by_period(quotes(spark, ["2016_3Q"]), tmp_base)
    got = spark.read.parquet(path).groupBy("period").count().collect()
    assert {r["period"]: r["count"] for r in got} == {"2016_2Q": 2, "2016_3Q": 1, None: 1}


def test_reports_one_folder_each_and_stale_period_cleared(spark, tmp_base):
    reps = {"fx_margin": quotes(spark, ["2016_2Q"]), "transparency": quotes(spark, ["2016_2Q"])}
    out = W.write_reports(reps, tmp_base)
    assert sorted(os.listdir(f"{tmp_base}/quality_reports")) == ["fx_margin", "transparency"]
    empty = quotes(spark, ["2016_2Q"]).limit(0)
    W.write_reports({"fx_margin": empty}, tmp_base, periods=["2016_2Q"])
    assert spark.read.schema(empty.schema).parquet(out["fx_margin"]).count() == 0


def test_replace_partition_load_idempotent_and_audited(spark, tmp_base):
    src = W.write_by_period(quotes(spark, ["2016_2Q", "2016_2Q", "2016_3Q"]), tmp_base, name="src")
    schema = quotes(spark, []).schema
    target, audit = f"{tmp_base}/landing", f"{tmp_base}/audit"
    assert W.replace_partition_load(spark, src, target, "2016_2Q", audit, schema) == 2
    assert W.replace_partition_load(spark, src, target, "2016_3Q", audit, schema) == 3
    assert W.replace_partition_load(spark, src, target, "2016_2Q", audit, schema) == 3
    with pytest.raises(ValueError, match="no source rows"):
        W.replace_partition_load(spark, src, target, "2099_1Q", audit, schema)
    assert W.read_landing(spark, target, schema).count() == 3  # the failed load deleted nothing
    log = [(r["load_id"], r["quarter_label"], r["row_count"], r["status"])
           for r in W.read_audit(spark, audit).orderBy("load_id").collect()]
    assert log == [(1, "2016_2Q", 2, "SUCCESS"), (2, "2016_3Q", 3, "SUCCESS"),
                   (3, "2016_2Q", 3, "SUCCESS"), (4, "2099_1Q", 0, "FAILED")]


def test_loaded_periods_and_latest_unseen(spark, tmp_base):
    assert S.list_loaded_periods(spark, f"{tmp_base}/nothing").count() == 0
    W.write_by_period(quotes(spark, ["2016_2Q", "2016_3Q"]), tmp_base, name="raw")
    os.makedirs(f"{tmp_base}/raw/period=full_history")
    loaded = S.list_loaded_periods(spark, f"{tmp_base}/raw")
    assert sorted(r[0] for r in loaded.collect()) == ["2016_2Q", "2016_3Q"]
    drop = quotes(spark, ["2016_2Q", "2016_3Q", "2016_4Q", "2017_1Q"])
    label, sliced = S.ingest_latest_period(drop, loaded)
    assert label == "2017_1Q" and sliced.count() == 1  # only the newest; 2016_4Q stays unloaded
    with pytest.raises(ValueError, match="No new periods"):
        S.ingest_latest_period(quotes(spark, ["2016_2Q"]), loaded)


def test_scan_guarded_column_drift_raises_row_drift_warns(spark, tmp_base):
    wide = spark.createDataFrame([tuple(str(i) for i in range(42))],
                                 ", ".join(f"col_{i} string" for i in range(42)))
    wide.write.parquet(f"{tmp_base}/w")
    assert len(S.scan_guarded(spark, f"{tmp_base}/w").columns) == 42
    spark.createDataFrame([("a",)], "c string").write.parquet(f"{tmp_base}/n")
    with pytest.raises(ValueError, match="Column count mismatch"):
        S.scan_guarded(spark, f"{tmp_base}/n")
    with pytest.raises(ValueError, match="Row count"):
        S.scan_guarded(spark, f"{tmp_base}/w", strict_rows=True)


def test_reference_csv_quoted_comma_and_unique_key(spark, tmp_base):
    from pyspark.sql import types as T
    p = f"{tmp_base}/seed.csv"
    with open(p, "w") as f:
        f.write('country_iso3,region\nAFG,"Middle East, North Africa"\nKEN,Sub-Saharan Africa\n')
    schema = T.StructType([T.StructField("country_iso3", T.StringType()),
                           T.StructField("region", T.StringType())])
    df = S.scan_reference_csv(spark, p, schema, key="country_iso3")
    assert df.filter("country_iso3 = 'AFG'").first()["region"] == "Middle East, North Africa"
    with open(f"{tmp_base}/dup.csv", "w") as f:
        f.write("country_iso3,region\nAFG,a\nAFG,b\n")
    with pytest.raises(ValueError):
        S.scan_reference_csv(spark, f"{tmp_base}/dup.csv", schema, key="country_iso3")


def test_period_slice_prunes_partitions(spark, tmp_base):
    W.write_by_period(quotes(spark, ["2016_2Q", "2016_3Q"]), tmp_base, name="raw")
    df = S.scan_period_slice(spark, f"{tmp_base}/raw", "2016_3Q")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "2016_3Q" in plan
    assert df.count() == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="shared test data not present")
def test_stream_loader_rerun_processes_nothing_new(spark, tmp_base):
    from lanecost.sources.fixtures import wide_quotes
    from lanecost.streaming.drop_watch import stream_period_loads
    drop = W.write_by_period(wide_quotes(spark, "/root/testdata/sf0.001"), tmp_base, name="drop")
    schema = spark.read.parquet(drop).schema
    ckpt, base = f"{tmp_base}/ckpt", f"{tmp_base}/out"
    stream_period_loads(spark, drop, schema, base, checkpoint=ckpt)
    landed = W.read_landing(spark, f"{base}/landing").count()
    audits = W.read_audit(spark, f"{base}/audit").count()
    assert landed > 0 and audits > 0
    stream_period_loads(spark, drop, schema, base, checkpoint=ckpt)
    assert W.read_landing(spark, f"{base}/landing").count() == landed
    assert W.read_audit(spark, f"{base}/audit").count() == audits
