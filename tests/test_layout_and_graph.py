"""Clustered files, the model graph, the listing in chunks and the headline figures."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lanecost.operators import serve as S
from lanecost.plans.model_graph import ModelGraph
from lanecost.sinks import clustering as Z
from lanecost.sinks import writers as Wr


def scanned_rows(df):
    """Rows that the scan of a filter gave, after whole row groups were skipped."""
    n = len(df.collect())
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    return n, metrics.get("numOutputRows").get().value()


def test_a_filter_on_either_column_of_clustered_files_reads_little(spark, tmp_base):
    rnd = random.Random(2)
    codes = [a + b + "X" for a in "ABCDEFGH" for b in "KLMN"]
    rows = [(f"202{rnd.randrange(2)}", rnd.choice(codes), rnd.choice(codes), i) for i in range(8000)]
    rows += [("2020", None, "AKX", -1), (None, "AKX", None, -2)]
    df = spark.createDataFrame(rows, "period string, s string, r string, i int")
    plain = spark.read.schema(df.schema).parquet(Wr.write_by_period(df, tmp_base, name="plain"))
    path = Wr.write_by_period(df, tmp_base, name="laid", cluster_by=["s", "r"], max_rows=100)
    laid = spark.read.schema(df.schema).parquet(path)
    assert sorted(laid.select(*df.columns).collect(), key=repr) == sorted(df.collect(), key=repr)
    for cond in (F.col("s") == "CLX", F.col("r") == "CLX", (F.col("s") == "CLX") | (F.col("r") == "CLX")):
        want, all_rows = scanned_rows(plain.filter(cond))
        got, read = scanned_rows(laid.filter(cond))
        assert got == want == df.filter(cond).count()
        assert all_rows >= len(rows) - 2 and read < 0.55 * all_rows
    # the whole of one period can be replaced as ever
    Wr.write_by_period(df.filter("period = '2021'").limit(10), tmp_base, name="laid", cluster_by=["s", "r"])
    assert spark.read.schema(df.schema).parquet(path).groupBy("period").count().filter("period = '2021'").first()["count"] == 10


def test_a_hot_pair_is_split_and_odd_columns_are_laid_out(spark, tmp_base):
    df = spark.createDataFrame([("H", 1.0, i) for i in range(3000)] + [("a", float("nan"), 1), (None, None, 2)],
                               "s string, v double, i int")
    shares = Z.clustered(df, ["s", "v"]).groupBy(F.spark_partition_id()).count()
    assert sum(r[1] for r in shares.collect()) == 3002
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[1] for r in Z.clustered(df, ["s", "v"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 2 and max(sizes) < 2000
    dated = df.select(F.lit("p").alias("period"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("i") % 50).alias("d"))
    path = Wr.write_by_period(dated, tmp_base, cluster_by=["d"], max_rows=100)
    spans = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in glob.glob(f"{path}/*/*.parquet")]
    assert len(spans) > 20 and sum((s.max - s.min).days for s in spans) < 3 * len(spans)
    assert Z.clustered(df.limit(0), ["s", "v"]).collect() == []
    with pytest.raises(ValueError):
        Z.z_value(df, [])


def test_models_are_built_once_in_order_and_shared_ones_written(spark, tmp_base):
    calls = []

    def step(name, f):
        def run(*frames):
            calls.append(name)
            return f(*frames)
        return run

    g = ModelGraph()
    g.add("sums", step("sums", lambda a, b: a.unionByName(b)), ["evens", "odds"])
    g.add("odds", step("odds", lambda n: n.filter("id % 2 = 1")), ["numbers"])
    g.add("evens", step("evens", lambda n: n.filter("id % 2 = 0")), ["numbers"])
    g.add("numbers", step("numbers", lambda: spark.range(6)))
    g.add("unused", step("unused", lambda n: n), ["numbers"])
    out = g.build(tmp_base, ["sums"])
    assert sorted(r.id for r in out["sums"].collect()) == list(range(6))
    assert sorted(calls) == ["evens", "numbers", "odds", "sums"] and calls[0] == "numbers" and calls[-1] == "sums"
    assert glob.glob(f"{tmp_base}/numbers/*.parquet") and not glob.glob(f"{tmp_base}/odds")
    assert all("numbers" in f for f in out["sums"].inputFiles())

    g.add("a", lambda b: b, ["b"])
    g.add("b", lambda a: a, ["a"])
    with pytest.raises(ValueError, match="circle"):
        g.order()
    assert g.order(["sums"])[-1] == "sums"
    g.add("c", lambda x: x, ["nowhere"])
    with pytest.raises(ValueError, match="'nowhere', which 'c' refers to"):
        g.order(["c"])
    with pytest.raises(ValueError, match="two models"):
        g.add("a", lambda: None)


def test_listing_chunks_joined_are_the_line(spark):
    rnd = random.Random(7)
    firms = [(f"Fïrm {i}", "Bank", i, round(rnd.uniform(5, 20), 1)) for i in range(57)] + [("low", "Bank", 3, 1.0),
                                                                                       (None, "Bank", 3, 99.0)]
    df = spark.createDataFrame(firms, "firm string, firm_type string, num_observations long, avg_total_cost_pct double")
    line = S.top_cost_listing(df, 5.0).first().listing
    for per_chunk in (1, 10, 100):
        chunks = S.listing_chunks(df.repartition(5), 5.0, per_chunk).collect()
        assert ", ".join(c.listing for c in chunks) == line
        assert [c.chunk for c in chunks] == list(range(len(chunks))) and sum(c.firms for c in chunks) == 57
        assert all(c.firms <= per_chunk and c.first_rank == c.chunk * per_chunk for c in chunks)
        assert all(line[c.starts_at:].startswith(c.listing) for c in chunks)
    assert S.listing_chunks(df, 1000.0).collect() == []


def test_kpis_of_one_role_and_of_nothing(spark):
    trends = spark.createDataFrame([("AB",), ("AB",), (None,)], "corridor string")
    spot = spark.createDataFrame([("AB", "f", "sending", 4.0), ("BA", "g", "receiving", 8.0), ("BA", "f", None, 1.0)],
                                 "corridor string, firm string, spotlight_role string, total_cost_pct double")
    got = {r.kpi: r.value for r in S.kpis(trends, spot, spot, spot, "receiving").collect()}
    assert got == {"corridors_tracked": 1, "provider_observations": 3, "firms_scored": 3, "spotlight_observations": 3,
                   "focus_observations": 1, "focus_corridors": 1, "focus_firms": 1, "focus_avg_total_cost_pct": 8.0}
    none = {r.kpi: r.value for r in S.kpis(*[df.limit(0) for df in (trends, spot, spot, spot)]).collect()}
    assert none.pop("focus_avg_total_cost_pct") is None and set(none.values()) == {0}


def test_positions_are_found_by_compiled_halving(spark, capsys):
    values = [None, float("nan"), -3.0, -0.5, 0.0, 0.25, 0.25, 7.0, 1e300] + [float(i) for i in range(40)]
    df = spark.createDataFrame([(i, v, None if i % 7 == 0 else f"c{i % 11}") for i, v in enumerate(values)], "i int, v double, s string")
    found = Z.z_value(df, ["v", "s"], bits=3)
    at = {r.i: (sum((r["__z"] >> 2 * i & 1) << i for i in range(3)), sum((r["__z"] >> 2 * i + 1 & 1) << i for i in range(3)))
          for r in found.collect()}

    def ranges(column):
        cuts = df.agg(F.percentile_approx(F.nanvl(column, F.lit(None)), [i / 7 for i in range(1, 7)], 140)).first()[0]
        return {r[0]: 0 if r[1] is None else 1 + sum(c < r[1] or r[1] != r[1] for c in set(cuts))
                for r in df.select("i", column).collect()}

    v, s = ranges(F.col("v")), ranges(Z._as_number(df, "s"))
    assert at == {i: (v[i], s[i]) for i in range(len(values))}
    capsys.readouterr()
    found.explain()
    assert "lambda" not in capsys.readouterr().out
