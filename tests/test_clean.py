import pytest
from pyspark.sql import types as T

from lanecost.operators import clean as C

GEO = list(C.GEOGRAPHY_COLUMNS)


def geo_frame(spark, rows):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in GEO + ["firm"]])
    return spark.createDataFrame(rows, schema)


def test_sentinel_becomes_null_only_in_scope(spark):
    df = geo_frame(spark, [("..", "IDA", "..", "Europe", "..", "G20", "..")])
    row = C.null_sentinel(df).first()
    assert row["source_region"] is None and row["source_G8G20"] is None
    assert row["destination_lending"] is None
    assert row["source_lending"] == "IDA" and row["destination_region"] == "Europe"
    assert row["firm"] == ".."  # same value outside the six columns is untouched


def test_sentinel_missing_column_raises(spark):
    df = spark.createDataFrame([("x",)], "source_region string")
    with pytest.raises(ValueError, match="source_lending"):
        C.null_sentinel(df)


def test_mixed_dates(spark):
    df = spark.createDataFrame([("11/May/2016",), ("2021-05-26 00:00:00",), ("not-a-date",), (None,)],
                               "date string")
    rows = C.parse_mixed_date(df).collect()
    got = [(r["date"].isoformat() if r["date"] else None, r["date_raw"]) for r in rows]
    assert got == [("2016-05-11", "11/May/2016"), ("2021-05-26", "2021-05-26 00:00:00"),
                   (None, "not-a-date"), (None, None)]


def test_mixed_dates_missing_column(spark):
    with pytest.raises(ValueError):
        C.parse_mixed_date(spark.createDataFrame([(1,)], "x int"))


def test_period_parts_and_malformed(spark):
    df = spark.createDataFrame([("2016_2Q",), ("2025_1Q",), ("garbage",), ("",)], "period string")
    got = [(r["period_year"], r["period_quarter"]) for r in C.parse_period(df).collect()]
    assert got == [(2016, 2), (2025, 1), (None, None), (None, None)]


def tier_frame(spark, rows):
    fields = ["corridor", "firm", "period"]
    tier = [("lcu amount", T.DoubleType()), ("denomination amount", T.DoubleType()),
            ("lcu fee", T.DoubleType()), ("lcu code", T.StringType()), ("total cost %", T.DoubleType())]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields]
                          + [T.StructField(p + n, t) for p in ("cc1 ", "cc2 ") for n, t in tier])
    return spark.createDataFrame(rows, schema)


def test_unpivot_both_one_and_no_sides(spark):
    rows = [("US-MX", "A", "2016_2Q", 200.0, 200.0, 5.0, "USD", 3.0, 500.0, 500.0, 9.0, "USD", 2.5),
            ("US-PH", "B", "2016_2Q", 200.0, 200.0, 4.0, "USD", 2.0, 500.0, None, 8.0, "USD", 1.5),
            ("US-IN", "C", "2016_2Q", 200.0, None, 4.0, "USD", 2.0, 500.0, None, 8.0, "USD", 1.5)]
    out = C.unpivot_sides(tier_frame(spark, rows))
    assert "denomination amount" not in out.columns and "send_amount" in out.columns
    assert not any(c.startswith("cc1 ") or c.startswith("cc2 ") for c in out.columns)
    got = sorted((r["corridor"], r["cc_number"], r["send_amount"], r["lcu fee"]) for r in out.collect())
    assert got == [("US-MX", 1, 200.0, 5.0), ("US-MX", 2, 500.0, 9.0), ("US-PH", 1, 200.0, 4.0)]


def test_unpivot_is_one_generate_not_a_union(spark):
    rows = [("US-MX", "A", "2016_2Q", 200.0, 200.0, 5.0, "USD", 3.0, 500.0, 500.0, 9.0, "USD", 2.5)]
    plan = C.unpivot_sides(tier_frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Union" not in plan
