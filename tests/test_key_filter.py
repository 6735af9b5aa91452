"""The bit array lets every key through and stops most others, whatever its size."""

import pytest
from pyspark.sql import functions as F

from lanecost.operators import key_filter


@pytest.mark.parametrize("most_bits", [1 << 12, 1 << 26])
def test_every_key_passes(spark, most_bits):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k"), F.when(F.col("id") % 9 > 0, F.lit("x y")).alias("a b"))
    rows = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 9 > 0, F.lit("x y")).alias("a b"), F.lit(1).alias("v"))
    f = key_filter.KeyFilter.of_keys(keys, ["k", "a b"], 1000, most_bits)
    out = f.flag(rows, ["k", "a b"], "maybe")
    assert out.columns == ["k", "a b", "v", "maybe"]
    got = {r.k: r.maybe for r in out.collect()}
    assert len(got) == 3000 and all(got[k] for k in range(0, 3000, 3))
    passed = sum(v for k, v in got.items() if k % 3)
    assert passed < (300 if most_bits > 1 << 12 else 1000)


def test_no_keys_stop_all_rows(spark):
    f = key_filter.KeyFilter.of_keys(spark.range(0).select("id"), ["id"], 0)
    assert not any(r.maybe for r in f.flag(spark.range(10), ["id"], "maybe").collect())


def test_bits_are_bounded():
    assert key_filter.bits_for(0) == key_filter.LEAST_BITS
    assert key_filter.bits_for(1 << 40) == key_filter.MOST_BITS
    assert key_filter.bits_for(1000) >= 16_000
