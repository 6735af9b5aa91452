"""Small planning helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecost.functions.expr import col

def rename_keys(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[col(c).alias(prefix + c) if c in keys else col(c) for c in df.columns])


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating nulls as equal; the right side's keys are dropped."""
    r = rename_keys(right, keys, "__r_")
    cond = reduce(lambda a, b: a & b,
                  [col(k).eqNullSafe(col("__r_" + k)) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi"):
        return out
    return out.drop(*["__r_" + k for k in keys])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def replicate(df: DataFrame, times: str, keys: Sequence[str],
              chunk: int = 1 << 20) -> DataFrame:
    """Emit each row ``times`` times, spreading huge counts over many tasks.

    A row first becomes one row per chunk of at most ``chunk`` copies; those few
    rows are hash-distributed, then each expands locally. A single row asking for
    a billion copies therefore never lands on one task.
    """
    n = col(times)
    chunks = df.filter(n > 0).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("long"))))
    spread = chunks.repartition(*[col(k) for k in keys], col("__chunk"))
    lo = col("__chunk") * chunk + 1
    hi = F.least(lo + (chunk - 1), n.cast("long"))
    return (spread.withColumn("__i", F.explode(F.sequence(lo, hi)))
                  .drop("__chunk", "__i"))
