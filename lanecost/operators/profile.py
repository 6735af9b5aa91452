"""Profile of a raw table as one long ``(section, item, value)`` frame.

Shape, columns, sentinel counts per column (only those above zero), the first
sorted periods, the tier-prefixed columns and the value counts of one category
column including null, all computed as Spark aggregates: one pass for the
sentinel counts, a distinct for the periods, a group-by for the value counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lanecost.functions.expr import col
from lanecost.operators.clean import NULL_MARKER, TIER_PREFIXES
from lanecost.operators.util import union_all

SAMPLE_PERIODS = 10


def profile_table(df: DataFrame, marker: str = NULL_MARKER, category: str = "transparent",
                  period: str = "period", prefixes: Sequence[str] = TIER_PREFIXES,
                  sample_periods: int = SAMPLE_PERIODS) -> DataFrame:
    spark = df.sparkSession
    schema = T.StructType([T.StructField("section", T.StringType()),
                           T.StructField("item", T.StringType()),
                           T.StructField("value", T.LongType())])

    def meta(section: str, items: list[tuple[str, int]]) -> DataFrame:
        return spark.createDataFrame([(section, i, v) for i, v in items], schema)

    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(col(c) == marker).alias(f"_{i}") for i, c in enumerate(text_cols)])
    pairs = [F.struct(F.lit("rows").alias("item"), col("__rows").alias("value"))]
    shape = counts.select(F.inline(F.array(*pairs))).select(F.lit("shape").alias("section"), "item", "value")
    markers = (counts.select(F.inline(F.array(*[
                   F.struct(F.lit(c).alias("item"), col(f"_{i}").alias("value"))
                   for i, c in enumerate(text_cols)]))) if text_cols else None)
    frames = [shape, meta("shape", [("columns", len(df.columns))]),
              meta("columns", [(c, i + 1) for i, c in enumerate(df.columns)]),
              meta("tier_columns", [(c, i + 1) for i, c in
                                    enumerate([c for c in df.columns if c.startswith(tuple(prefixes))])])]
    if markers is not None:
        frames.append(markers.filter(col("value") > 0)
                             .select(F.lit("marker_count").alias("section"), "item", "value"))
    if period in df.columns:
        periods = df.select(col(period).alias("item")).filter(col("item").isNotNull()).distinct()
        first = (periods.orderBy("item").limit(sample_periods)
                        .withColumn("value", F.row_number().over(Window.orderBy("item")).cast("long")))
        frames.append(first.select(F.lit("periods").alias("section"), "item", "value"))
    if category in df.columns:
        vc = df.groupBy(col(category).alias("item")).agg(F.count(F.lit(1)).alias("value"))
        frames.append(vc.select(F.lit("value_counts").alias("section"), "item", "value"))
    frames.append(dtypes(df))
    return union_all(frames)


def dtypes(df: DataFrame) -> DataFrame:
    """``(section, item, value)``: each column's type, by position."""
    rows = [("dtypes", f"{c} {t}", i) for i, (c, t) in enumerate(df.dtypes, 1)]
    return df.sparkSession.createDataFrame(rows, "section string, item string, value long")


def sample_rows(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first few rows in a stated order (then by every other column, nulls first)."""
    rest = [c for c in df.columns if c not in order_by]
    return df.orderBy(*[col(c).asc_nulls_first() for c in [*order_by, *rest]]).limit(rows)


def distinct_periods(df: DataFrame, period: str = "period") -> DataFrame:
    return df.select(col(period)).distinct()
