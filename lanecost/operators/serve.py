"""Serving aggregates over the marts: trends, top-k, scorecards, KPIs.

These replace single-threaded in-memory dataframe code with Spark aggregates.
Null grouping keys are dropped here, as the in-memory group-by did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecost.functions.expr import (
    RIGHT_ARROW,
    col,
    fmt_pct,
    period_label_col,
    period_sort_key_col,
)
from lanecost.operators.util import union_all
from lanecost.session import materialized

TOP_K = 5
MIN_FIRM_OBSERVATIONS = 10
HIGH_COST_AT_LEAST = 20.0


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def period_label(df: DataFrame, year: str = "period_year", quarter: str = "period_quarter",
                 label: str = "period_label", sort_key: str = "period_sort_key") -> DataFrame:
    """``"2016 Q2"`` label and its numeric sort key ``year * 10 + quarter``."""
    y, q = col(year), col(quarter)
    return df.withColumns({label: period_label_col(y, q), sort_key: period_sort_key_col(y, q)})


def corridor_label(df: DataFrame, names: DataFrame,
                   sending: str = "sending_country_code",
                   receiving: str = "receiving_country_code",
                   code: str = "country_iso3", name: str = "country_name",
                   out: str = "corridor_label") -> DataFrame:
    """``"Sender → Receiver"`` by country name, falling back to the code.

    ``names`` is a code -> name dimension; it is broadcast to both lookups only
    after its size and key uniqueness are checked (labels never multiply rows).
    """
    from lanecost.operators.model import checked_dim
    lookup = checked_dim(names.select(col(code).alias("__code"), col(name).alias("__name")), "__code")
    s = lookup.select(col("__code").alias("__s_code"), col("__name").alias("__s_name"))
    r = lookup.select(col("__code").alias("__r_code"), col("__name").alias("__r_name"))
    joined = (df.join(s, col(sending) == col("__s_code"), "left")
                .join(r, col(receiving) == col("__r_code"), "left"))
    label = F.concat(F.coalesce(col("__s_name"), col(sending)), F.lit(f" {RIGHT_ARROW} "),
                     F.coalesce(col("__r_name"), col(receiving)))
    return joined.withColumn(out, label).drop("__s_code", "__s_name", "__r_code", "__r_name")


def weighted_trend(trends: DataFrame, names: DataFrame, value: str = "avg_total_cost_pct",
                   weight: str = "num_observations") -> DataFrame:
    """Observation-weighted average per corridor and period.

    ``sum(v * w) / sum(w)``; a null ``v`` leaves the numerator but keeps its
    weight, so an all-null group gives 0; a zero total weight gives the plain
    mean. Medians and extremes cannot be recombined this way and are not offered.
    """
    keys = ["corridor", "corridor_label", "period_label", "period_sort_key"]
    labelled = _not_null(period_label(corridor_label(trends, names)), keys)
    v, w = col(value), col(weight)
    agg = labelled.groupBy(*[col(k) for k in keys]).agg(
        F.sum(v * w).alias("__num"), F.sum(w).alias("__den"), F.avg(v).alias("__mean"))
    weighted = F.when(col("__den") == 0, col("__mean")).otherwise(
        F.coalesce(col("__num"), F.lit(0.0)) / col("__den"))
    return (agg.select(*[col(k) for k in keys], weighted.alias(value), col("__den").alias(weight))
               .orderBy(col("period_sort_key"), col("corridor_label")))


def topk(df: DataFrame, label: str = "corridor_label", weight: str | None = "num_observations",
         k: int = TOP_K, metric: str | None = None) -> DataFrame:
    """Top ``k`` labels by summed ``weight`` (or row count); ties broken by label."""
    metric = metric or (weight if weight else "num_rows")
    measure = F.sum(col(weight)) if weight else F.count(F.lit(1))
    return (_not_null(df, [label]).groupBy(col(label)).agg(measure.alias(metric))
              .orderBy(col(metric).desc(), col(label).asc()).limit(k))


def members_of(df: DataFrame, top: DataFrame, label: str = "corridor_label") -> DataFrame:
    """Rows whose label is among ``top``; the planner sizes the join."""
    return df.join(top.select(col(label)), on=label, how="left_semi")


def options(df: DataFrame, label: str = "corridor_label") -> DataFrame:
    """Sorted distinct labels."""
    return _not_null(df, [label]).select(col(label)).distinct().orderBy(col(label))


def role_filter(df: DataFrame, role: str = "both", role_column: str = "spotlight_role") -> DataFrame:
    return df if role.lower() == "both" else df.filter(col(role_column) == role.lower())


def spotlight_trend(spot: DataFrame, names: DataFrame, value: str = "total_cost_pct") -> DataFrame:
    """Mean cost per corridor label and period, ordered by period."""
    keys = ["corridor_label", "period_label", "period_sort_key"]
    labelled = _not_null(period_label(corridor_label(spot, names)), keys)
    return (labelled.groupBy(*[col(k) for k in keys]).agg(F.avg(col(value)).alias(value))
                    .orderBy(col("period_sort_key"), col("corridor_label")))


def firm_comparison(spot: DataFrame, min_obs: int = MIN_FIRM_OBSERVATIONS,
                    value: str = "total_cost_pct",
                    disclosed: str = "is_disclosed_transparent") -> DataFrame:
    """Per firm: non-null cost count, mean cost, % disclosed (nulls skipped),
    kept when the count reaches ``min_obs``, cheapest first."""
    agg = _not_null(spot, ["firm", "firm_type"]).groupBy(col("firm"), col("firm_type")).agg(
        F.count(col(value)).alias("num_observations"),
        F.avg(col(value)).alias("avg_total_cost_pct"),
        (F.avg(col(disclosed).cast("double")) * F.lit(100)).alias("pct_disclosed_transparent"))
    return (agg.filter(col("num_observations") >= min_obs)
               .orderBy(col("avg_total_cost_pct").asc_nulls_last(), col("firm")))


def high_cost_firms(firms: DataFrame, at_least: float = HIGH_COST_AT_LEAST) -> DataFrame:
    """Firms whose mean cost is at least ``at_least``, cheapest first. The mean is
    taken at display precision (6 decimals) for threshold and order, then the name
    decides, so float noise moves no firm."""
    return (firms.withColumn("avg_total_cost_pct", F.round(col("avg_total_cost_pct"), 6))
                 .filter(col("avg_total_cost_pct") >= at_least)
                 .select("firm", "firm_type", "num_observations", "avg_total_cost_pct")
                 .orderBy("avg_total_cost_pct", "firm", "firm_type"))


def top_cost_listing(firms: DataFrame, at_least: float = HIGH_COST_AT_LEAST) -> DataFrame:
    """``high_cost_firms`` as one line of text, ``"firm (n=12), ..."``; null when there
    are none. One line is one row: for very many firms read the rows or ``listing_chunks``."""
    entry = F.concat(col("firm"), F.lit(" (n="), col("num_observations").cast("string"), F.lit(")"))
    rows = high_cost_firms(firms, at_least).select(
        entry.alias("entry"), col("avg_total_cost_pct").alias("cost"), col("firm"))
    return rows.agg(F.expr(
        "listagg(entry, ', ') WITHIN GROUP (ORDER BY cost, firm)").alias("listing"))


def listing_chunks(firms: DataFrame, at_least: float = HIGH_COST_AT_LEAST,
                   per_chunk: int = 10_000) -> DataFrame:
    """The line of ``top_cost_listing`` in chunks of ``per_chunk`` firms, for any number
    of firms: ``chunk`` (from 0), ``first_rank`` (from 0), ``firms``, ``starts_at`` (code
    points of the line before it, separators included) and ``listing``; joined by ", " in
    order they are the line. No rows where there are no such firms.

    The ordered rows are written with the number of their range partition; one count and
    one length a partition give where it starts, so firms are numbered in parallel.
    """
    order = ["avg_total_cost_pct", "firm", "firm_type"]
    entry = F.concat(col("firm"), F.lit(" (n="), col("num_observations").cast("string"), F.lit(")"))
    rows = (high_cost_firms(firms.filter(entry.isNotNull()), at_least).select(entry.alias("entry"), *order)
            .withColumns({"__part": F.spark_partition_id(), "__size": F.char_length("entry") + 2}))
    rows = materialized(rows, "listing_rows")
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)   # a row a partition
    starts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("size")).select(
        "__part", F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("__n"),
        F.coalesce(F.sum("size").over(parts), F.lit(0)).alias("__at"))
    inside = Window.partitionBy("__part").orderBy(*order)
    placed = rows.join(starts, "__part").select(
        "entry", (col("__n") + F.row_number().over(inside) - 1).alias("rank"),
        (col("__at") + F.sum("__size").over(inside) - col("__size")).alias("at"))
    return (placed.groupBy(F.floor(col("rank") / per_chunk).alias("chunk"))
            .agg(F.min("rank").alias("first_rank"), F.count(F.lit(1)).alias("firms"),
                 F.min("at").alias("starts_at"),
                 F.expr("listagg(entry, ', ') WITHIN GROUP (ORDER BY rank)").alias("listing"))
            .orderBy("chunk"))


def scorecard_view(scorecard: DataFrame, only_sufficient: bool = True) -> DataFrame:
    """Scorecard rows, worst mismatch rate first, with percentages as text."""
    df = scorecard.filter(col("has_sufficient_sample")) if only_sufficient else scorecard
    return (df.orderBy(col("pct_cost_mismatch_flagged").desc_nulls_last(), col("firm"), col("firm_type"))
              .select("firm", "firm_type", "num_observations", "num_corridors",
                      fmt_pct(col("pct_disclosed_transparent")).alias("pct_disclosed_transparent"),
                      fmt_pct(col("pct_cost_mismatch_flagged")).alias("pct_cost_mismatch_flagged"),
                      "avg_transparency_flag_count"))


def kpis(trends: DataFrame, providers: DataFrame, scorecard: DataFrame,
         spot: DataFrame, role: str = "both") -> DataFrame:
    """Headline figures as ``(kpi, value)`` rows, one aggregate for each mart."""
    focus = F.lit(True) if role.lower() == "both" else col("spotlight_role") == role.lower()
    among = lambda c: F.when(focus, col(c))

    def rows(df: DataFrame, **measures) -> DataFrame:
        one = df.agg(*[m.cast("double").alias(name) for name, m in measures.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("kpi"), col(n).alias("value"))
                                             for n in measures])))

    return union_all([
        rows(trends, corridors_tracked=F.count_distinct(col("corridor"))),
        rows(providers, provider_observations=F.count(F.lit(1))),
        rows(scorecard, firms_scored=F.count(F.lit(1))),
        rows(spot, spotlight_observations=F.count(F.lit(1)), focus_observations=F.count_if(focus),
             focus_corridors=F.count_distinct(among("corridor")), focus_firms=F.count_distinct(among("firm")),
             focus_avg_total_cost_pct=F.avg(among("total_cost_pct"))),
    ])
