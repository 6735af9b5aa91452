"""The four marts built from the flagged observations.

Aggregations are hash aggregates with map-side partial aggregation, so a hot
corridor or firm is combined before the shuffle. The median is exact: equal values are
counted, then by a value -> count map in groups of few distinct values, by counting value
ranges first in the others. ``approx_median`` is a bounded-memory sketch.

The scorecard also comes in two steps: small states per period that can be added up
(``scorecard_state``), and the scorecard of any union of them (``scorecard_of_states``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecost.functions.expr import col
from lanecost.operators.util import join_on_keys
from lanecost.session import materialized

TREND_KEYS = (
    "corridor", "sending_country_code", "receiving_country_code", "source_region",
    "destination_region_current", "period_year", "period_quarter", "cc_number",
    "send_amount", "is_disclosed_transparent",
)

CHANNEL_COLUMNS = (
    "firm", "firm_type", "corridor", "sending_country_code", "receiving_country_code",
    "period_year", "period_quarter", "cc_number", "send_amount", "payment_instrument",
    "pickup_method", "speed_actual", "access_point", "receiving_network_coverage",
    "is_disclosed_transparent", "total_cost_pct", "fee_cost_pct", "fx_margin_pct",
    "decomposed_cost_pct", "cost_mismatch_flag",
)

MIN_SAMPLE = 30
# A group with more distinct values than this (as estimated) gets no value -> count map.
MAX_MAP_VALUES = 100_000
RANGES = 64
NAN_RANGE = (1 << 63) - 1


def median_by_ranges(df: DataFrame, keys: Sequence[str], value: str, out: str,
                     width: float | None = None, pieces: int = RANGES, weight: str | None = None) -> DataFrame:
    """Exact median of the non-null ``value`` per ``keys`` (nulls are a key), with
    no per-group buffer of its values. With ``weight`` a row stands for that many rows.

    Equal values are counted first, then value ranges; running counts of the ranges
    show which one or two hold the middle, and only their values are put in order, a
    range a window partition. A group's rows are thus spread by value, and a task sorts
    (and may spill) the distinct values of one range. The ranges are cut at approximate
    quantiles of each group's own distinct values, ``pieces`` of them, so they hold about as
    many of them each however they lie; with ``width`` they have that fixed width. Where the
    cuts fall has no influence on the result. NaN is the largest value; a group without values
    has no row.
    """
    key_cols = [col(k) for k in keys]
    v = col(value).cast("double")
    n = F.lit(1) if weight is None else col(weight)
    values = df.select(*key_cols, v.alias("__v"), n.alias("__w")).filter(col("__v").isNotNull())
    counts = values.groupBy(*key_cols, col("__v")).agg(F.sum("__w").alias("__n"))
    if width is None:
        cuts = counts.filter(~F.isnan("__v")).groupBy(*key_cols).agg(F.percentile_approx(
            col("__v"), [i / pieces for i in range(1, pieces)], 20 * pieces).alias("__cuts"))
        counts = join_on_keys(counts, cuts, keys, "left")
        at = F.size(F.filter(col("__cuts"), lambda cut: cut < col("__v"))).cast("long")
    else:
        at = F.floor(col("__v") / width)
    counts = counts.withColumn(
        "__range", F.when(F.isnan("__v"), F.lit(NAN_RANGE)).otherwise(at)).drop("__cuts")
    ranges = counts.groupBy(*key_cols, col("__range")).agg(F.sum("__n").alias("__in"))
    group = Window.partitionBy(*key_cols)
    total = F.sum("__in").over(group)
    ranges = ranges.withColumns({
        "__before": F.sum("__in").over(group.orderBy("__range")) - col("__in"),
        "__lo": F.floor((total - 1) / 2), "__hi": F.floor(total / 2)})
    ranges = ranges.filter((col("__before") <= col("__hi")) & (col("__before") + col("__in") > col("__lo")))
    inside = join_on_keys(counts, ranges.drop("__in"), [*keys, "__range"])
    upto = col("__before") + F.sum("__n").over(
        Window.partitionBy(*key_cols, col("__range")).orderBy("__v"))
    at = inside.withColumn("__upto", upto)

    def ranked(rank: str):
        here = (col("__upto") > col(rank)) & (col("__upto") - col("__n") <= col(rank))
        return F.max(F.when(here, col("__v")))

    return at.groupBy(*key_cols).agg((ranked("__lo") * 0.5 + ranked("__hi") * 0.5).alias(out))


def corridor_cost_trends(flagged: DataFrame, approx_median: bool = False,
                         ranged_median: bool | None = None, stored: bool = False,
                         max_values: int = MAX_MAP_VALUES) -> DataFrame:
    """One row per corridor / period / tier / disclosure status (null groups kept).

    The median is exact: equal costs of a group are counted first, by a plain hash aggregate.
    Groups of up to ``max_values`` distinct costs then take their median from a
    value -> count map, the others by ranges of values (``median_by_ranges``), so no map
    grows with the data. ``ranged_median`` fixes one way for all groups: ranges (True) or
    maps (False). Rows are read more than once, so the few columns needed are written
    to shared scratch first, unless ``stored`` says that ``flagged`` is read from files.
    """
    cost = col("total_cost_pct")
    if approx_median and ranged_median:
        raise ValueError("choose one way of taking the median")
    if not stored:
        needed = (*TREND_KEYS, "firm", "total_cost_pct", "fee_cost_pct", "fx_margin_pct",
                  "decomposed_cost_pct", "cost_mismatch_flag")
        flagged = materialized(flagged.select(*[col(c) for c in needed]), "trend_rows")
    keys = [col(k) for k in TREND_KEYS]
    if approx_median:
        return _trends(flagged, flagged.groupBy(*keys).agg(F.percentile_approx(cost, 0.5, 10000).alias("__median")))
    counts = flagged.filter(cost.isNotNull()).groupBy(*keys, cost).agg(F.count(F.lit(1)).alias("__n"))
    counts = materialized(counts, "trend_costs")
    by_ranges = lambda c: median_by_ranges(c, TREND_KEYS, "total_cost_pct", "__median", weight="__n")
    by_maps = lambda c: c.groupBy(*keys).agg(F.expr("percentile(total_cost_pct, 0.5, __n)").alias("__median"))
    if ranged_median is not None:
        return _trends(flagged, by_ranges(counts) if ranged_median else by_maps(counts))
    many = (counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__values"))
                  .filter(col("__values") > max_values).select(*keys, F.lit(True).alias("__many")))
    many = materialized(many, "trend_groups_of_many_values")
    if many.isEmpty():
        return _trends(flagged, by_maps(counts))
    marked = join_on_keys(counts, many, TREND_KEYS, "left")
    few = by_maps(marked.filter(col("__many").isNull()))
    return _trends(flagged, few.unionByName(by_ranges(marked.filter(col("__many")))))


def _trends(flagged: DataFrame, medians: DataFrame) -> DataFrame:
    """The mart, with the column ``__median`` of ``medians``. Distinct firms and medians are
    aggregates of their own: beside a distinct count, every other aggregate is kept a group
    and firm, a median's map included."""
    cost, keys = col("total_cost_pct"), [col(k) for k in TREND_KEYS]
    stats = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_observations"),
        F.avg(cost).alias("avg_total_cost_pct"),
        F.min(cost).alias("min_total_cost_pct"),
        F.max(cost).alias("max_total_cost_pct"),
        F.avg(col("fee_cost_pct")).alias("avg_fee_cost_pct"),
        F.avg(col("fx_margin_pct")).alias("avg_fx_margin_pct"),
        F.avg(col("decomposed_cost_pct")).alias("avg_decomposed_cost_pct"),
        F.count_if(col("cost_mismatch_flag")).alias("num_cost_mismatch_flagged"),
    )
    firms = (flagged.select(*keys, col("firm")).distinct()
                    .groupBy(*keys).agg(F.count("firm").alias("num_providers")))
    joined = join_on_keys(join_on_keys(stats, firms, TREND_KEYS), medians, TREND_KEYS, "left")
    return joined.select(
        *keys, "num_observations", "num_providers", "avg_total_cost_pct",
        col("__median").cast("double").alias("median_total_cost_pct"), "min_total_cost_pct", "max_total_cost_pct",
        "avg_fee_cost_pct", "avg_fx_margin_pct", "avg_decomposed_cost_pct", "num_cost_mismatch_flagged")


def provider_comparison(flagged: DataFrame) -> DataFrame:
    """Channel-grain pass-through of the comparison columns."""
    return flagged.select(*[col(c) for c in CHANNEL_COLUMNS])


def transparency_scorecard(flagged: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """One row per firm: disclosure rates, mismatch rate, sample sufficiency.

    A null disclosure counts as not disclosed here (unlike ``firm_comparison``).
    """
    pct = lambda c: F.avg(F.when(col(c), F.lit(100.0)).otherwise(F.lit(0.0)))
    flagged_n = F.count_if(col("cost_mismatch_flag"))
    evaluable_n = F.count_if(col("cost_mismatch_flag").isNotNull())
    return flagged.groupBy(col("firm"), col("firm_type")).agg(
        F.count(F.lit(1)).alias("num_observations"),
        F.count_distinct(col("corridor")).alias("num_corridors"),
        F.count_distinct(col("period_year"), col("period_quarter")).alias("num_periods"),
        pct("is_disclosed_transparent").alias("pct_disclosed_transparent"),
        pct("total_cost_pct_missing").alias("pct_total_cost_pct_missing"),
        pct("cost_components_missing").alias("pct_cost_components_missing"),
        flagged_n.alias("num_cost_mismatch_flagged"),
        evaluable_n.alias("num_cost_mismatch_evaluable"),
        (flagged_n / F.nullif(evaluable_n, F.lit(0)) * F.lit(100)).alias("pct_cost_mismatch_flagged"),
        F.avg(col("transparency_flag_count")).alias("avg_transparency_flag_count"),
        (F.count(F.lit(1)) >= F.lit(min_sample)).alias("has_sufficient_sample"),
    )


STATE_KEYS = ("firm", "firm_type", "corridor", "period_year", "period_quarter")


def scorecard_state(flagged: DataFrame) -> DataFrame:
    """Whole-number counts per firm, corridor and quarter, from which the scorecard of any
    union of disjoint sets of rows follows exactly (the sets are kept as rows, as distinct
    corridors and quarters cannot be added up)."""
    flags = col("transparency_flag_count")
    return flagged.groupBy(*[col(k) for k in STATE_KEYS]).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(col("is_disclosed_transparent")).alias("disclosed"),
        F.count_if(col("total_cost_pct_missing")).alias("total_missing"),
        F.count_if(col("cost_components_missing")).alias("components_missing"),
        F.count_if(col("cost_mismatch_flag")).alias("mismatched"),
        F.count_if(col("cost_mismatch_flag").isNotNull()).alias("evaluable"),
        F.sum(flags).cast("long").alias("flags"),
        F.count(flags).alias("flag_rows"),
    )


def scorecard_of_states(states: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """``transparency_scorecard`` of the rows behind ``states``, same columns and values."""
    n, mismatched, evaluable = F.sum("n"), F.sum("mismatched"), F.sum("evaluable")
    pct = lambda c: F.sum(c) * F.lit(100.0) / n
    return states.groupBy(col("firm"), col("firm_type")).agg(
        n.alias("num_observations"),
        F.count_distinct(col("corridor")).alias("num_corridors"),
        F.count_distinct(col("period_year"), col("period_quarter")).alias("num_periods"),
        pct("disclosed").alias("pct_disclosed_transparent"),
        pct("total_missing").alias("pct_total_cost_pct_missing"),
        pct("components_missing").alias("pct_cost_components_missing"),
        mismatched.alias("num_cost_mismatch_flagged"),
        evaluable.alias("num_cost_mismatch_evaluable"),
        (mismatched / F.nullif(evaluable, F.lit(0)) * F.lit(100)).alias("pct_cost_mismatch_flagged"),
        (F.sum("flags") / F.nullif(F.sum("flag_rows"), F.lit(0))).alias("avg_transparency_flag_count"),
        (n >= F.lit(min_sample)).alias("has_sufficient_sample"),
    )


def spotlight(flagged: DataFrame, country: str, role_column: str = "spotlight_role") -> DataFrame:
    """Channel rows where ``country`` sends or receives; 'sending' wins when both."""
    s, r = col("sending_country_code"), col("receiving_country_code")
    cols = list(CHANNEL_COLUMNS)
    out = flagged.filter((s == country) | (r == country)).withColumn(
        role_column, F.when(s == country, F.lit("sending")).when(r == country, F.lit("receiving")))
    at = cols.index("receiving_country_code") + 1
    return out.select(*[col(c) for c in cols[:at]], col(role_column), *[col(c) for c in cols[at:]])
