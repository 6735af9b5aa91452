"""Registered queries: one per operator of the inventory, each over the shared
tables at ``sf_dir``, each paired with DuckDB SQL computing the same rows.

Aggregated doubles are rounded to 6 decimals on both sides (summation order
differs between engines); everything else is compared exactly.
"""

from __future__ import annotations

from lanecost.session import COMPACT, materialized, open_files, small_methods

from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.catalog import oracle as O
from lanecost.functions.expr import col
from lanecost.operators import clean as C
from lanecost.operators import marts as M
from lanecost.operators import model as Mo
from lanecost.plans import flows
from lanecost.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODEL_CFG = flows.ModelConfig(remap=FX.CODE_REMAP, zones=FX.CFA_ZONES,
                              spotlight_country=FX.SPOTLIGHT_COUNTRY)


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(col(c), 6) for c in columns})


# ---- shared building blocks (lazy; Spark reuses identical exchanges) -------------

def wide(spark: SparkSession, d: str) -> DataFrame:
    return FX.wide_quotes(spark, d)


def long(spark: SparkSession, d: str) -> DataFrame:
    return flows.curate_long(wide(spark, d))


def curated(spark: SparkSession, d: str):
    return flows.curate(wide(spark, d))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    clean, _ = curated(spark, d)
    return flows.build_flagged(clean, FX.country_dim(spark, d), FX.currency_dim(spark, d), MODEL_CFG)


def marts(spark: SparkSession, d: str) -> Mapping[str, DataFrame]:
    return flows.build_marts(flagged(spark, d), MODEL_CFG)


TREND_DOUBLES = ("avg_total_cost_pct", "median_total_cost_pct", "avg_fee_cost_pct",
                 "avg_fx_margin_pct", "avg_decomposed_cost_pct")
SCORE_DOUBLES = ("pct_disclosed_transparent", "pct_total_cost_pct_missing",
                 "pct_cost_components_missing", "pct_cost_mismatch_flagged",
                 "avg_transparency_flag_count")


# ---- marts (flagship first) ----------------------------------------------------

def _round_sql(source: str, columns) -> str:
    reps = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({reps}) FROM {source}"


@register("corridor_cost_trends", O.with_ctes(_round_sql("trends", (
    "avg_total_cost_pct", "median_total_cost_pct", "avg_fee_cost_pct", "avg_fx_margin_pct",
    "avg_decomposed_cost_pct"))))
def q_corridor_cost_trends(spark, d):
    return r6(M.corridor_cost_trends(flagged(spark, d)), *TREND_DOUBLES)


@register("corridor_cost_trends_ranged", ORACLE["corridor_cost_trends"])
def q_corridor_cost_trends_ranged(spark, d):
    return r6(M.corridor_cost_trends(flagged(spark, d), ranged_median=True), *TREND_DOUBLES)


@register("corridor_cost_trends_mixed", ORACLE["corridor_cost_trends"])
def q_corridor_cost_trends_mixed(spark, d):
    """Groups of over four distinct costs by ranges, the others by maps."""
    return r6(M.corridor_cost_trends(flagged(spark, d), max_values=4), *TREND_DOUBLES)


@register("transparency_scorecard", O.with_ctes(_round_sql("scorecard", (
    "pct_disclosed_transparent", "pct_total_cost_pct_missing", "pct_cost_components_missing",
    "pct_cost_mismatch_flagged", "avg_transparency_flag_count"))))
def q_transparency_scorecard(spark, d):
    return r6(M.transparency_scorecard(flagged(spark, d)), *SCORE_DOUBLES)


@register("provider_comparison", O.with_ctes("SELECT * FROM providers"))
def q_provider_comparison(spark, d):
    return M.provider_comparison(flagged(spark, d))


@register("spotlight", O.with_ctes("SELECT * FROM spot"))
def q_spotlight(spark, d):
    return M.spotlight(flagged(spark, d), FX.SPOTLIGHT_COUNTRY)


# ---- cleaning / reshaping --------------------------------------------------------

@register("null_sentinel", O.with_ctes("SELECT * FROM sent"))
def q_null_sentinel(spark, d):
    return C.null_sentinel(wide(spark, d))


@register("parse_mixed_date", O.with_ctes("SELECT id, date, date_raw FROM dated"))
def q_parse_mixed_date(spark, d):
    return C.parse_mixed_date(wide(spark, d)).select("id", "date", "date_raw")


@register("parse_period", O.with_ctes(
    "SELECT id, period, period_year, period_quarter FROM periods"))
def q_parse_period(spark, d):
    return C.parse_period(wide(spark, d)).select("id", "period", "period_year", "period_quarter")


@register("unpivot_sides", O.with_ctes("SELECT * FROM unp"))
def q_unpivot_sides(spark, d):
    return long(spark, d)


@register("dedup_grain", O.with_ctes("SELECT * FROM clean"))
def q_dedup_grain(spark, d):
    return curated(spark, d)[0]


@register("dedup_grain_report", O.with_ctes("SELECT * FROM grain_report"))
def q_dedup_grain_report(spark, d):
    return curated(spark, d)[1]["grain_duplicates"]


@register("stage_typed", O.with_ctes("SELECT * FROM staged"))
def q_stage_typed(spark, d):
    return Mo.stage_typed(Mo.conform_landing(curated(spark, d)[0]))


@register("enrich_corridor", O.with_ctes("SELECT * FROM enriched"))
def q_enrich_corridor(spark, d):
    staged = Mo.stage_typed(Mo.conform_landing(curated(spark, d)[0]))
    return Mo.enrich_corridor(staged, FX.country_dim(spark, d), FX.currency_dim(spark, d),
                              FX.CODE_REMAP, FX.CFA_ZONES)


@register("build_flagged", O.with_ctes("SELECT * FROM flagged"))
def q_build_flagged(spark, d):
    return flagged(spark, d)


# ---- more of the model chain -----------------------------------------------------

def staged(spark, d):
    return Mo.stage_typed(Mo.conform_landing(curated(spark, d)[0]))


def enriched(spark, d):
    return Mo.enrich_corridor(staged(spark, d), FX.country_dim(spark, d), FX.currency_dim(spark, d),
                              FX.CODE_REMAP, FX.CFA_ZONES)


KEY = ("raw_id", "cc_number")


@register("conform_landing", O.with_ctes("SELECT * FROM landing"))
def q_conform_landing(spark, d):
    return Mo.conform_landing(curated(spark, d)[0])


@register("corridor_codes", O.with_ctes(
    "SELECT raw_id, cc_number, corridor, sending_country_code, receiving_country_code FROM codes"))
def q_corridor_codes(spark, d):
    return (Mo.corridor_codes(staged(spark, d), remap=FX.CODE_REMAP)
              .select(*KEY, "corridor", "sending_country_code", "receiving_country_code"))


@register("resolve_currency", O.with_ctes(
    "SELECT raw_id, cc_number, corridor, lcu_code, lcu_code_resolved FROM codes"))
def q_resolve_currency(spark, d):
    return (Mo.resolve_currency(staged(spark, d), zones=FX.CFA_ZONES)
              .select(*KEY, "corridor", "lcu_code", "lcu_code_resolved"))


@register("star_except", O.with_ctes(
    "SELECT * EXCLUDE (fx_margin), fx_margin AS fx_margin_pct FROM enriched"))
def q_star_except(spark, d):
    return Mo.star_except(enriched(spark, d), "fx_margin", "fx_margin_pct")


@register("fee_pct", O.with_ctes(
    "SELECT raw_id, cc_number, lcu_fee, lcu_amount, fee_cost_pct FROM components"))
def q_fee_pct(spark, d):
    return Mo.cost_decompose(enriched(spark, d)).select(*KEY, "lcu_fee", "lcu_amount", "fee_cost_pct")


@register("cost_decompose", O.with_ctes("SELECT * FROM decomposed"))
def q_cost_decompose(spark, d):
    return Mo.cost_decompose(enriched(spark, d))


@register("norm_bool", O.with_ctes(
    "SELECT raw_id, cc_number, transparent, is_disclosed_transparent FROM flagged"))
def q_norm_bool(spark, d):
    return flagged(spark, d).select(*KEY, "transparent", "is_disclosed_transparent")


@register("missing_flags", O.with_ctes(
    "SELECT raw_id, cc_number, total_cost_pct_missing, cost_components_missing FROM flagged"))
def q_missing_flags(spark, d):
    return flagged(spark, d).select(*KEY, "total_cost_pct_missing", "cost_components_missing")


@register("cost_mismatch", O.with_ctes(
    "SELECT raw_id, cc_number, decomposed_cost_pct, total_cost_pct, cost_mismatch_flag FROM flagged"))
def q_cost_mismatch(spark, d):
    return flagged(spark, d).select(*KEY, "decomposed_cost_pct", "total_cost_pct", "cost_mismatch_flag")


@register("flag_count", O.with_ctes("SELECT raw_id, cc_number, transparency_flag_count FROM flagged"))
def q_flag_count(spark, d):
    return flagged(spark, d).select(*KEY, "transparency_flag_count")


# ---- guards, splits, duplicate flags ---------------------------------------------

REQUIRED = list(C.GEOGRAPHY_COLUMNS) + ["date", "period"]


@register("require_columns", O.with_ctes(f"SELECT {O.qs(REQUIRED)} FROM wide"))
def q_require_columns(spark, d):
    return C.require_columns(wide(spark, d), REQUIRED).select(*[col(c) for c in REQUIRED])


@register("scan_guarded", O.with_ctes("SELECT * FROM wide"))
def q_scan_guarded(spark, d):
    # through a real file: written, then read with both guards on
    w = wide(spark, d)
    path = scratch_path(spark, "guarded")
    w.write.parquet(path)
    return Sc.scan_guarded(spark, path, expected_columns=len(O.WIDE_COLUMNS),
                           expected_rows=spark.read.parquet(path).count(), strict_rows=True)


@register("split_negative", O.with_ctes('SELECT * FROM clean WHERE "fx margin" < 0'))
def q_split_negative(spark, d):
    from lanecost.operators.splits import split_negative
    return split_negative(curated(spark, d)[0])[1]


@register("split_negative_clean", O.with_ctes(
    'SELECT * FROM clean WHERE NOT ("fx margin" < 0) OR "fx margin" IS NULL'))
def q_split_negative_clean(spark, d):
    from lanecost.operators.splits import split_negative
    return split_negative(curated(spark, d)[0])[0]


@register("split_nontransparent", O.with_ctes(
    "SELECT * FROM clean WHERE lower(trim(transparent)) = 'no'"))
def q_split_nontransparent(spark, d):
    from lanecost.operators.splits import split_nontransparent
    return split_nontransparent(curated(spark, d)[0])[1]


@register("split_nontransparent_clean", O.with_ctes(
    "SELECT * FROM clean WHERE NOT (lower(trim(transparent)) = 'no') OR transparent IS NULL"))
def q_split_nontransparent_clean(spark, d):
    from lanecost.operators.splits import split_nontransparent
    return split_nontransparent(curated(spark, d)[0])[0]


_DUPS = (f"SELECT *, count(*) OVER (PARTITION BY {O.qs(O.GRAIN_COLUMNS)}) AS duplicate_count "
         "FROM unp")


@register("flag_duplicates", O.with_ctes(f"SELECT * FROM ({_DUPS}) WHERE duplicate_count > 1"))
def q_flag_duplicates(spark, d):
    from lanecost.operators.dedup import flag_duplicates
    return flag_duplicates(long(spark, d))[1]


@register("flag_duplicates_clean", O.with_ctes(
    f"SELECT * EXCLUDE (duplicate_count) FROM ({_DUPS}) WHERE duplicate_count = 1"))
def q_flag_duplicates_clean(spark, d):
    from lanecost.operators.dedup import flag_duplicates
    return flag_duplicates(long(spark, d))[0]


_REPORTS_SQL = """
SELECT 'grain_duplicates' AS {c}, CAST(count(*) AS BIGINT) AS rows FROM grain_report
UNION ALL SELECT 'fx_margin', CAST(count(*) AS BIGINT) FROM clean WHERE "fx margin" < 0
UNION ALL SELECT 'transparency', CAST(count(*) AS BIGINT) FROM clean WHERE lower(trim(transparent)) = 'no'
UNION ALL SELECT 'duplicate_check', CAST(count(*) AS BIGINT) FROM (
  SELECT count(*) OVER (PARTITION BY {g}) AS n FROM clean) WHERE n > 1"""


@register("report_counts", O.with_ctes(_REPORTS_SQL.format(c="check", g=O.qs(O.GRAIN_COLUMNS))))
def q_report_counts(spark, d):
    return flows.report_counts(curated(spark, d)[1])


@register("curate_quotes", O.with_ctes("SELECT * FROM clean"))
def q_curate_quotes(spark, d):
    clean, _ = curated(spark, d)
    return clean


@register("distinct_periods", O.with_ctes("SELECT DISTINCT period FROM clean"))
def q_distinct_periods(spark, d):
    from lanecost.operators.profile import distinct_periods
    return distinct_periods(curated(spark, d)[0])


# ---- serving layer -----------------------------------------------------------------

from lanecost.operators import serve as S  # noqa: E402

FIXTURE_MIN_OBS = 10
FIXTURE_AT_LEAST = 9.5   # mean-cost threshold for the high-cost listing on this data


def names(spark, d):
    return FX.country_dim(spark, d)


def wtrend(spark, d):
    return S.weighted_trend(marts(spark, d)["corridor_cost_trends"], names(spark, d))


def spot_rows(spark, d):
    return marts(spark, d)["spotlight"]


@register("period_label", O.with_ctes(
    "SELECT corridor, cc_number, is_disclosed_transparent, period_year, period_quarter, "
    "period_label, period_sort_key FROM trend_lab"))
def q_period_label(spark, d):
    return S.period_label(marts(spark, d)["corridor_cost_trends"]).select(
        "corridor", "cc_number", "is_disclosed_transparent", "period_year", "period_quarter",
        "period_label", "period_sort_key")


@register("corridor_label", O.with_ctes(
    "SELECT corridor, cc_number, period_year, period_quarter, is_disclosed_transparent, "
    "corridor_label FROM trend_lab"))
def q_corridor_label(spark, d):
    return S.corridor_label(marts(spark, d)["corridor_cost_trends"], names(spark, d)).select(
        "corridor", "cc_number", "period_year", "period_quarter", "is_disclosed_transparent",
        "corridor_label")


@register("weighted_trend", O.with_ctes(
    "SELECT * REPLACE (round(avg_total_cost_pct, 6) AS avg_total_cost_pct) FROM wt"))
def q_weighted_trend(spark, d):
    return r6(wtrend(spark, d), "avg_total_cost_pct")


_TOPK_SQL = ("SELECT corridor_label, CAST(sum(num_observations) AS BIGINT) AS num_observations "
             "FROM wt WHERE corridor_label IS NOT NULL GROUP BY corridor_label "
             "ORDER BY num_observations DESC, corridor_label ASC LIMIT 5")


@register("topk_corridors", O.with_ctes(_TOPK_SQL))
def q_topk_corridors(spark, d):
    return S.topk(wtrend(spark, d), "corridor_label", "num_observations", 5)


@register("topk_members", O.with_ctes(
    "SELECT * REPLACE (round(avg_total_cost_pct, 6) AS avg_total_cost_pct) FROM wt "
    f"WHERE corridor_label IN (SELECT corridor_label FROM ({_TOPK_SQL}))"))
def q_topk_members(spark, d):
    t = wtrend(spark, d)
    return r6(S.members_of(t, S.topk(t, "corridor_label", "num_observations", 5)), "avg_total_cost_pct")


@register("corridor_options", O.with_ctes(
    "SELECT DISTINCT corridor_label FROM wt WHERE corridor_label IS NOT NULL"))
def q_corridor_options(spark, d):
    return S.options(wtrend(spark, d))


@register("role_filter", O.with_ctes("SELECT * FROM spot WHERE spotlight_role = 'receiving'"))
def q_role_filter(spark, d):
    return S.role_filter(spot_rows(spark, d), "Receiving")


@register("spotlight_trend", O.with_ctes(
    "SELECT corridor_label, period_label, period_sort_key, round(avg(total_cost_pct), 6) AS total_cost_pct "
    "FROM spot_lab WHERE corridor_label IS NOT NULL AND period_label IS NOT NULL "
    "AND period_sort_key IS NOT NULL GROUP BY corridor_label, period_label, period_sort_key"))
def q_spotlight_trend(spark, d):
    return r6(S.spotlight_trend(spot_rows(spark, d), names(spark, d)), "total_cost_pct")


@register("topk_corridors_rows", O.with_ctes(
    "SELECT corridor_label, CAST(count(*) AS BIGINT) AS num_rows FROM spot_lab "
    "WHERE corridor_label IS NOT NULL GROUP BY corridor_label "
    "ORDER BY num_rows DESC, corridor_label ASC LIMIT 5"))
def q_topk_corridors_rows(spark, d):
    return S.topk(S.corridor_label(spot_rows(spark, d), names(spark, d)), "corridor_label", None, 5)


@register("firm_comparison", O.with_ctes(
    "SELECT firm, firm_type, num_observations, round(avg_total_cost_pct, 6) AS avg_total_cost_pct, "
    f"round(pct_disclosed_transparent, 6) AS pct_disclosed_transparent FROM firms "
    f"WHERE num_observations >= {FIXTURE_MIN_OBS}"))
def q_firm_comparison(spark, d):
    return r6(S.firm_comparison(spot_rows(spark, d), FIXTURE_MIN_OBS),
              "avg_total_cost_pct", "pct_disclosed_transparent")


@register("top_cost_listing", O.with_ctes(
    "SELECT string_agg(firm || ' (n=' || CAST(num_observations AS VARCHAR) || ')', ', ' "
    "ORDER BY round(avg_total_cost_pct, 6), firm) AS listing FROM firms "
    f"WHERE num_observations >= {FIXTURE_MIN_OBS} AND round(avg_total_cost_pct, 6) >= {FIXTURE_AT_LEAST}"))
def q_top_cost_listing(spark, d):
    return S.top_cost_listing(S.firm_comparison(spot_rows(spark, d), FIXTURE_MIN_OBS), FIXTURE_AT_LEAST)


@register("high_cost_firms", O.with_ctes(
    "SELECT firm, firm_type, num_observations, round(avg_total_cost_pct, 6) AS avg_total_cost_pct FROM firms "
    f"WHERE num_observations >= {FIXTURE_MIN_OBS} AND round(avg_total_cost_pct, 6) >= {FIXTURE_AT_LEAST}"))
def q_high_cost_firms(spark, d):
    return S.high_cost_firms(S.firm_comparison(spot_rows(spark, d), FIXTURE_MIN_OBS), FIXTURE_AT_LEAST)


_CHUNK = 3


@register("top_cost_listing_chunks", O.with_ctes(
    "high AS (SELECT firm || ' (n=' || CAST(num_observations AS VARCHAR) || ')' AS entry, "
    "row_number() OVER (ORDER BY round(avg_total_cost_pct, 6), firm, firm_type) - 1 AS rank FROM firms "
    f"WHERE num_observations >= {FIXTURE_MIN_OBS} AND round(avg_total_cost_pct, 6) >= {FIXTURE_AT_LEAST}), "
    "placed AS (SELECT *, CAST(sum(length(entry) + 2) OVER (ORDER BY rank) AS BIGINT) - length(entry) - 2 AS begins FROM high)",
    f"SELECT rank // {_CHUNK} AS chunk, min(rank) AS first_rank, count(*) AS firms, min(begins) AS starts_at, "
    f"string_agg(entry, ', ' ORDER BY rank) AS listing FROM placed GROUP BY rank // {_CHUNK}"))
def q_top_cost_listing_chunks(spark, d):
    return S.listing_chunks(S.firm_comparison(spot_rows(spark, d), FIXTURE_MIN_OBS), FIXTURE_AT_LEAST, _CHUNK)


_PCT = "CASE WHEN {c} IS NULL OR isnan({c}) THEN '–' ELSE printf('%.2f%%', {c}) END"


@register("scorecard_view", O.with_ctes(
    "SELECT firm, firm_type, num_observations, num_corridors, "
    f"{_PCT.format(c='pct_disclosed_transparent')} AS pct_disclosed_transparent, "
    f"{_PCT.format(c='pct_cost_mismatch_flagged')} AS pct_cost_mismatch_flagged, "
    "round(avg_transparency_flag_count, 6) AS avg_transparency_flag_count "
    "FROM scorecard WHERE has_sufficient_sample"))
def q_scorecard_view(spark, d):
    return r6(S.scorecard_view(marts(spark, d)["transparency_scorecard"]),
              "avg_transparency_flag_count")


# means are summed in a different order by each engine; a mean whose exact value
# is a tie at the printed precision would round on float noise, so both sides
# format the mean at 6 decimals
@register("fmt_pct", O.with_ctes(
    f"SELECT firm, firm_type, {_PCT.format(c='round(avg_total_cost_pct, 6)')} AS avg_total_cost_text, "
    f"{_PCT.format(c='round(pct_disclosed_transparent, 6)')} AS pct_disclosed_text FROM firms"))
def q_fmt_pct(spark, d):
    from lanecost.functions.expr import fmt_pct
    firms = r6(S.firm_comparison(spot_rows(spark, d), 0),
               "avg_total_cost_pct", "pct_disclosed_transparent")
    return firms.select("firm", "firm_type",
                        fmt_pct(col("avg_total_cost_pct")).alias("avg_total_cost_text"),
                        fmt_pct(col("pct_disclosed_transparent")).alias("pct_disclosed_text"))


@register("fmt_count", O.with_ctes(
    "SELECT corridor, format('{:,}', CAST(sum(num_observations) AS BIGINT)) AS observations_text "
    "FROM trends GROUP BY corridor"))
def q_fmt_count(spark, d):
    from lanecost.functions.expr import fmt_count
    t = marts(spark, d)["corridor_cost_trends"]
    return t.groupBy("corridor").agg(fmt_count(F.sum("num_observations")).alias("observations_text"))


@register("kpis", O.with_ctes("""
SELECT 'corridors_tracked' AS kpi, CAST(count(DISTINCT corridor) AS DOUBLE) AS value FROM trends
UNION ALL SELECT 'provider_observations', CAST(count(*) AS DOUBLE) FROM providers
UNION ALL SELECT 'firms_scored', CAST(count(*) AS DOUBLE) FROM scorecard
UNION ALL SELECT 'spotlight_observations', CAST(count(*) AS DOUBLE) FROM spot
UNION ALL SELECT 'focus_observations', CAST(count(*) AS DOUBLE) FROM spot
UNION ALL SELECT 'focus_corridors', CAST(count(DISTINCT corridor) AS DOUBLE) FROM spot
UNION ALL SELECT 'focus_firms', CAST(count(DISTINCT firm) AS DOUBLE) FROM spot
UNION ALL SELECT 'focus_avg_total_cost_pct', round(avg(total_cost_pct), 6) FROM spot"""))
def q_kpis(spark, d):
    m = marts(spark, d)
    k = S.kpis(m["corridor_cost_trends"], m["provider_comparison"], m["transparency_scorecard"],
               m["spotlight"], "both")
    return k.withColumn("value", F.round("value", 6))


# ---- declarative checks ------------------------------------------------------------

from lanecost.operators import checks as K  # noqa: E402

NOT_NULL_COLUMNS = ("is_disclosed_transparent", "fee_cost_pct", "fx_margin_pct",
                    "decomposed_cost_pct", "cost_mismatch_flag", "source_region",
                    "sending_currency_name")


@register("check_not_null", O.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS failures FROM flagged" for c in NOT_NULL_COLUMNS)))
def q_check_not_null(spark, d):
    return K.check_not_null(flagged(spark, d), NOT_NULL_COLUMNS)


@register("check_unique_combination", O.with_ctes(
    "SELECT raw_id, cc_number, count(*) AS n FROM staged GROUP BY raw_id, cc_number "
    "HAVING count(*) > 1"))
def q_check_unique_combination(spark, d):
    return K.check_unique_combination(staged(spark, d), ["raw_id", "cc_number"])


@register("check_relationships", O.with_ctes(
    "SELECT lcu_code_resolved AS value, count(*) AS failures FROM enriched "
    "WHERE lcu_code_resolved IS NOT NULL AND lcu_code_resolved NOT IN "
    "(SELECT currency_code FROM currency WHERE currency_code IS NOT NULL) GROUP BY 1"))
def q_check_relationships(spark, d):
    return K.check_relationships(enriched(spark, d), "lcu_code_resolved",
                                 FX.currency_dim(spark, d), "currency_code")


@register("check_relationships_country", O.with_ctes(
    "SELECT receiving_country_code AS value, count(*) AS failures FROM enriched "
    "WHERE receiving_country_code IS NOT NULL AND receiving_country_code NOT IN "
    "(SELECT country_iso3 FROM country WHERE country_iso3 IS NOT NULL) GROUP BY 1"))
def q_check_relationships_country(spark, d):
    return K.check_relationships(enriched(spark, d), "receiving_country_code",
                                 FX.country_dim(spark, d), "country_iso3")


@register("check_accepted_values", O.with_ctes(
    "SELECT transparency_flag_count AS value, count(*) AS failures FROM flagged "
    "WHERE transparency_flag_count IS NOT NULL AND transparency_flag_count NOT IN (0) "
    "GROUP BY 1"))
def q_check_accepted_values(spark, d):
    return K.check_accepted_values(flagged(spark, d), "transparency_flag_count", [0])


@register("check_expression", O.with_ctes(
    "SELECT firm, firm_type FROM scorecard WHERE NOT (pct_disclosed_transparent >= 75)"))
def q_check_expression(spark, d):
    sc = marts(spark, d)["transparency_scorecard"]
    return K.check_expression(sc, "pct_disclosed_transparent >= 75").select("firm", "firm_type")


MODEL_CTE = {"landing": "landing", "staged": "staged", "enriched": "enriched",
             "decomposed": "decomposed", "flagged": "flagged",
             "corridor_cost_trends": "trends", "provider_comparison": "providers",
             "transparency_scorecard": "scorecard", "spotlight": "spot",
             "country": "country", "currency": "currency"}


def _check_sql(c: K.Check) -> str:
    src = MODEL_CTE[c.model]
    head = f"SELECT {O.lit(c.name)} AS \"check\", {O.lit(c.model)} AS model, {O.lit(c.severity)} AS severity, "
    if c.kind == "not_null":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {src} WHERE {O.q(c.columns[0])} IS NULL"
    if c.kind == "unique":
        cols = O.qs(c.columns)
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {cols} FROM {src} "
                       f"GROUP BY {cols} HAVING count(*) > 1)")
    if c.kind == "relationships":
        k, pk = O.q(c.columns[0]), O.q(c.parent_column)
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {src} WHERE {k} IS NOT NULL AND "
                       f"{k} NOT IN (SELECT {pk} FROM {MODEL_CTE[c.parent]} WHERE {pk} IS NOT NULL)")
    if c.kind == "accepted_values":
        k = O.q(c.columns[0])
        vals = ", ".join(O.lit(v) if isinstance(v, str) else str(v) for v in c.values)
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {src} WHERE {k} IS NOT NULL AND {k} NOT IN ({vals})"
    if c.kind == "expression":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {src} WHERE NOT ({c.expression})"
    raise ValueError(c.kind)


def models(spark, d, materialize: bool = False) -> dict[str, DataFrame]:
    """Every model of the chain; with ``materialize`` the flagged rows and the aggregated marts
    are written once (to the shared scratch folder) and the rest derive from them and from the
    curated rows, which are read from files, as models are materialized before they are tested."""
    clean, _ = curated(spark, d)
    landing = Mo.conform_landing(clean)
    stg = Mo.stage_typed(landing)
    enr = Mo.enrich_corridor(stg, FX.country_dim(spark, d), FX.currency_dim(spark, d),
                             FX.CODE_REMAP, FX.CFA_ZONES)
    dec = Mo.cost_decompose(enr)
    fl = Mo.flag_transparency(dec)
    if materialize:
        fl = materialized(fl, "flagged")
    m = dict(flows.build_marts(fl, MODEL_CFG, stored=materialize))
    if materialize:
        m |= {n: materialized(m[n], n) for n in ("corridor_cost_trends", "transparency_scorecard")}
    return {"landing": landing, "staged": stg, "enriched": enr, "decomposed": dec, "flagged": fl,
            **m, "country": FX.country_dim(spark, d), "currency": FX.currency_dim(spark, d)}


@register("check_suite", O.with_ctes("\nUNION ALL\n".join(_check_sql(c) for c in K.declared_checks())))
def q_check_suite(spark, d):
    return K.check_suite(K.declared_checks(), models(spark, d, materialize=True), K.SAME_ROWS)


# ---- profile --------------------------------------------------------------------

NUMERIC_WIDE = {"id", "inter lcu bank fx"} | {p + f for p in C.TIER_PREFIXES for f in (
    "denomination amount", "lcu amount", "lcu fee", "lcu fx rate", "fx margin", "total cost %")}
TEXT_WIDE = [c for c in O.WIDE_COLUMNS if c not in NUMERIC_WIDE]


def _values(section: str, items) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {O.lit(i)} AS item, "
                              f"CAST({v} AS BIGINT) AS value" for i, v in items)


_PROFILE_SQL = " UNION ALL ".join([
    "SELECT 'shape' AS section, 'rows' AS item, CAST(count(*) AS BIGINT) AS value FROM wide",
    _values("shape", [("columns", len(O.WIDE_COLUMNS))]),
    _values("columns", [(c, i + 1) for i, c in enumerate(O.WIDE_COLUMNS)]),
    _values("tier_columns", [(c, i + 1) for i, c in enumerate(
        [c for c in O.WIDE_COLUMNS if c.startswith(C.TIER_PREFIXES)])]),
    *[f"SELECT 'marker_count', {O.lit(c)}, CAST(count(*) AS BIGINT) FROM wide WHERE {O.q(c)} = '..' "
      f"HAVING count(*) > 0" for c in TEXT_WIDE],
    "SELECT 'periods', period, CAST(row_number() OVER (ORDER BY period) AS BIGINT) FROM "
    "(SELECT DISTINCT period FROM wide WHERE period IS NOT NULL ORDER BY period LIMIT 10)",
    "SELECT 'value_counts', transparent, CAST(count(*) AS BIGINT) FROM wide GROUP BY transparent",
    _values("dtypes", [(f"{c} {'bigint' if c == 'id' else 'double' if c in NUMERIC_WIDE else 'string'}", i + 1)
                       for i, c in enumerate(O.WIDE_COLUMNS)]),
])


@register("profile_table", O.with_ctes(_PROFILE_SQL))
def q_profile_table(spark, d):
    from lanecost.operators.profile import profile_table
    return profile_table(wide(spark, d))


# ---- sources, sinks and composed flows (write to a fresh scratch folder) -------------

from lanecost.session import scratch_path  # noqa: E402
from lanecost.sinks import writers as Wr  # noqa: E402
from lanecost.sources import scan as Sc  # noqa: E402

_MAXP = "(SELECT max(period) FROM wide)"
_TOP2 = "(SELECT period FROM (SELECT DISTINCT period FROM clean) ORDER BY period DESC LIMIT 2)"


def staged_drop(spark, d) -> tuple[str, DataFrame]:
    """Write the wide quotes partitioned by period (a cumulative drop)."""
    by_period = FX.wide_quotes(spark, d, lambda rows: rows.hint("rebalance", col("period")))
    path = Wr.write_by_period(by_period, scratch_path(spark, "drop"), name="raw", grouped=True)
    return path, wide(spark, d)


@register("scan_period_slice", O.with_ctes(f"SELECT * FROM wide WHERE period = {_MAXP}"))
def q_scan_period_slice(spark, d):
    path, w = staged_drop(spark, d)
    latest = w.agg(F.max("period")).first()[0]
    return Sc.scan_period_slice(spark, path, latest)


@register("list_loaded_periods", O.with_ctes("SELECT DISTINCT period FROM wide"))
def q_list_loaded_periods(spark, d):
    path, _ = staged_drop(spark, d)
    return Sc.list_loaded_periods(spark, path)


@register("ingest_latest_period", O.with_ctes(f"SELECT * FROM wide WHERE period = {_MAXP}"))
def q_ingest_latest_period(spark, d):
    w = wide(spark, d)
    periods = w.select("period").distinct()
    newest_two = periods.orderBy(F.col("period").desc()).limit(2)
    loaded = periods.join(newest_two, "period", "left_anti")
    _, sliced = Sc.ingest_latest_period(w, loaded)
    return sliced


@register("scan_reference_csv", O.with_ctes("SELECT * FROM country"))
def q_scan_reference_csv(spark, d):
    from pyspark.sql import types as T
    path = scratch_path(spark, "seed-country")
    FX.country_dim(spark, d).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("country_iso3", "country_name", "region", "income_group")])
    return Sc.scan_reference_csv(spark, path, schema, key="country_iso3")


@register("write_by_period", O.with_ctes("SELECT * FROM clean"))
def q_write_by_period(spark, d):
    clean, _ = curated(spark, d)
    path = Wr.write_by_period(clean, scratch_path(spark, "curated"))
    return spark.read.schema(clean.schema).parquet(path)


@register("write_reports", O.with_ctes(_REPORTS_SQL.format(c="report", g=O.qs(O.GRAIN_COLUMNS))))
def q_write_reports(spark, d):
    _, reports = curated(spark, d)
    paths = Wr.write_reports(reports, scratch_path(spark, "reports"))
    from lanecost.operators.util import union_all
    # an empty report writes no data files, so read back with the report's schema
    return union_all([spark.read.schema(reports[n].schema).parquet(p)
                        .agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.lit(n).alias("report"), "rows") for n, p in paths.items()])


def _load_scenario(spark, d):
    """Load the newest two periods, reload the newest (no change), then try an
    absent period (fails, audited)."""
    clean, _ = curated(spark, d)
    base = scratch_path(spark, "load")
    src = Wr.write_by_period(clean, base)
    top = [r[0] for r in spark.read.parquet(src).select("period").distinct()
           .orderBy(F.col("period").desc()).limit(2).collect()]
    landing, audit = f"{base}/landing", f"{base}/audit"
    Wr.replace_partition_load(spark, src, landing, top[0], audit)
    Wr.replace_partition_load(spark, src, landing, top[1], audit)
    Wr.replace_partition_load(spark, src, landing, top[0], audit)
    try:
        Wr.replace_partition_load(spark, src, landing, "2099_1Q", audit)
    except ValueError:
        pass
    return landing, audit


@register("replace_partition_load", O.with_ctes(f"SELECT * FROM landing WHERE period IN {_TOP2}"))
def q_replace_partition_load(spark, d):
    landing, _ = _load_scenario(spark, d)
    return Wr.read_landing(spark, landing)


@register("versioned_publish", O.with_ctes(
    f"SELECT 'now' AS seen, * FROM landing WHERE period IN {_TOP2}\n"
    f"UNION ALL SELECT 'before', * FROM landing WHERE period = {_MAXP}"))
def q_versioned_publish(spark, d):
    """What readers see after a load of two periods that died half-way was made again, and
    what those of the record before still see."""
    from lanecost.sinks.versioned import VersionedTable
    clean, _ = curated(spark, d)
    base = scratch_path(spark, "publish")
    src = spark.read.parquet(Wr.write_by_period(clean, base))
    top = [r[0] for r in src.select("period").distinct().orderBy(F.col("period").desc()).limit(2).collect()]
    landing, audit = f"{base}/landing", f"{base}/audit"
    Wr.replace_partition_load(spark, src, landing, top[0], audit)
    table = VersionedTable(spark, landing)
    table.write_version(Mo.conform_landing(src.filter(F.col("period").isin(top)).limit(10)))   # dies before its switch
    first = max(r["id"] for r in table.log.records())
    Wr.replace_partition_load(spark, src, landing, top, audit)
    return (table.read(Mo.LANDING_SCHEMA).select(F.lit("now").alias("seen"), "*")
            .unionByName(table.read(Mo.LANDING_SCHEMA, upto=first).select(F.lit("before").alias("seen"), "*")))


_AUDIT_CTES = ("tops AS (SELECT period, row_number() OVER (ORDER BY period DESC) AS r FROM "
               "(SELECT DISTINCT period FROM clean) ORDER BY period DESC LIMIT 2), "
               "n AS (SELECT t.r, count(*) AS c FROM clean JOIN tops t USING (period) GROUP BY t.r)")
_AUDIT_SQL = """
SELECT CAST(1 AS BIGINT) AS load_id, (SELECT period FROM tops WHERE r = 1) AS quarter_label,
       CAST((SELECT c FROM n WHERE r = 1) AS BIGINT) AS row_count, 'SUCCESS' AS status,
       CAST(NULL AS VARCHAR) AS error_message
UNION ALL SELECT 2, (SELECT period FROM tops WHERE r = 2), CAST((SELECT sum(c) FROM n) AS BIGINT), 'SUCCESS', NULL
UNION ALL SELECT 3, (SELECT period FROM tops WHERE r = 1), CAST((SELECT sum(c) FROM n) AS BIGINT), 'SUCCESS', NULL
UNION ALL SELECT 4, '2099_1Q', 0, 'FAILED', 'no source rows for period 2099_1Q'"""


@register("load_audit", O.with_ctes(_AUDIT_CTES, _AUDIT_SQL))
def q_load_audit(spark, d):
    _, audit = _load_scenario(spark, d)
    return Wr.read_audit(spark, audit).drop("loaded_at")


@register("rename_lower", O.with_ctes(
    "SELECT " + ", ".join(f"{O.q(c)} AS {O.q(c.lower())}" for c in O.WIDE_COLUMNS) + " FROM wide"))
def q_rename_lower(spark, d):
    return Wr.rename_lower(wide(spark, d))


_MART_COUNTS = """
SELECT 'corridor_cost_trends' AS mart, CAST(count(*) AS BIGINT) AS rows FROM trends
UNION ALL SELECT 'provider_comparison', CAST(count(*) AS BIGINT) FROM providers
UNION ALL SELECT 'transparency_scorecard', CAST(count(*) AS BIGINT) FROM scorecard
UNION ALL SELECT 'spotlight', CAST(count(*) AS BIGINT) FROM spot"""


@register("build_marts", O.with_ctes(_MART_COUNTS))
def q_build_marts(spark, d):
    from lanecost.operators.util import union_all
    m = flows.build_marts(flagged(spark, d), MODEL_CFG, reuse=True)
    return union_all([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("mart"), "rows")
                      for n, df in m.items()])


_NEWEST = ("newest AS (SELECT DISTINCT period_year, period_quarter FROM flagged WHERE period_year IS NOT NULL "
           "AND period_quarter IS NOT NULL ORDER BY period_year DESC, period_quarter DESC LIMIT 3)")
_IN_NEWEST = "(period_year, period_quarter) IN (SELECT (period_year, period_quarter) FROM newest)"


def _loaded_by_period(spark, d):
    """The three newest quarters loaded one after another, the first of them once with half
    of its rows and then again."""
    from lanecost.plans.period_marts import PeriodMarts
    rows = flagged(spark, d)
    quarters = [tuple(r) for r in rows.select("period_year", "period_quarter").dropna().distinct()
                .orderBy(F.desc("period_year"), F.desc("period_quarter")).limit(3).collect()]
    # the rows to load are written, laid out by quarter, so a load reads its own files alone
    rows = rows.filter(reduce(or_, [(col("period_year") == y) & (col("period_quarter") == q) for y, q in quarters], F.lit(False)))
    path = scratch_path(spark, "flagged")
    with small_methods(spark), open_files(spark):
        rows.write.options(**COMPACT).partitionBy("period_year", "period_quarter").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    kept = PeriodMarts(spark, scratch_path(spark, "period-marts"), MODEL_CFG, buckets=4)

    def of(year, quarter):
        return rows.filter((col("period_year") == year) & (col("period_quarter") == quarter))

    kept.load(of(*quarters[0]).filter(F.pmod(F.xxhash64("raw_id"), F.lit(2)) == 0), "%d_%dQ" % quarters[0])
    for q in reversed(quarters):
        kept.load(of(*q), "%d_%dQ" % q)
    return kept.marts()


@register("scorecard_by_period", O.with_ctes(
    f"{_NEWEST}, part AS (SELECT * FROM flagged WHERE {_IN_NEWEST}), "
    f"part_score AS ({O.SCORECARD_SQL.replace('FROM flagged', 'FROM part')})",
    _round_sql("part_score", SCORE_DOUBLES)))
def q_scorecard_by_period(spark, d):
    return r6(_loaded_by_period(spark, d)["transparency_scorecard"], *SCORE_DOUBLES)


@register("trends_by_period", O.with_ctes(_NEWEST, _round_sql("trends", TREND_DOUBLES) + f" WHERE {_IN_NEWEST}"))
def q_trends_by_period(spark, d):
    return r6(_loaded_by_period(spark, d)["corridor_cost_trends"], *TREND_DOUBLES)


@register("spotlight_clustered", O.with_ctes("SELECT * FROM spot"))
def q_spotlight_clustered(spark, d):
    """From flagged rows laid out by both ends of the corridor inside each period."""
    rows = materialized(flagged(spark, d), "flagged")
    path = Wr.write_by_period(rows, scratch_path(spark, "laid"), "period_label",
                              cluster_by=["sending_country_code", "receiving_country_code"])
    return M.spotlight(spark.read.schema(rows.schema).parquet(path), FX.SPOTLIGHT_COUNTRY)


@register("model_graph", O.with_ctes(_round_sql("scorecard", SCORE_DOUBLES)))
def q_model_graph(spark, d):
    from lanecost.plans.model_graph import corridor_models
    graph = corridor_models({"clean": lambda: curated(spark, d)[0], "country": lambda: FX.country_dim(spark, d),
                             "currency": lambda: FX.currency_dim(spark, d)}, MODEL_CFG)
    built = graph.build(scratch_path(spark, "graph"), ["transparency_scorecard", "provider_comparison"])
    return r6(built["transparency_scorecard"], *SCORE_DOUBLES)


# whole rows of what the composed flows leave behind, beside their counts

@register("write_reports_margin", O.with_ctes('SELECT * FROM clean WHERE "fx margin" < 0'))
def q_write_reports_margin(spark, d):
    _, reports = curated(spark, d)
    report = reports["fx_margin"]
    paths = Wr.write_reports({"fx_margin": report}, scratch_path(spark, "reports"))
    return spark.read.schema(report.schema).parquet(paths["fx_margin"])


@register("export_marts_trends", O.with_ctes(_round_sql("trends", TREND_DOUBLES)))
def q_export_marts_trends(spark, d):
    base = scratch_path(spark, "export")
    Wr.export_marts({"corridor_cost_trends": marts(spark, d)["corridor_cost_trends"]}, base)
    return r6(Sc.read_mart(spark, base, "corridor_cost_trends"), *TREND_DOUBLES)


@register("run_pipeline_clean", O.with_ctes("SELECT * FROM clean"))
def q_run_pipeline_clean(spark, d):
    path, w = staged_drop(spark, d)
    base = scratch_path(spark, "pipeline")
    flows.run_pipeline(spark, path, base, expected_columns=len(w.columns))
    # the columns are those of the long rows; curating all rows again would tell no more
    return spark.read.schema(flows.curate_long(w).schema).parquet(f"{base}/clean")


@register("export_marts", O.with_ctes(_MART_COUNTS))
def q_export_marts(spark, d):
    m = flows.build_marts(flagged(spark, d), MODEL_CFG, reuse=True)
    base = scratch_path(spark, "export")
    counts = Wr.export_marts(m, base)
    from lanecost.operators.util import union_all
    back = {n: Sc.read_mart(spark, base, n) for n in counts}
    for n, df in back.items():
        if df.columns != [c.lower() for c in m[n].columns]:
            raise AssertionError(f"snapshot {n} has other columns than its mart")
    # the snapshots read back; a row appears only where the observed count agrees
    return union_all([df.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") == counts[n])
                        .select(F.lit(n).alias("mart"), "rows") for n, df in back.items()])


@register("materialize", O.with_ctes(_round_sql("trends", TREND_DOUBLES)))
def q_materialize(spark, d):
    t = Wr.materialize(marts(spark, d)["corridor_cost_trends"], "corridor_cost_trends",
                       scratch_path(spark, "marts"))
    return r6(t, *TREND_DOUBLES)


@register("mart_read", O.with_ctes("SELECT * FROM providers"))
def q_mart_read(spark, d):
    base = scratch_path(spark, "marts")
    Wr.materialize(marts(spark, d)["provider_comparison"], "provider_comparison", base)
    return Sc.read_mart(spark, base, "provider_comparison")


@register("incremental_period_run", O.with_ctes(f"SELECT * FROM landing WHERE period = {_MAXP}"))
def q_incremental_period_run(spark, d):
    from lanecost.plans.incremental import incremental_period_run, paths
    w = wide(spark, d)
    base = scratch_path(spark, "incremental")
    # the store already holds every period but the newest two
    periods = w.select("period").distinct()
    newest_two = periods.orderBy(F.col("period").desc()).limit(2)
    older = w.join(newest_two, "period", "left_anti")
    # the audit log is what says so: one SUCCESS for each older period
    labels = sorted(r[0] for r in older.select("period").distinct().collect())
    Wr.append_audit(spark, paths(base)["audit"], labels, 0, "SUCCESS")
    incremental_period_run(spark, w, base)
    return Wr.read_landing(spark, paths(base)["landing"])


_SERVE_SQL = f"""
SELECT 'weighted_trend' AS view, CAST(count(*) AS BIGINT) AS rows FROM wt
UNION ALL SELECT 'top_corridors', CAST(count(*) AS BIGINT) FROM ({_TOPK_SQL})
UNION ALL SELECT 'top_corridor_trend', CAST(count(*) AS BIGINT) FROM wt
  WHERE corridor_label IN (SELECT corridor_label FROM ({_TOPK_SQL}))
UNION ALL SELECT 'corridor_options', CAST(count(DISTINCT corridor_label) AS BIGINT) FROM wt
UNION ALL SELECT 'scorecard', CAST(count(*) AS BIGINT) FROM scorecard WHERE has_sufficient_sample
UNION ALL SELECT 'kpis', CAST(8 AS BIGINT)
UNION ALL SELECT 'spotlight_trend', CAST(count(*) AS BIGINT) FROM (
  SELECT DISTINCT corridor_label, period_label, period_sort_key FROM spot_lab
  WHERE corridor_label IS NOT NULL AND period_label IS NOT NULL AND period_sort_key IS NOT NULL)
UNION ALL SELECT 'spotlight_top', CAST(least(5, count(DISTINCT corridor_label)) AS BIGINT) FROM spot_lab
UNION ALL SELECT 'firm_comparison', CAST(count(*) AS BIGINT) FROM firms
  WHERE num_observations >= {FIXTURE_MIN_OBS}
UNION ALL SELECT 'high_cost_firms', CAST(count(*) AS BIGINT) FROM firms
  WHERE num_observations >= {FIXTURE_MIN_OBS} AND round(avg_total_cost_pct, 6) >= {FIXTURE_AT_LEAST}
UNION ALL SELECT 'top_cost_listing', CAST(1 AS BIGINT)"""


@register("serve_views", O.with_ctes(_SERVE_SQL))
def q_serve_views(spark, d):
    from lanecost.operators.util import union_all
    views = flows.serve_views(marts(spark, d), names(spark, d), min_obs=FIXTURE_MIN_OBS,
                              at_least=FIXTURE_AT_LEAST)
    return union_all([v.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("view"), "rows")
                      for n, v in views.items()])


@register("stream_period_load", O.with_ctes("SELECT * FROM landing"))
def q_stream_period_load(spark, d):
    from lanecost.streaming.drop_watch import stream_period_loads
    path, w = staged_drop(spark, d)
    base = scratch_path(spark, "stream")
    stream_period_loads(spark, path, spark.read.parquet(path).schema, base)
    return Wr.read_landing(spark, f"{base}/landing")


@register("incremental_recovery", O.with_ctes(f"SELECT * FROM landing WHERE period = {_MAXP}"))
def q_incremental_recovery(spark, d):
    """The load step of the first run fails after everything else was written; the
    rerun takes the same period again and lands it."""
    from lanecost.plans.incremental import incremental_period_run, paths
    from lanecost.plans.ledger import Ledger
    w = wide(spark, d)
    base = scratch_path(spark, "recovery")

    def broken(*args, **kwargs):
        raise OSError("injected")
    try:
        incremental_period_run(spark, w, base, load=broken)
        raise AssertionError("the injected failure was swallowed")
    except OSError:
        pass
    # the rerun must go on with the load: the ledger passes over all that was done
    done = len(Ledger(spark, paths(base)["ledger"]).log.records())
    incremental_period_run(spark, w, base)
    if len(Ledger(spark, paths(base)["ledger"]).log.records()) != done:
        raise AssertionError("a finished step was run again")
    return Wr.read_landing(spark, paths(base)["landing"])


def _streamed(spark, d, files=1, max_files=None, calls=1, changed=lambda w: w):
    """Land the wide quotes, ``changed``, through the stream: rows are dealt to ``files`` files of
    every period, or to more where the stream takes all files at once, and arrive in ``calls``
    drops, each followed by a run of the stream on the same base. Rows are dealt before they are
    made wide, so a shuffle moves few columns."""
    from lanecost.streaming.drop_watch import stream_period_loads
    drop, base = scratch_path(spark, "drop"), scratch_path(spark, "stream")
    for i in range(calls):
        def share(rows):
            part = rows.filter(F.pmod(F.xxhash64("id"), F.lit(calls)) == i)  # noqa: B023
            return part.repartition(files, "id") if max_files else part.repartition("id")
        w = changed(FX.wide_quotes(spark, d, share))
        with small_methods(spark):
            w.write.mode("append").parquet(drop)
        stream_period_loads(spark, drop, w.schema, base, max_files_per_trigger=max_files)
    return Wr.read_landing(spark, f"{base}/landing")


@register("stream_two_files_one_period", O.with_ctes("SELECT * FROM landing"))
def q_stream_two_files_one_period(spark, d):
    return _streamed(spark, d, files=4, max_files=2)


@register("stream_two_calls", O.with_ctes("SELECT * FROM landing"))
def q_stream_two_calls(spark, d):
    """Two runs on one base, each with a share of every period's rows."""
    return _streamed(spark, d, files=4, calls=2)


_NULLED = ", ".join(f"CASE WHEN period = {_MAXP} THEN NULL ELSE {c} END AS {c}"
                    for c in ("period", "period_year", "period_quarter"))


@register("stream_null_period", O.with_ctes(f"SELECT * REPLACE ({_NULLED}) FROM landing"))
def q_stream_null_period(spark, d):
    newest = wide(spark, d).agg(F.max("period")).first()[0]
    return _streamed(spark, d, files=4, changed=lambda w: w.withColumn("period", F.nullif("period", F.lit(newest))))


@register("run_pipeline", O.with_ctes(
    _REPORTS_SQL.format(c="dataset", g=O.qs(O.GRAIN_COLUMNS))
    + "\nUNION ALL SELECT 'clean', CAST(count(*) AS BIGINT) FROM clean"))
def q_run_pipeline(spark, d):
    from lanecost.operators.util import union_all
    path, w = staged_drop(spark, d)
    base = scratch_path(spark, "pipeline")
    flows.run_pipeline(spark, path, base, expected_columns=len(w.columns))
    places = {n: f"{base}/quality_reports/{n}" for n in flows.REPORT_NAMES} | {"clean": f"{base}/clean"}
    return union_all([spark.read.schema("id long").parquet(p).agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(n).alias("dataset"), "rows") for n, p in places.items()])


@register("convert_full_history", O.with_ctes("SELECT * FROM wide"))
def q_convert_full_history(spark, d):
    path, w = staged_drop(spark, d)
    drop = spark.read.parquet(path)
    return Sc.convert_full_history(spark, drop, scratch_path(spark, "history"), drop.count(), len(w.columns))


@register("dedup_grain_split", O.with_ctes("SELECT * FROM clean"))
def q_dedup_grain_split(spark, d):
    from lanecost.operators.dedup import dedup_first
    return dedup_first(long(spark, d), strategy="split")


@register("dedup_grain_filter", O.with_ctes("SELECT * FROM clean"))
def q_dedup_grain_filter(spark, d):
    from lanecost.operators.dedup import dedup_first
    return dedup_first(long(spark, d), strategy="filter")


@register("profile_sample", O.with_ctes(
    "SELECT * FROM wide ORDER BY id NULLS FIRST, "
    + ", ".join(f"{O.q(c)} NULLS FIRST" for c in O.WIDE_COLUMNS if c != "id") + " LIMIT 5"))
def q_profile_sample(spark, d):
    from lanecost.operators.profile import sample_rows
    return sample_rows(wide(spark, d), ["id"])


@register("source_decl", O.with_ctes("SELECT * FROM landing"))
def q_source_decl(spark, d):
    # a named source other models refer to: the landing rows registered as a view
    Wr.materialize(Mo.conform_landing(curated(spark, d)[0]), "lanecost_landing", kind="view")
    return spark.table("lanecost_landing")
