"""Composed flows: curate the raw drop, model it, build the marts, serve them.

Each flow only adds plan nodes; nothing is collected. Where one result feeds
several consumers the caller decides whether to ``persist``/``checkpoint``
(``build_marts(..., reuse=True)`` writes the flagged rows once as Parquet so the four
marts do not each re-run the chain).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.operators import clean as C
from lanecost.operators import marts as M
from lanecost.operators import model as Mo
from lanecost.operators import serve as S
from lanecost.operators.dedup import GRAIN_COLUMNS, dedup_marked, flag_duplicates
from lanecost.operators.splits import split_negative, split_nontransparent
from lanecost.operators.util import union_all
from lanecost.session import materialized
from lanecost.sinks.writers import write_by_period, write_reports
from lanecost.sources.scan import EXPECTED_COLUMNS, list_partitions, scan_guarded

log = logging.getLogger(__name__)

REPORT_NAMES = ("grain_duplicates", "fx_margin", "transparency", "duplicate_check")
# Those that come by period where the clean rows are read from files by period.
GROUPED_REPORTS = ("fx_margin", "transparency")


@dataclass(frozen=True)
class CurateConfig:
    geography_columns: Sequence[str] = C.GEOGRAPHY_COLUMNS
    marker: str = C.NULL_MARKER
    date_formats: Sequence[str] = C.DATE_FORMATS
    prefixes: Sequence[str] = C.TIER_PREFIXES
    driving: str = C.DRIVING_FIELD
    grain: Sequence[str] = GRAIN_COLUMNS
    order_by: Sequence[str] = ("id",)
    margin_column: str = "fx margin"
    transparent_column: str = "transparent"


@dataclass(frozen=True)
class ModelConfig:
    remap: Mapping[str, str] | None = None
    zones: Mapping[str, Sequence[str]] | None = None
    tolerance: float = Mo.MISMATCH_TOLERANCE
    spotlight_country: str = "KEN"
    min_sample: int = M.MIN_SAMPLE
    approx_median: bool = False   # bounded-memory sketch instead of the exact median
    ranged_median: bool | None = None   # exact median: measured choice, by ranges (True), by maps (False)


def curate_long(raw: DataFrame, cfg: CurateConfig = CurateConfig()) -> DataFrame:
    """Sentinels -> dates -> periods -> unpivot (all narrow)."""
    df = C.null_sentinel(raw, cfg.geography_columns, cfg.marker)
    df = C.parse_mixed_date(df, formats=cfg.date_formats)
    df = C.parse_period(df)
    return C.unpivot_sides(df, cfg.prefixes, cfg.driving)


class LazyFrames(Mapping):
    """Name -> DataFrame, each built on first access (building some reports and
    marts runs a sizing job, so unused ones cost nothing)."""

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def curate(raw: DataFrame, cfg: CurateConfig = CurateConfig()) -> tuple[DataFrame, Mapping[str, DataFrame]]:
    """Clean, reshape and de-duplicate the wide quotes; return the clean rows and
    four quality reports. Dedup is the only hard filter; the other checks only
    report, each on the de-duplicated rows."""
    long = curate_long(raw, cfg)
    clean, removed = dedup_marked(long, cfg.grain, cfg.order_by)
    return clean, quality_reports(removed, clean, cfg)


def quality_reports(removed: Callable[[], DataFrame], clean: DataFrame,
                    cfg: CurateConfig = CurateConfig()) -> Mapping[str, DataFrame]:
    """The four reports, from the report of the de-duplication and the clean rows, both read
    from files."""
    return LazyFrames({
        "grain_duplicates": removed,
        "fx_margin": lambda: split_negative(clean, cfg.margin_column)[1],
        "transparency": lambda: split_nontransparent(clean, cfg.transparent_column)[1],
        "duplicate_check": lambda: flag_duplicates(clean, cfg.grain, stored=True)[1],
    })


def run_pipeline(spark: SparkSession, drop: str, base: str, expected_columns: int | None = EXPECTED_COLUMNS,
                 expected_rows: int | None = None, strict_rows: bool = False, cfg: CurateConfig = CurateConfig(),
                 period_col: str = "period") -> dict[str, int]:
    """The whole curation as one flow: guarded scan of ``drop``, curated rows and four
    reports written under ``base``, one warning for each report with rows. Returns the
    row count of each report. Rows of a drop that is laid out by period are not shuffled by it."""
    raw = scan_guarded(spark, drop, expected_columns, expected_rows, strict_rows)
    long = curate_long(raw, cfg)
    clean, removed = dedup_marked(long, cfg.grain, cfg.order_by)
    path = write_by_period(clean, base, period_col, grouped=bool(list_partitions(spark, drop, period_col)))
    written = spark.read.schema(clean.schema).parquet(path)
    reports = quality_reports(removed, written, cfg)
    paths = write_reports(reports, base, period_col, grouped=GROUPED_REPORTS)
    return warn_on_reports({n: spark.read.schema(reports[n].schema).parquet(p) for n, p in paths.items()})


def report_counts(reports: Mapping[str, DataFrame]) -> DataFrame:
    """``(check, rows)`` per report, one small global count each (empty -> 0)."""
    return union_all([df.agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.lit(name).alias("check"), "rows")
                      for name, df in reports.items()])


def warn_on_reports(reports: Mapping[str, DataFrame]) -> dict[str, int]:
    """Collect the (tiny) per-report counts and log a warning for non-empty ones."""
    counts = {r["check"]: r["rows"] for r in report_counts(reports).collect()}
    for name, n in counts.items():
        if n:
            log.warning("quality report %s is not empty: %d rows", name, n)
    return counts


def build_flagged(clean: DataFrame, country_dim: DataFrame, currency_dim: DataFrame,
                  cfg: ModelConfig = ModelConfig()) -> DataFrame:
    """Landing conform -> staging -> enrichment -> decomposition -> flags."""
    staged = Mo.stage_typed(Mo.conform_landing(clean))
    enriched = Mo.enrich_corridor(staged, country_dim, currency_dim, cfg.remap, cfg.zones)
    return Mo.flag_transparency(Mo.cost_decompose(enriched), cfg.tolerance)


def build_marts(flagged: DataFrame, cfg: ModelConfig = ModelConfig(),
                reuse: bool = False, stored: bool = False) -> Mapping[str, DataFrame]:
    """The four marts, each built when it is asked for. With ``reuse`` the flagged rows
    are written once to the shared scratch folder (lineage cut, survives executor loss);
    ``stored`` says that they are read from files already."""
    if reuse:
        flagged = materialized(flagged, "flagged")
    return LazyFrames({
        "corridor_cost_trends": lambda: M.corridor_cost_trends(
            flagged, cfg.approx_median, cfg.ranged_median, reuse or stored),
        "provider_comparison": lambda: M.provider_comparison(flagged),
        "transparency_scorecard": lambda: M.transparency_scorecard(flagged, cfg.min_sample),
        "spotlight": lambda: M.spotlight(flagged, cfg.spotlight_country),
    })


def serve_views(marts: Mapping[str, DataFrame], names: DataFrame, role: str = "both",
                k: int = S.TOP_K, min_obs: int = S.MIN_FIRM_OBSERVATIONS,
                at_least: float = S.HIGH_COST_AT_LEAST) -> dict[str, DataFrame]:
    """Everything the two overview pages show, as DataFrames."""
    trend = S.weighted_trend(marts["corridor_cost_trends"], names)
    top = S.topk(trend, "corridor_label", "num_observations", k)
    spot = S.role_filter(marts["spotlight"], role)
    spot_labelled = S.corridor_label(spot, names)
    firms = S.firm_comparison(spot, min_obs)
    return {
        "weighted_trend": trend,
        "top_corridors": top,
        "top_corridor_trend": S.members_of(trend, top),
        "corridor_options": S.options(trend),
        "scorecard": S.scorecard_view(marts["transparency_scorecard"]),
        "kpis": S.kpis(marts["corridor_cost_trends"], marts["provider_comparison"],
                       marts["transparency_scorecard"], marts["spotlight"], role),
        "spotlight_trend": S.spotlight_trend(spot, names),
        "spotlight_top": S.topk(spot_labelled, "corridor_label", None, k),
        "firm_comparison": firms,
        "high_cost_firms": S.high_cost_firms(firms, at_least),
        "top_cost_listing": S.top_cost_listing(firms, at_least),
    }
