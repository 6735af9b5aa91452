"""Incremental period run: take the newest unseen period from a cumulative drop,
curate it, write it by period, and load it idempotently with an audit row.

Layout under ``base``: ``raw/period=<p>`` (ingested slices), ``curated/clean``
and ``curated/quality_reports/<name>`` (partitioned by period), ``landing`` (published
through its manifest), ``audit`` (append-only) and ``ledger`` (finished steps). A period
counts as loaded only when the audit log has a SUCCESS for it, so a run that failed at any
step is simply run again: it goes on with the step that failed, as the ledger knows what the
others read and left. A drop whose rows of that period have changed starts them anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanecost.operators.dedup import dedup_marked
from lanecost.plans.flows import REPORT_NAMES, CurateConfig, curate_long, quality_reports
from lanecost.plans.ledger import Ledger, content_fingerprint
from lanecost.sinks.writers import loaded_periods, replace_partition_load, write_by_period, write_reports
from lanecost.sources.scan import ingest_latest_period, scan_period_slice


def paths(base: str) -> dict[str, str]:
    b = base.rstrip("/")
    return {"raw": f"{b}/raw", "curated": f"{b}/curated", "clean": f"{b}/curated/clean",
            "landing": f"{b}/landing", "audit": f"{b}/audit", "ledger": f"{b}/ledger"}


def incremental_period_run(spark: SparkSession, drop: DataFrame, base: str,
                           cfg: CurateConfig = CurateConfig(),
                           period_col: str = "period", load=replace_partition_load) -> tuple[str, int]:
    """Returns ``(period, landing_rows_after_load)``. ``load`` is the last step; it is
    never passed over."""
    p = paths(base)
    ledger = Ledger(spark, p["ledger"])
    loaded = loaded_periods(spark, p["audit"], period_col)
    label, sliced = ingest_latest_period(drop, loaded, period_col)

    def folder(of: str) -> str:
        return f"{of}/{period_col}={label}"

    def long() -> DataFrame:
        return curate_long(scan_period_slice(spark, p["raw"], label, period_col), cfg)

    def curate() -> None:
        write_by_period(dedup_marked(long(), cfg.grain, cfg.order_by)[0], p["curated"], period_col)

    def report() -> None:
        # the reports read the period just written instead of curating it again
        clean = scan_period_slice(spark, p["clean"], label, period_col)
        write_reports(quality_reports(dedup_marked(long(), cfg.grain, cfg.order_by)[1], clean, cfg), p["curated"], period_col, periods=[label])

    raw = ledger.run("ingest", label, [content_fingerprint(sliced)], [folder(p["raw"])],
                     lambda: write_by_period(sliced, p["raw"].rsplit("/", 1)[0], period_col, name="raw"))
    clean = ledger.run("curate", label, [raw, repr(cfg)], [folder(p["clean"])], curate)
    ledger.run("report", label, [raw, clean, repr(cfg)],
               [folder(f"{p['curated']}/quality_reports/{n}") for n in REPORT_NAMES], report)
    total = load(spark, p["clean"], p["landing"], label, p["audit"], period_col=period_col)
    return label, total
