"""Writers: partitioned curated output, quality reports, idempotent per-period
loads with an audit log, mart snapshots.

Curated rows and reports are one ``partitionBy`` write with dynamic partition
overwrite: only the periods present in the data are replaced, other periods are
untouched, and no per-period driver loop is needed. Loads into the landing table are
published all at once through its manifest (``versioned``).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col
from lanecost.operators.model import LANDING_SCHEMA, conform_landing
from lanecost.session import COMPACT, open_files, scratch_path, small_methods
from lanecost.sinks.clustering import clustered
from lanecost.sinks.commit_log import CommitLog, HadoopFolder
from lanecost.sinks.versioned import VersionedTable
from lanecost.sources.scan import list_partitions

log = logging.getLogger(__name__)

AUDIT_SCHEMA = T.StructType([
    T.StructField("load_id", T.LongType()),
    T.StructField("quarter_label", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


def _overwrite_partitions(df: DataFrame, path: str, period_col: str, grouped: bool = False) -> None:
    """Replace the partitions present in ``df``. Rows are regrouped by period first, so
    a partition gets a few files of the advised size and not one of every task; the
    rebalance lets the planner split a hot period and merge small ones. ``grouped`` rows are
    read from files by period, of which a task has few periods: they are not shuffled again."""
    spark = df.sparkSession
    with small_methods(spark), open_files(spark):
        ((df if grouped else df.hint("rebalance", col(period_col))).write.mode("overwrite").options(**COMPACT)
         .option("partitionOverwriteMode", "dynamic").partitionBy(period_col).parquet(path))


def in_periods(period_col: str, periods: Sequence[str | None]):
    """Condition: the row belongs to one of the periods; None is the null period."""
    cond = col(period_col).isin([p for p in periods if p is not None])
    return cond | col(period_col).isNull() if None in periods else F.coalesce(cond, F.lit(False))


def delete_partitions(spark: SparkSession, path: str, period_col: str,
                      periods: Sequence[str | None]) -> None:
    """Remove the given partition folders (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for p in periods:
        value = names.DEFAULT_PARTITION_NAME() if p is None else names.escapePathName(p)
        hp = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{period_col}={value}")
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)


def write_by_period(df: DataFrame, base: str, period_col: str = "period",
                    name: str = "clean", cluster_by: Sequence[str] = (),
                    max_rows: int | None = None, grouped: bool = False) -> str:
    """Write under ``<base>/<name>/<period_col>=<p>/``; rewrites only the periods
    in ``df``. A null period lands in the default partition, not lost. With ``cluster_by``
    the rows of a period are laid out along a space-filling curve through those columns
    (``df`` is then read twice), in files of at most ``max_rows`` rows where given.
    ``grouped`` says that rows come by period already (see ``_overwrite_partitions``)."""
    path = f"{base.rstrip('/')}/{name}"
    if not cluster_by:
        _overwrite_partitions(df, path, period_col, grouped)
        return path
    with small_methods(df.sparkSession):
        writer = (clustered(df, cluster_by, [period_col]).write.mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic").partitionBy(period_col))
        (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(path)
    return path


def write_reports(reports: Mapping[str, DataFrame], base: str, period_col: str = "period",
                  periods: Sequence[str | None] = (), grouped: Collection[str] = ()) -> dict[str, str]:
    """Each report under ``<base>/quality_reports/<name>``, partitioned by period
    so a one-period run replaces only that period. ``periods`` names the periods
    this run covers: those for which a report now has no rows lose their old
    partition, after the new ones are in place, so a failed write leaves the old
    report whole. ``grouped`` names the reports whose rows come by period already."""
    out = {}
    for name, df in reports.items():
        path = f"{base.rstrip('/')}/quality_reports/{name}"
        if period_col not in df.columns:
            df.write.mode("overwrite").parquet(path)
        elif periods:
            fresh = write_by_period(df, scratch_path(df.sparkSession, "report"), period_col, name, grouped=name in grouped)
            present = list_partitions(df.sparkSession, fresh, period_col)
            _overwrite_partitions(df.sparkSession.read.schema(df.schema).parquet(fresh), path, period_col, grouped=True)
            delete_partitions(df.sparkSession, path, period_col, [p for p in periods if p not in present])
        else:
            _overwrite_partitions(df, path, period_col, name in grouped)
        out[name] = path
    return out


def append_audit(spark: SparkSession, audit_path: str, periods: str | None | Sequence[str | None], rows: int,
                 status: str, error: str | None = None) -> list[int]:
    """Append one audit row per period (None: the null period); their load ids, which no
    other load has (see ``commit_log``)."""
    periods = [periods] if periods is None or isinstance(periods, str) else list(periods)
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return CommitLog.at(spark, audit_path).append_all(
        [{"quarter_label": p, "loaded_at": now, "row_count": int(rows), "status": status, "error_message": error}
         for p in periods], "load_id")


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """The audit log; a log that does not exist yet is empty."""
    if not HadoopFolder(spark, audit_path).names():
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).json(audit_path)


def loaded_periods(spark: SparkSession, audit_path: str, period_col: str = "period") -> DataFrame:
    """Periods with a successful load in the audit log."""
    return (read_audit(spark, audit_path).filter((col("status") == "SUCCESS") & col("quarter_label").isNotNull())
            .select(col("quarter_label").alias(period_col)).distinct())


def replace_partition_load(spark: SparkSession, source: DataFrame | str, target: str,
                           period: str | None | Sequence[str | None], audit_path: str,
                           schema: T.StructType = LANDING_SCHEMA,
                           period_col: str = "period", grouped: bool = False) -> int:
    """Idempotently (re)load one or more periods into ``target``; return the
    table's total row count afterwards. None is the null period.

    The periods' rows are conformed to ``schema`` by case-insensitive name and written
    once, as a version that nobody reads; one record of the table's manifest then
    switches all of the periods to it (other periods untouched; rerunning changes
    nothing). Whatever fails or dies before leaves the old rows to every reader
    (``read_landing``). A period with no source rows is an error rather than a
    silent delete. Every attempt is appended to the audit log, one row per period:
    SUCCESS with the cumulative row count, or FAILED with 0 and the whole message,
    after which the error is re-raised. ``grouped`` says that the rows come by period already.
    """
    periods = [period] if period is None or isinstance(period, str) else list(period)
    table = VersionedTable(spark, target, period_col)
    try:
        src = spark.read.parquet(source) if isinstance(source, str) else source
        sliced = conform_landing(src.filter(in_periods(period_col, periods)), schema)
        version, rows = table.write_version(sliced, grouped)
        missing = [str(p) for p in periods if p not in rows]
        if missing:
            raise ValueError(f"no source rows for period {', '.join(missing)}")
        table.publish(version, rows)
        total = table.rows()
    except Exception as e:
        try:
            append_audit(spark, audit_path, periods, 0, "FAILED", str(e) or type(e).__name__)
        except Exception:
            log.exception("the failed load of %s could not be audited", periods)
        raise
    append_audit(spark, audit_path, periods, total, "SUCCESS")
    log.info("periods %s replaced; %d rows in the table", periods, total)
    return total


def read_landing(spark: SparkSession, target: str, schema: T.StructType = LANDING_SCHEMA,
                 period_col: str = "period") -> DataFrame:
    """The rows that loads have published in ``target``."""
    return VersionedTable(spark, target, period_col).read(schema)


def rename_lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def export_marts(marts: Mapping[str, DataFrame], base: str) -> dict[str, int]:
    """Snapshot each mart (lower-cased column names) and return its row count,
    measured during the write by an observation (no second pass)."""
    counts = {}
    for name, df in marts.items():
        obs = Observation(f"export_{name}")
        (rename_lower(df).observe(obs, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}"))
        counts[name] = int(obs.get["rows"])
        log.info("%s -> %d rows written", name, counts[name])
    return counts


def materialize(df: DataFrame, name: str, base: str | None = None, kind: str = "table") -> DataFrame:
    """``view``: a temp view (lazy, re-evaluated by each reader); ``table``: a
    parquet snapshot under ``base`` read back (computed once)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if base is None:
        raise ValueError("a table needs a base path")
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
