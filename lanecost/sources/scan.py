"""Readers: guarded scans, period slices, loaded-period discovery, incremental
ingest of the newest unseen period, typed reference CSVs and mart reads."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col
from lanecost.operators.model import checked_dim

log = logging.getLogger(__name__)

# Fixed shape of the source workbook export.
EXPECTED_COLUMNS = 42
EXPECTED_ROWS = 197_999
PERIOD_PATTERN = r"^\d{4}_\dQ$"


def guard_shape(df: DataFrame, expected_columns: int | None = EXPECTED_COLUMNS,
                expected_rows: int | None = None, strict_rows: bool = False) -> DataFrame:
    """Column-count drift raises; row-count drift warns (or raises if strict).

    The row count is only taken when an expected count is given (one job; for a
    parquet scan it is answered from file footers).
    """
    if expected_columns is not None and len(df.columns) != expected_columns:
        raise ValueError(f"Column count mismatch: the frame has {len(df.columns)} columns, "
                         f"{expected_columns} were agreed on.")
    if expected_rows is not None:
        n = df.count()
        if n != expected_rows:
            if strict_rows:
                raise ValueError(f"Row count mismatch: the frame has {n} rows, {expected_rows} were agreed on.")
            log.warning("%s rows instead of the agreed %s; a newly published period would explain it",
                        n, expected_rows)
    return df


def scan_guarded(spark: SparkSession, path: str, expected_columns: int | None = EXPECTED_COLUMNS,
                 expected_rows: int | None = EXPECTED_ROWS, strict_rows: bool = False) -> DataFrame:
    return guard_shape(spark.read.parquet(path), expected_columns, expected_rows, strict_rows)


def convert_full_history(spark: SparkSession, source: DataFrame, target: str, expected_rows: int,
                         expected_columns: int | None = EXPECTED_COLUMNS,
                         text_columns: Sequence[str] = ("date",)) -> DataFrame:
    """Write the whole history once: both shape guards are strict, the named columns
    become text. Returns the rows read back."""
    df = guard_shape(source, expected_columns, expected_rows, strict_rows=True)
    casts = {c: col(c).cast("string") for c in text_columns if c in df.columns}
    df = df.withColumns(casts) if casts else df
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def scan_period_slice(spark: SparkSession, path: str, period: str | None = None,
                      period_col: str = "period") -> DataFrame:
    """The whole dataset, or one period of it. On a period-partitioned layout the
    equality filter prunes to that partition's files."""
    df = spark.read.parquet(path)
    return df if period is None else df.filter(col(period_col) == period)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_loaded_periods(spark: SparkSession, path: str, period_col: str = "period",
                        pattern: str = PERIOD_PATTERN) -> DataFrame:
    """Distinct period labels present in a period-partitioned dataset.

    Only labels shaped like a period count (a sibling such as ``full_history`` is
    not a period). A missing dataset has no periods.
    """
    schema = T.StructType([T.StructField(period_col, T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    labels = [p for p in list_partitions(spark, path, period_col) if p is not None]
    return spark.createDataFrame([(p,) for p in labels], schema).filter(col(period_col).rlike(pattern))


def list_partitions(spark: SparkSession, path: str, period_col: str = "period") -> list[str | None]:
    """Values of the partition folders of a dataset that hold a data file, from the
    folder listing alone; the null partition is None."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    catalog = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(f"{period_col}=") and any(
                f.isDirectory() or f.getPath().getName().endswith(".parquet") for f in fs.listStatus(s.getPath())):
            value = catalog.unescapePathName(name.split("=", 1)[1])
            out.append(None if value == catalog.DEFAULT_PARTITION_NAME() else value)
    return sorted(out, key=lambda v: (v is None, v))


def newest_unloaded_period(drop: DataFrame, loaded: DataFrame, period_col: str = "period") -> str:
    """Max of (periods in the drop minus loaded periods); raise if none is new.
    Period labels sort correctly as text."""
    new = (drop.select(col(period_col)).distinct()
               .join(loaded.select(col(period_col)).distinct(), on=period_col, how="left_anti"))
    label = new.agg(F.max(col(period_col)).alias("p")).first()["p"]
    if label is None:
        raise ValueError("No new periods: the drop holds only loaded ones.")
    return label


def ingest_latest_period(drop: DataFrame, loaded: DataFrame, period_col: str = "period",
                         text_columns: Sequence[str] = ("date",)) -> tuple[str, DataFrame]:
    """``(label, slice)``: only the newest unseen period is taken (older gaps stay
    unloaded); the named columns are carried as text."""
    label = newest_unloaded_period(drop, loaded, period_col)
    sliced = drop.filter(col(period_col) == label)
    casts = {c: col(c).cast("string") for c in text_columns if c in drop.columns}
    return label, sliced.withColumns(casts) if casts else sliced


def scan_reference_csv(spark: SparkSession, path: str, schema: T.StructType,
                       key: str | None = None) -> DataFrame:
    """Typed CSV with a header (quoted commas allowed); the key must be unique."""
    df = (spark.read.schema(schema).option("header", True).option("quote", '"')
               .option("escape", '"').option("mode", "FAILFAST").csv(path))
    if key is not None:
        checked_dim(df, key)
    return df


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")
