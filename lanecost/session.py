"""Session construction and shared scratch locations.

Scratch tables and lineage cuts go under the cluster's shared
``spark.checkpoint.dir``; a local directory is only chosen when the session has
none configured (tests, laptops).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this library relies on. AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a shuffled join hashes instead of sorting where each build partition is this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files of lineage cuts are removed once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


# Whole-stage generated code for wide rows (~40 columns) routinely exceeds the
# JVM's 8000-byte limit for JIT-compiling a method; such methods would run
# interpreted. Let the JIT compile them (driver and executors).
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"
# Where a session was started without them, a stage with such a method can run operator by
# operator instead, each from small methods.
HUGE_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
# Files the library writes for itself or lays out by period: a quarter to a third smaller.
COMPACT = {"compression": "zstd"}
# Files of different partitions that a task writes at once; with more it sorts its rows.
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "64")


def get_spark(master: str | None = None, app: str = "lanecost",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for side in ("driver", "executor"):
        key = f"spark.{side}.extraJavaOptions"
        user = (extra or {}).get(key, "")
        conf[key] = (user + " " + JIT_OPTIONS).strip() if JIT_OPTIONS not in user else user
    conf.update({k: v for k, v in (extra or {}).items() if not k.endswith("extraJavaOptions")})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only where it is unset and the master is ``local`` (one
    process, as in tests) is a private directory created, registered and removed at
    exit; any other master has nodes that would not see it, so that raises.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="lanecost-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/lanecost/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hold no generated method that the JVM would not compile; for chains
    that compute many columns of every row. The session's own setting is put back."""
    if JIT_OPTIONS in spark.sparkContext.getConf().get("spark.executor.extraJavaOptions", ""):
        yield
        return
    with _setting(spark, *HUGE_METHOD_LIMIT):
        yield


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open for each partition value of a task, up to a
    number, and so neither sort nor spill the rows of a task."""
    with _setting(spark, *OPEN_FILES):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialized(df, name: str):
    """Write the rows once as Parquet under the shared root and read them back: cuts
    the lineage, survives executor loss, and unlike a row checkpoint still prunes
    columns, pushes filters down and knows its size (so the planner, not a row
    count, decides on a broadcast)."""
    path = scratch_path(df.sparkSession, name)
    with small_methods(df.sparkSession):
        df.write.options(**COMPACT).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
