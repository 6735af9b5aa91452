"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lanecost.session import scratch_path, shared_root

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as Parquet into the shared scratch folder and read it
    back: cuts the lineage and survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables whose every reader has been written, and let Spark's cleaner
    find the shuffles of what was computed from them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_root(spark)
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()):
                path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once a context: where the path
    variable workers inherit does not name it, the package goes along as a zip file."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root in paths or getattr(sc, "_lanecost_shipped", False) or not os.path.isdir(root):
        return
    folder = tempfile.mkdtemp(prefix="lanecost-package-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "lanecost"), "zip", root, "lanecost"))
    sc._lanecost_shipped = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array (a new array)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """key -> fn(key), remembered; forgets everything beyond ``limit`` keys, so a
    worker's memory stays bounded whatever the vocabulary."""

    def __init__(self, fn, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        v = self[key] = self.fn(key)
        return v


def slices(batches: Iterable[pa.RecordBatch], text_index: int, most_bytes: int = 2 << 20) -> Iterator[list[list]]:
    """Rows of Arrow batches as lists of column lists, cut so that one slice holds
    about ``most_bytes`` of the text column (at least one row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_index)), 0), dtype=np.int64)
        total = np.cumsum(size)
        at = 0
        while at < n:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + most_bytes, side="right")))
            part = batch.slice(at, end - at)
            yield [c.to_pylist() for c in part.columns]
            at = end


def row_key(*cols: str) -> list:
    """Two key columns that tell rows of different (id, text) apart: rows equal in
    both share a key and, in every operator that uses it, a result. Null safe."""
    ident, text = cols
    return [F.coalesce(F.col(ident).cast("string"), F.lit("\0")).alias("__k1"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__k2")]


def doc_key(id_col: str, text_col: str) -> Column:
    """One column that tells rows of different (id, text) apart and sorts by id, null ids
    last: rows without an id, or of an id used twice, are still judged by their own text."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                    F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
