"""A ledger of finished steps, so that a run that failed goes on where it stopped.

A step is known by its name and key (here a period), by a fingerprint of what it reads and
by one of the files it left. It is passed over when the ledger has it with the same
input and the files are still those; anything else, a changed drop, another
configuration, a lost file, makes it and so every step that reads its output run again.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.functions.expr import col
from lanecost.sinks.commit_log import CommitLog

log = logging.getLogger(__name__)


def content_fingerprint(df: DataFrame) -> str:
    """Of the rows, whatever their order and files, and of the columns' names and types:
    count, sum and xor of 64-bit row hashes, in one partially aggregated pass."""
    h = F.xxhash64(*[col(c) for c in df.columns])
    r = df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"),
                                    F.bit_xor("h").alias("x")).first()
    return _digest([df.schema.jsonValue(), r["n"], str(r["s"]), r["x"]])


def files_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Of the names, sizes and times of all files below the paths, from listings alone; a path
    that is not there counts as empty."""
    jvm = spark.sparkContext._jvm
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            each = fs.listFiles(p, True)
            while each.hasNext():
                f = each.next()
                found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return _digest([list(paths), sorted(found)])


def _digest(parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, CommitLog.at(spark, path)

    def last(self, step: str, key: str | None) -> dict | None:
        found = [r for r in self.log.records() if (r["step"], r["key"]) == (step, key)]
        return found[-1] if found else None

    def run(self, step: str, key: str | None, reads: Sequence, writes: Sequence[str], work: Callable[[], object]) -> str:
        """Run ``work`` unless it is done; the fingerprint of its files. ``reads``: fingerprints
        and other values that decide the result."""
        wanted, done = _digest(list(reads)), self.last(step, key)
        if done and done["reads"] == wanted and done["left"] == files_fingerprint(self.spark, writes):
            log.info("step %s of %s was done before", step, key)
            return done["left"]
        work()
        left = files_fingerprint(self.spark, writes)
        self.log.append({"step": step, "key": key, "reads": wanted, "left": left})
        return left
