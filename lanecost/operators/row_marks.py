"""A bit for each row of a written frame, held by every task, that parts the rows while the
files are read.

A written row has a number; numbers of one file follow one another. Bits lie in chunks of
``CHUNK`` rows, a row of 64-bit words each, that are broadcast: a bit a row is all they
take, whatever the keys are. Over ``MOST_CHUNKS`` chunks every row is marked instead, which is
right for marks that mean "may be": what they let through is still handled exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.session import materialized

ROW = "__row"
BIT = f"shiftleft(1L, cast({ROW} & 63 as int))"      # of a row in its word
CHUNK_BITS = 12
MOST_CHUNKS = 1 << 18


def placed(df: DataFrame, name: str) -> DataFrame:
    """The rows written once, each with a number of its own (``ROW``). Numbers are fixed by
    the files, so later reads agree on them."""
    return materialized(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def with_mark(rows: DataFrame, marked: DataFrame, name: str) -> DataFrame:
    """``rows`` (of ``placed``) without their numbers, with a boolean ``name``: the row's number
    is among those of ``marked``. Past the bound it is true for every row."""
    return with_marks(rows, marked, {name: F.lit(True)})


def with_marks(rows: DataFrame, marked: DataFrame, marks: Mapping[str, Column], keep_row: bool = False) -> DataFrame:
    """``with_mark`` with a boolean for each of ``marks``: the row's number is in ``marked`` with
    that condition true. All marks come from one pass over ``marked``. ``keep_row`` keeps the
    numbers."""
    chunks = _chunks(marked, list(marks.values()))
    if chunks is None:
        known = rows.withColumns({name: F.lit(True) for name in marks})
    else:
        known = _looked_up(rows, chunks, list(marks))
    return known if keep_row else known.drop(ROW)


def unmarked(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """``rows`` without their numbers and without those whose number is among ``marked``; past
    the bound by a join."""
    chunks = _chunks(marked, [F.lit(True)])
    if chunks is None:
        return rows.join(marked.select(ROW), ROW, "left_anti").drop(ROW)
    return _looked_up(rows, chunks, ["__out"]).filter("not __out").drop("__out", ROW)


def _word(bits: int) -> Column:
    return F.shiftright(ROW, 6).bitwiseAND(F.lit(bits - 1)).cast("int")


def _chunks(marked: DataFrame, marks: Sequence[Column]) -> DataFrame | None:
    """Written words of bits by chunk, an array for each condition; None past the bound."""
    words = 1 << (CHUNK_BITS - 6)
    masks = [f"__mask_{i}" for i in range(len(marks))]
    bits = (marked.select(F.shiftright(ROW, CHUNK_BITS).alias("__chunk"), _word(words).alias("__word"),
                          *[F.when(is_so, F.expr(BIT)).otherwise(F.lit(0).cast("long")).alias(m)
                            for m, is_so in zip(masks, marks, strict=True)])
            .repartition("__chunk").groupBy("__chunk", "__word").agg(*[F.bit_or(m).alias(m) for m in masks])
            .groupBy("__chunk").agg(F.map_from_entries(F.collect_list(
                F.struct("__word", F.struct(*masks).alias("__of")))).alias("__map")))

    def dense(mask: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda i: F.coalesce(
            F.try_element_at(F.col("__map"), i).getField(mask), F.lit(0).cast("long")))

    chunks = materialized(bits.select("__chunk", *[dense(m).alias(m) for m in masks]), "row-marks")
    return None if chunks.count() > MOST_CHUNKS else chunks


def _looked_up(rows: DataFrame, chunks: DataFrame, names: Sequence[str]) -> DataFrame:
    masks = [f"__mask_{i}" for i in range(len(names))]
    return (rows.withColumn("__chunk", F.shiftright(ROW, CHUNK_BITS))
            .join(F.broadcast(chunks), "__chunk", "left")
            .withColumns({name: F.coalesce(F.get(m, _word(1 << (CHUNK_BITS - 6))).bitwiseAND(F.expr(BIT)), F.lit(0).cast("long")) != 0
                          for m, name in zip(masks, names, strict=True)})
            .drop("__chunk", *masks))
