"""A bit array of keys, held by every task, that tells most foreign rows apart before a
shuffle.

A key sets the bit of its 64-bit hash modulo the number of bits. The array is a table of
words (64 bits a row), built by a partially aggregated ``bit_or`` and broadcast: its size
has a bound, ``most_bits``, whatever the number of keys. A row whose bit is not set has none of
the keys; a set bit proves nothing, so what the filter lets through must still be joined or
counted exactly. With far more keys than bits it lets everything through, and stays right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.functions.expr import col
from lanecost.session import materialized

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26


def bits_for(keys: int, most_bits: int = MOST_BITS) -> int:
    """A power of two: at least ``BITS_PER_KEY`` bits a key, within the bounds."""
    bits = LEAST_BITS
    while bits < min(keys * BITS_PER_KEY, most_bits):
        bits *= 2
    return bits


def slot_of(columns: Sequence[Column], bits: int) -> Column:
    """Number of the bit of a key. Nulls hash like any value; -0.0 is 0.0."""
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


class KeyFilter:
    """``words``: (word, mask) rows; ``bits``: their number of bits."""

    def __init__(self, words: DataFrame, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of_slots(cls, slots: DataFrame, bits: int) -> KeyFilter:
        """From a frame with a column ``slot``; written once, so it is built once."""
        words = (slots.select(F.shiftright("slot", 6).alias("__word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("m"))
                 .groupBy("__word").agg(F.bit_or("m").alias("__mask")))
        return cls(materialized(words, "key-filter"), bits)

    @classmethod
    def of_keys(cls, keys: DataFrame, columns: Sequence[str], count: int, most_bits: int = MOST_BITS) -> KeyFilter:
        """From the rows of ``keys``, about ``count`` of them."""
        bits = bits_for(count, most_bits)
        return cls.of_slots(keys.select(slot_of([col(c) for c in columns], bits).alias("slot")), bits)

    def flag(self, rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        """``rows`` with a boolean ``name``: the key may be one of the keys. No shuffle: the
        words are broadcast, ``bits / 64`` rows of two longs at most."""
        slot = slot_of([col(c) for c in columns], self.bits)
        there = F.expr("coalesce(__mask & shiftleft(1L, cast(__slot & 63 as int)), 0L) != 0")
        return (rows.withColumn("__slot", slot).withColumn("__word", F.shiftright("__slot", 6))
                .join(F.broadcast(self.words), "__word", "left")
                .withColumn(name, there).drop("__slot", "__word", "__mask"))
