"""Quality splits: separate suspicious rows without losing any.

A split is one boolean flag that is never null (an undecidable row is not
suspicious); the two halves are that flag and its negation, so together they are
exactly the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.functions.expr import col


def split_on(df: DataFrame, suspicious: Column) -> tuple[DataFrame, DataFrame]:
    """``(clean, flagged)`` by a condition; null counts as clean."""
    flag = F.coalesce(suspicious, F.lit(False))
    return df.filter(~flag), df.filter(flag)


def split_negative(df: DataFrame, column: str = "fx margin") -> tuple[DataFrame, DataFrame]:
    return split_on(df, col(column) < 0)


def split_equals(df: DataFrame, column: str, word: str) -> tuple[DataFrame, DataFrame]:
    """Flag texts equal to ``word`` but for case and outer blanks."""
    return split_on(df, F.trim(F.lower(col(column))) == word.strip().lower())


def split_nontransparent(df: DataFrame, column: str = "transparent") -> tuple[DataFrame, DataFrame]:
    return split_equals(df, column, "no")
