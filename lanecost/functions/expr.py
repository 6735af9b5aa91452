"""Scalar expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source project's for identical results.
EN_DASH = "–"  # printed for a missing percentage
RIGHT_ARROW = "→"  # separator in corridor labels


def col(name: str) -> Column:
    """Column by exact name; names may contain spaces, '%' or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_marker(c: Column, marker: str) -> Column:
    """``marker`` -> null, everything else (including null) unchanged."""
    return F.nullif(c, F.lit(marker))


def format_literals(fmt: str) -> list[str]:
    """Non-letter characters a datetime pattern matches literally ('/', '-', ':')."""
    out, quoted = [], False
    for ch in fmt:
        if ch == "'":
            quoted = not quoted
        elif quoted or not ch.isalpha():
            if ch not in out:
                out.append(ch)
    return out


def mixed_date(c: Column, formats: Sequence[str]) -> Column:
    """Date from the first format that parses the text; null if none does.

    A format is only tried when the text contains all of its literal separators,
    a necessary condition for a parse, so text of another shape never reaches the
    (exception-driven, slow) failing parse path.
    """
    tries = []
    for f in formats:
        parsed = F.to_date(F.try_to_timestamp(c, F.lit(f)))
        guard = None
        for ch in format_literals(f):
            g = F.instr(c, ch) > 0
            guard = g if guard is None else guard & g
        tries.append(parsed if guard is None else F.when(guard, parsed))
    return F.coalesce(*tries)


def text_bool(c: Column, true_value: str = "yes", false_value: str = "no") -> Column:
    """``lower(trim(x))``: true_value -> true, false_value -> false, else null."""
    norm = F.lower(F.trim(c))
    return F.when(norm == true_value, F.lit(True)).when(norm == false_value, F.lit(False))


def period_label_col(year: Column, quarter: Column) -> Column:
    """``"2016 Q2"`` from year and quarter."""
    return F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string"))


def period_sort_key_col(year: Column, quarter: Column) -> Column:
    return year * 10 + quarter


def round_half_even_exact(x: Column, decimals: int) -> Column:
    """Round a double to ``decimals`` places the way C/Python ``%.Nf`` does.

    ``%.Nf`` rounds the exact binary value half-to-even. Spark's ``round`` and
    ``bround`` round the shortest decimal spelling instead, which differs for
    values such as 2.675 (binary 2.67499999...). The exact product ``x * 10^N``
    is recovered as ``p + e`` with an error-free (Dekker) product, then ``p`` is
    rounded with ``e`` breaking the ties.
    """
    scale = float(10 ** decimals)
    p = x * F.lit(scale)
    split = F.lit(134217729.0) * x  # 2^27 + 1
    hi = split - (split - x)
    lo = x - hi
    err = (hi * F.lit(scale) - p) + lo * F.lit(scale)
    fl = F.floor(p).cast("double")
    frac = p - fl
    up = (frac > 0.5) | ((frac == 0.5) & ((err > 0) | ((err == 0) & (F.pmod(fl, F.lit(2.0)) == 1.0))))
    n = F.when(up, fl + 1.0).otherwise(fl) / F.lit(scale)
    # a negative input (or -0.0) keeps its sign even when it rounds to zero
    negative = (x < 0) | (x.cast("string") == "-0.0")
    return (F.when(x.isNull() | F.isnan(x), x)
             .when(negative, -F.abs(n)).otherwise(n))


def fmt_pct(x: Column, decimals: int = 2) -> Column:
    """``"12.35%"``; an en dash for null or NaN."""
    rounded = round_half_even_exact(x.cast("double"), decimals)
    text = F.format_string(f"%.{decimals}f%%", rounded)
    return F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(EN_DASH)).otherwise(text)


def fmt_count(x: Column) -> Column:
    """Thousands separators for whole numbers: ``1,234,567``."""
    return F.format_number(x.cast("long"), 0)
