"""Rows laid out along a space-filling curve, so that files hold small ranges of several
columns at once and a filter on any of them skips most files by their statistics.

Each column is cut into ranges of about equally many rows (approximate quantiles), a row's
range numbers are interleaved bit by bit (Z-order), and rows are dealt to files by ranges of
that number. Equal values share a range. The cuts, fewer than ``2 ** bits`` numbers a
column, are all that reaches the driver; where they fall changes the layout only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col

BITS = 6
_PREFIX_BYTES = 6      # of a text, as a whole number that a double holds exactly


def _as_number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column (of the first bytes, for texts)."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = 2 * _PREFIX_BYTES
        return F.conv(F.rpad(F.hex(col(name).cast("binary")), digits, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col(name)).cast("double")
    return col(name).cast("double")


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BITS, name: str = "__z") -> DataFrame:
    """``df`` with the position of its rows on the curve through ``columns``. Nulls come first.

    The range of a value is found by halving, a step a column, and all steps are compiled. A
    filter of the array of cuts is not, and ran again for every bit of the position; a
    comparison with every cut makes a method that the JVM does not compile."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("between 1 and 62 bits in all")
    pieces = 2 ** bits - 1          # one range is left for nulls
    value = {j: f"{name}_value_{j}" for j in range(len(columns))}
    below = {j: f"{name}_below_{j}" for j in value}
    out = df.withColumns({value[j]: _as_number(df, c) for j, c in enumerate(columns)})
    found = out.agg(*[F.percentile_approx(F.nanvl(F.col(v), F.lit(None)), [i / pieces for i in range(1, pieces)],
                                          20 * pieces).alias(v) for v in value.values()]).first()
    # nothing is above NaN, so a search never goes past the last cut
    cuts = {j: F.array(*[F.lit(c) for c in (sorted(set(found[v] or [])) + [float("nan")] * pieces)[:pieces]])
            for j, v in value.items()}
    for i in reversed(range(bits)):
        so_far = {j: F.col(b) if i < bits - 1 else F.lit(0) for j, b in below.items()}
        out = out.withColumns({below[j]: n.bitwiseOR(F.when(
            F.col(value[j]) > F.get(cuts[j], n.bitwiseOR(F.lit(2 ** i - 1))), 2 ** i).otherwise(0)) for j, n in so_far.items()})
    out = out.withColumns({b: F.when(F.col(value[j]).isNull(), 0).otherwise(F.col(b) + 1).cast("long") for j, b in below.items()})
    one, z = F.lit(1).cast("long"), F.lit(0).cast("long")
    for j, b in below.items():
        for i in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(b), i).bitwiseAND(one), i * len(below) + j))
    return out.withColumn(name, z).drop(*value.values(), *below.values())


def clustered(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """Rows of ``df`` dealt to partitions by ranges of (``within``, curve position) and sorted
    so inside each. Rows of one position are dealt on by their hash, so a pair of values
    that holds a third of all rows does not land in one task."""
    hashable = [col(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    keyed = z_value(df, columns, bits).withColumn("__mix", F.xxhash64(*hashable))
    order = [*[col(w) for w in within], col("__z"), col("__mix")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__z", "__mix")
