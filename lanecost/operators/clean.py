"""Cleaning and reshaping of the wide quote table.

All operators are narrow (no shuffle): they add projections, one ``Generate``
for the unpivot, and filters that Catalyst pushes toward the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecost.functions.expr import col, mixed_date, null_if_marker

# Fixed values of the source data set.
NULL_MARKER = ".."
GEOGRAPHY_COLUMNS = (
    "source_region",
    "source_lending",
    "source_G8G20",
    "destination_region",
    "destination_lending",
    "destination_G8G20",
)
DATE_FORMATS = ("dd/MMM/yyyy", "yyyy-MM-dd HH:mm:ss")
TIER_PREFIXES = ("cc1 ", "cc2 ")
DRIVING_FIELD = "denomination amount"
PERIOD_QUARTER_PATTERN = r"_(\d)Q"


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming every required column the frame lacks."""
    lacking = sorted(set(columns) - set(df.columns))
    if lacking:
        raise ValueError(f"the frame lacks {len(lacking)} required column(s): {', '.join(map(repr, lacking))}")
    return df


def null_sentinel(df: DataFrame, columns: Sequence[str] = GEOGRAPHY_COLUMNS,
                  marker: str = NULL_MARKER) -> DataFrame:
    """Turn ``marker`` into null in exactly ``columns``; other columns untouched."""
    require_columns(df, columns)
    return df.withColumns({c: null_if_marker(col(c), marker) for c in columns})


def parse_mixed_date(df: DataFrame, column: str = "date",
                     formats: Sequence[str] = DATE_FORMATS,
                     raw_column: str = "date_raw") -> DataFrame:
    """Keep the text in ``raw_column``; ``column`` becomes the first parse that works."""
    require_columns(df, [column])
    parsed = mixed_date(col(column), formats).alias(column)
    return df.select(*[parsed if c == column else col(c) for c in df.columns if c != raw_column],
                     col(column).alias(raw_column))


def parse_period(df: DataFrame, column: str = "period",
                 year_column: str = "period_year",
                 quarter_column: str = "period_quarter") -> DataFrame:
    """``2016_2Q`` -> year 2016, quarter 2; malformed parts become null."""
    require_columns(df, [column])
    year = F.split(col(column), "_").getItem(0).try_cast("int")
    quarter = F.regexp_extract(col(column), PERIOD_QUARTER_PATTERN, 1).try_cast("int")
    return df.withColumns({year_column: year, quarter_column: quarter})


def tier_fields(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    """Field names (prefix stripped) in first-seen column order across prefixes."""
    fields: list[str] = []
    for c in df.columns:
        for p in prefixes:
            if c.startswith(p) and c[len(p):] not in fields:
                fields.append(c[len(p):])
    return fields


def tier_number(prefix: str) -> int:
    """The whole number a prefix ends in (``"cc12 "`` is tier 12)."""
    digits = re.search(r"(\d+)\s*$", prefix)
    if digits is None:
        raise ValueError(f"prefix {prefix!r} ends in no tier number; pass numbers")
    return int(digits[1])


def unpivot_sides(df: DataFrame, prefixes: Sequence[str] = TIER_PREFIXES,
                  driving: str = DRIVING_FIELD, number_column: str = "cc_number",
                  value_name: str = "send_amount",
                  numbers: Sequence[int] | None = None) -> DataFrame:
    """Side-by-side tier column groups -> one row per tier, in a single pass.

    Shared columns are carried, the prefix is stripped, the tier number is added,
    tiers whose ``driving`` cell is null are dropped and ``driving`` is renamed
    ``value_name``. One ``inline(array(struct...))`` replaces a scan per tier.
    """
    prefixes = tuple(prefixes)
    if numbers is None:
        numbers = [tier_number(p) for p in prefixes]
    if len(set(numbers)) != len(prefixes):
        raise ValueError(f"prefixes {prefixes} need one distinct tier number each, got {numbers}")
    shared = [c for c in df.columns if not c.startswith(prefixes)]
    fields = tier_fields(df, prefixes)
    if driving not in fields:
        raise ValueError(f"driving field {driving!r} not found under prefixes {prefixes}")
    present = set(df.columns)

    def tier(prefix: str, number: int):
        cells = {value_name if f == driving else f: col(prefix + f) if prefix + f in present else F.lit(None)
                 for f in fields}
        return F.struct(*[cell.alias(name) for name, cell in cells.items()], F.lit(number).alias(number_column))

    long = df.select(*[col(c) for c in shared], F.inline(F.array(*map(tier, prefixes, numbers))))
    return long.filter(col(value_name).isNotNull())
