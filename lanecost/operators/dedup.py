"""Duplicate handling at a stated grain, built to survive hot keys.

The obvious plan, ``row_number()`` over a window partitioned by the grain, sends
every row of a group to one task: a grain value holding a third of the table
becomes a third of the job on one core. Here the work is split instead:

1. ``split_repeated``: pairs of key hash and row position are counted by hash (partial
   aggregation collapses a hot key on the map side), and a bit a row tells the rows of
   repeated keys apart. Rows of unique keys pass without a shuffle.
2. The first row of a repeated group is ``min(struct(order..., rest...))``, a partially
   aggregated (map-side combined) aggregate. Group frames that joins need are written first,
   so the planner broadcasts them by their size in bytes or else makes shuffle joins whose
   skewed partitions AQE splits.
3. The report (every row after the first) is the group's other rows plus
   ``k - 1`` copies of the first row when ``k`` rows are identical to it; the
   copies are generated in chunks spread across tasks.

With few duplicates (the usual case) no full row is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.functions.expr import col
from lanecost.operators.clean import require_columns
from lanecost.operators.key_filter import MOST_BITS, KeyFilter, slot_of
from lanecost.operators.row_marks import ROW, placed, unmarked, with_mark, with_marks
from lanecost.session import materialized
from lanecost.operators.util import (
    join_on_keys,
    replicate,
)

# Fixed grain of the source pipeline: corridor, firm, instrument, period, amount.
GRAIN_COLUMNS = ("corridor", "firm", "payment instrument", "period", "send_amount")
COUNT_COLUMN = "duplicate_count"


def duplicate_groups(df: DataFrame, keys: Sequence[str],
                     count_column: str = COUNT_COLUMN) -> DataFrame:
    """Keys occurring more than once, with their row count (null keys group together)."""
    return (df.groupBy(*[col(k) for k in keys])
              .agg(F.count(F.lit(1)).alias(count_column))
              .filter(col(count_column) > 1))


def split_repeated(df: DataFrame, keys: Sequence[str], stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(singles, members)``: rows whose key is unique, and all rows of repeated keys (with,
    at most, a few more whose 64-bit hash meets another's, so members are still to be grouped
    exactly). No full row is shuffled: the rows are written once as Parquet, only
    (hash, position) pairs meet, and a bit a row tells the two parts apart while the files
    are read. ``stored`` says that ``df`` is read from files already; it is then written
    again only if a key repeats."""
    keys = [col(k) for k in keys]

    def hashes(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__hash", F.xxhash64(*keys))

    def repeated(rows: DataFrame) -> DataFrame:
        return materialized(hashes(rows).groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"))
                            .filter("__n > 1").select("__hash"), "repeated")

    again = repeated(df) if stored else None
    if stored and again.isEmpty():
        return df, df.limit(0)
    rows = placed(df, "rows")
    if again is None:
        again = repeated(rows)
    marked = with_mark(rows, hashes(rows).select("__hash", ROW).join(again, "__hash", "left_semi"), "__maybe")
    return marked.filter("not __maybe").drop("__maybe"), marked.filter("__maybe").drop("__maybe")


def split_leading(rows: DataFrame, keys: Sequence[str], lead: str, among: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(singles, leading, later, groups)`` of the ``placed`` rows: rows whose key is unique; of the
    repeated keys, the rows with the least ``lead`` of their key (nulls first), among which the
    first row of every group is, and the other rows. These two keep the rows' numbers. ``groups``:
    hash and row count (``__n``) of the repeated keys, and whether keys share the hash
    (``__mixed``). ``among``: the only rows (numbers and all) whose keys may repeat.

    No full row is shuffled: hashes are counted first, alone; only rows that a bit array of the
    repeated ones lets through are grouped, with their lead, and meet their group again by hash,
    and two bits a row part the files. Keys that share the hash are told apart by a second one, where a
    null counts; all rows of such a hash are leading. So ``leading`` may hold a few rows too many
    and is still to be grouped by the keys."""
    columns = [col(k) for k in keys]
    again = (rows if among is None else among).groupBy(F.xxhash64(*columns).alias("__hash")).agg(F.count(F.lit(1)).alias("n"))
    slots = again.filter("n > 1").select(F.pmod("__hash", F.lit(MOST_BITS)).alias("slot"))
    narrow = (rows if among is None else among).select(*[col(c) for c in dict.fromkeys([*keys, lead])], ROW)
    pairs = KeyFilter.of_slots(slots, MOST_BITS).flag(narrow, keys, "__maybe").filter("__maybe").select(
        F.xxhash64(*columns).alias("__hash"), F.xxhash64(*[c for k in columns for c in (k.isNull(), k)]).alias("__check"),
        col(lead).alias("__lead"), ROW)
    groups = materialized(pairs.groupBy("__hash").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__lead").alias("__least"),
        F.max(F.col("__lead").isNull()).alias("__unset"),
        (F.min("__check") != F.max("__check")).alias("__mixed")).filter("__n > 1"), "repeated")
    leads = F.when(F.col("__mixed"), True).when(F.col("__unset"), F.col("__lead").isNull()).otherwise(
        F.col("__lead") == F.col("__least"))
    met = pairs.drop("__check").join(groups.drop("__n"), "__hash")
    marked = with_marks(rows, met, {"__maybe": F.lit(True), "__leads": leads}, keep_row=True)
    part = lambda condition: marked.filter(condition).drop("__maybe", "__leads")
    return part("not __maybe").drop(ROW), part("__maybe and __leads"), part("__maybe and not __leads"), groups


def flag_duplicates(df: DataFrame, keys: Sequence[str] = GRAIN_COLUMNS,
                    count_column: str = COUNT_COLUMN, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(clean, flagged)``: clean = rows whose key is unique; flagged = every row
    of a repeated key, with the group's ``count_column``. Only rows that ``split_repeated``
    finds are joined with the repeated keys, which are written once, so the planner knows
    their size in bytes when it picks the joins. ``stored`` as there."""
    keys = list(keys)
    require_columns(df, keys)
    singles, members = split_repeated(df, keys, stored)
    groups = materialized(duplicate_groups(members, keys, count_column), "groups")
    clean = singles.unionByName(join_on_keys(members, groups, keys, "left_anti"))
    flagged = join_on_keys(members, groups, keys, "inner").select(
        *[col(c) for c in df.columns], col(count_column))
    return clean, flagged


def dedup_first(df: DataFrame, keys: Sequence[str] = GRAIN_COLUMNS,
                order_by: Sequence[str] = ("id",), strategy: str = "aggregate") -> DataFrame:
    """The clean half of ``dedup_grain`` alone (no report plan is built)."""
    return dedup_grain(df, keys, order_by, COUNT_COLUMN, strategy, with_report=False)[0]


def dedup_marked(df: DataFrame, keys: Sequence[str] = GRAIN_COLUMNS, order_by: Sequence[str] = ("id",),
                 count_column: str = COUNT_COLUMN) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``dedup_grain(strategy="marked")`` with the report built when it is asked for."""
    keys, order_by = list(keys), list(order_by)
    require_columns(df, keys + order_by)
    return _Grouped(df.columns, keys, order_by, count_column).by_marks(placed(df, "rows"))


class _Grouped:
    """Firsts and the others of grain groups; ``__first`` is the rank of a group's first row."""

    def __init__(self, columns: Sequence[str], keys: Sequence[str], order_by: Sequence[str], count_column: str):
        self.columns, self.keys, self.count_column = columns, keys, count_column
        self.ranked = [*order_by, *[c for c in columns if c not in order_by and c not in keys]]
        self.lead = (self.ranked or list(keys))[0]

    def rank(self) -> Column:
        return F.struct(*[col(c).alias(c) for c in self.ranked])

    def unpack(self, frame: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        return frame.select(*[(col(c) if c in self.keys else F.col("__first").getField(c)).alias(c)
                              for c in self.columns], *[col(e) for e in extra])

    def first_per_group(self, rows: DataFrame) -> DataFrame:
        """First row and row count of each group; of ``placed`` rows, the number of the first too."""
        rank = F.struct(*[col(c).alias(c) for c in self.ranked], *[F.col(c) for c in rows.columns if c == ROW])
        return (rows.groupBy(*[col(k) for k in self.keys])
                    .agg(F.min(rank).alias("__first"),
                         F.count(F.lit(1)).alias(self.count_column)))

    def by_marks(self, rows: DataFrame, among: DataFrame | None = None) -> tuple[DataFrame, Callable[[], DataFrame]]:
        """Clean rows and report of ``placed`` rows: only those that lead their key are
        aggregated whole (``split_leading``), with their number, so the report is all other
        rows of repeated keys; the one shuffle of these brings them the counts by hash."""
        singles, leading, later, groups = split_leading(rows, self.keys, self.lead, among)
        firsts = materialized(self.first_per_group(leading).drop(self.count_column), "firsts")

        def report() -> DataFrame:
            others = later.drop(ROW).unionByName(unmarked(leading, firsts.select(F.col("__first").getField(ROW).alias(ROW))))
            columns = [*[col(c) for c in self.columns], col(self.count_column)]
            hashed = others.withColumn("__hash", F.xxhash64(*[col(k) for k in self.keys]))
            counts = groups.select("__hash", F.col("__n").alias(self.count_column))
            if groups.filter("__mixed").isEmpty():
                return hashed.join(counts, "__hash").select(*columns)
            # keys that share a hash are counted by themselves, with their firsts
            shared = groups.filter("__mixed").select("__hash")
            several = hashed.join(shared, "__hash", "left_semi").drop("__hash")
            sizes = several.groupBy(*[col(k) for k in self.keys]).agg((F.count(F.lit(1)) + 1).alias(self.count_column))
            return (hashed.join(counts.join(shared, "__hash", "left_anti"), "__hash").select(*columns).unionByName(join_on_keys(several, sizes, self.keys).select(*columns)))

        return singles.unionByName(self.unpack(firsts)), report

    def report(self, rows: DataFrame, dup_firsts: DataFrame) -> DataFrame:
        """Rows of the repeated groups after their first, from all ``rows`` of those groups."""
        tagged = join_on_keys(rows, dup_firsts, self.keys, "inner")
        is_first = self.rank().eqNullSafe(F.col("__first"))
        others = tagged.filter(~is_first).select(*[col(c) for c in self.columns], col(self.count_column))
        same_as_first = (tagged.filter(is_first)
                               .groupBy(*[col(k) for k in self.keys])
                               .agg(F.count(F.lit(1)).alias("__k")))
        copies = (join_on_keys(dup_firsts, same_as_first, self.keys, "inner")
                  .withColumn("__copies", col("__k") - 1))
        return others.unionByName(self.unpack(replicate(copies, "__copies", self.keys), [self.count_column]))


def dedup_grain(df: DataFrame, keys: Sequence[str] = GRAIN_COLUMNS,
                order_by: Sequence[str] = ("id",),
                count_column: str = COUNT_COLUMN,
                strategy: str = "aggregate",
                with_report: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """``(clean, report)``: keep the first row of each grain group, report the rest.

    "First" is the ascending order of ``order_by`` then every remaining column
    (nulls first), a total order up to rows that are identical anyway, so the
    result does not depend on file or partition order. The report carries the
    group's ``count_column``; helper columns never leak.

    ``strategy="aggregate"`` (default) reads the input once: every group keeps
    ``min(struct(order..., rest...))`` and its count through a partially
    aggregated (map-side combined) aggregate, so a hot key is collapsed before
    the shuffle. ``strategy="marked"`` writes the rows once as Parquet to shared scratch and
    lets rows of unique keys pass without a shuffle or a sort; of repeated keys only the rows
    with the least leading order value are aggregated (``split_leading``), and the first of each
    group is written too, so the clean rows and the report are read from files. ``strategy="split"`` parts the rows in
    the same way, counts the repeated keys alone and ranks only the groups of more than
    one row. The joins are sized by the planner and AQE; with ``with_report=False`` no report plan is built (``None``).

    ``strategy="filter"`` writes the rows once too. A first pass over their keys alone counts the
    slots of a bit array and keeps those that two or more rows fall into; rows of any
    other slot are unique, and only the rest goes through the steps of ``marked``. The
    array is bounded, so with many more rows than bits the rest is everything, and the
    result the same.
    """
    keys = list(keys)
    order_by = list(order_by)
    require_columns(df, keys + order_by)
    if strategy not in ("aggregate", "split", "filter", "marked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    grouped = _Grouped(df.columns, keys, order_by, count_column)
    repeats = col(count_column) > 1

    if strategy == "marked":
        clean, report = dedup_marked(df, keys, order_by, count_column)
        return clean, report() if with_report else None
    if strategy == "filter":
        rows = placed(df, "rows")
        slots = rows.select(slot_of([col(k) for k in keys], MOST_BITS).alias("slot"))
        again = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(col("n") > 1).select("slot")
        narrow = rows.select(*[col(c) for c in dict.fromkeys([*keys, grouped.lead])], ROW)
        among = KeyFilter.of_slots(again, MOST_BITS).flag(narrow, keys, "__maybe").filter("__maybe")
        clean, report = grouped.by_marks(rows, among)
        return clean, report() if with_report else None
    if strategy == "aggregate":
        members = df
        firsts = grouped.first_per_group(df)
        clean = grouped.unpack(firsts)
        dup_firsts = firsts.filter(repeats)
    else:
        singles, maybe = split_repeated(df, keys)
        groups = materialized(duplicate_groups(maybe, keys, count_column), "groups")
        members = join_on_keys(maybe, groups, keys, "inner").drop(count_column)
        dup_firsts = grouped.first_per_group(members)
        clean = (singles.unionByName(join_on_keys(maybe, groups, keys, "left_anti"))
                 .unionByName(grouped.unpack(dup_firsts)))
    return clean, grouped.report(members, dup_firsts) if with_report else None
