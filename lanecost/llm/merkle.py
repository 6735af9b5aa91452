"""Merkle manifest of a table: parent-linked node rows, climbed by a recursive query.

Leaves are digests of rows, ordered by key within a group; every ``fanout`` consecutive
nodes of a level become one node above them, until a group has one node, its subroot.
The subroots, in the order of their groups, are combined the same way into the root.

Numbering the leaves of a group needs no task that sees the group: rows are sorted by
ranges of (group, key, digest), numbered within their partition, and shifted by the sizes
of the partitions before it. Equal rows are counted first and spread again, so copies
are never one range. A node's id follows from its level and number, so parents are known
without a join. All levels are written as Parquet: (node, parent, slot, children).

A proof is read by one recursive query: leaves of one run share their path, so a run
climbs as one row that appends the siblings of each ancestor and folds the digest of each
of its leaves. Only parent links are followed; nothing is recomputed from other rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lanecost.llm.util import stage

HEX = 64            # characters of one digest
_LEVEL = 56         # a node id is (level << _LEVEL) + number
_TOP = 32           # levels above the subroots count from here


@dataclass(frozen=True)
class Manifest:
    """``runs``: the lowest nodes with their members (key, leaf, claimed), their group's
    number and their link upwards; ``nodes``: all nodes above them, linked likewise;
    ``groups``: each group's number and subroot; ``root``: the one digest (None of an empty table)."""
    runs: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None


def encoded(name: str, value: Column | None = None) -> Column:
    """A column (or ``value`` in its place) as text that no other value shares: its UTF-8
    bytes counted, ``:`` and itself; ``-`` for null."""
    s = (F.col(name) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts) -> Column:
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def _spread(rows: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Each different row as often as it occurs, told apart by ``__copy``: copies are
    counted map-side, then made again in chunks that are dealt out."""
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    single = counted.filter(F.col("__n") == 1).select(*names, F.lit(0).cast("long").alias("__copy"))
    chunks = (counted.filter(F.col("__n") > 1)
              .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {chunk}"))))
              .repartition(*names, "__chunk"))
    low = F.col("__chunk") * chunk
    many = chunks.select(*names, F.explode(F.sequence(low, F.least(low + chunk, F.col("__n")) - 1)).alias("__copy"))
    return single.unionByName(many)


def numbered(rows: DataFrame, order: list[str], name: str = "__g") -> DataFrame:
    """``rows`` with their place 0, 1, ... in ``order`` (ascending, nulls first), written to
    shared scratch. Rows equal in ``order`` must be told apart by it."""
    marked = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__m", F.monotonically_increasing_id()))
    marked = stage(marked, "numbered")
    part = F.shiftright("__m", 33)
    sizes = sorted(tuple(r) for r in marked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, shifts = 0, []
    for p, n in sizes:      # one small row a partition
        shifts.append((p, before))
        before += n
    shift = rows.sparkSession.createDataFrame(shifts, "__p long, __shift long")
    inside = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    return (marked.withColumn("__p", part).join(shift, "__p")
            .withColumn(name, F.col("__shift") + inside).drop("__m", "__p", "__shift"))


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _levels(bottom: DataFrame, most: int, level: int, fanout: int) -> list[DataFrame]:
    """Levels above ``bottom`` (first, pos, n, hash): (first, level, pos, n, children, hash)
    each; a tree stops where it has one node."""
    out, cur = [], bottom
    while most > 1:
        level += 1
        kids = F.sort_array(F.collect_list(F.struct("pos", "hash")))
        cur = (cur.filter(F.col("n") > 1)
               .groupBy("first", F.expr(f"pos div {fanout}").alias("above"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("m"))
               .agg(_joined(F.transform(kids, lambda k: k["hash"])).alias("children"))
               .select("first", F.lit(level).alias("level"), F.col("above").alias("pos"), F.col("m").alias("n"),
                       "children", digest(F.col("children")).alias("hash")))
        cur = stage(cur, "level")
        out.append(cur)
        most = -(-most // fanout)
    return out


def _id(level, number) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.shiftleft(level.cast("long"), _LEVEL) + number


def build(rows: DataFrame, key: str = "doc_id", group: str = "lang",
          columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          claimed: Column | None = None, fanout: int = 8) -> Manifest:
    """The manifest of ``rows``. ``claimed`` is the digest that a proof of the row starts
    from (by default its own leaf).

    Any column may be null; groups and keys sort ascending with nulls first, equal keys by
    their leaf; repeated rows are leaves of their own; texts are hashed whole; other
    columns are ignored; an empty table has no root.
    """
    spark = rows.sparkSession
    leaf = digest(*[encoded(c) for c in columns])
    leaves = rows.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("leaf"),
                         (leaf if claimed is None else claimed).alias("claimed"))
    leaves = numbered(_spread(leaves), ["group", "key", "leaf", "claimed", "__copy"]).drop("__copy")
    groups = stage(leaves.groupBy("group").agg(F.min("__g").alias("first"), F.count(F.lit(1)).alias("size")), "groups")
    most, n_groups = groups.agg(F.max("size"), F.count(F.lit(1))).first()
    placed = (leaves.join(groups, leaves["group"].eqNullSafe(groups["group"]))
              .select(leaves["key"], "leaf", "claimed", "first", "size", (F.col("__g") - F.col("first")).alias("place")))
    members = F.sort_array(F.collect_list(F.struct(F.expr(f"place % {fanout}").alias("slot"), "leaf", "claimed", "key")))
    runs = (placed.groupBy("first", "size", F.expr(f"place div {fanout}").alias("pos"))
            .agg(members.alias("members"))
            .withColumn("n", F.expr(f"(size + {fanout - 1}) div {fanout}"))
            .withColumn("children", _joined(F.transform("members", lambda m: m["leaf"])))
            .withColumn("hash", F.when(F.col("size") == 1, F.col("children")).otherwise(digest(F.col("children")))))
    runs = stage(runs, "runs")
    levels = _levels(runs.select("first", "pos", "n", "hash"), -(-(most or 0) // fanout), 1, fanout)

    # a tree's last node is its subroot; subroots in order of their groups' first leaves
    # are the leaves of one more tree
    tops = runs.filter(F.col("n") == 1).select("first", "hash")
    for x in levels:
        tops = tops.unionByName(x.filter(F.col("n") == 1).select("first", "hash"))
    ranked = stage(numbered(tops, ["first"], "rank"), "subroots")
    upper = _levels(ranked.select(F.lit(0).cast("long").alias("first"), F.col("rank").alias("pos"),
                                  F.lit(n_groups).cast("long").alias("n"), "hash"), n_groups, _TOP, fanout)
    last = (upper[-1] if upper else ranked).select("hash").head(1)

    def linked(x: DataFrame, level) -> DataFrame:
        """Adds node, parent and slot: to the next level of the tree, or, from its
        subroot, to the tree of subroots."""
        inner = x.filter(F.col("n") > 1).select(
            "*", _id(level, F.col("first") + F.col("pos")).alias("node"),
            _id(level + 1, F.col("first") + F.expr(f"pos div {fanout}")).alias("parent"),
            F.expr(f"pos % {fanout}").alias("slot"))
        if level > _TOP:
            rest = x.filter(F.col("n") == 1).select(
                "*", _id(level, F.col("first") + F.col("pos")).alias("node"),
                F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("slot"))
        else:
            rest = (x.filter(F.col("n") == 1).join(ranked.select("first", "rank"), "first")
                    .select(*x.columns, _id(level, F.col("first") + F.col("pos")).alias("node"),
                            (_id(_TOP + 1, F.expr(f"rank div {fanout}")) if n_groups > 1
                             else F.lit(None).cast("long")).alias("parent"),
                            F.expr(f"rank % {fanout}").alias("slot")))
        return inner.unionByName(rest)

    nodes = spark.createDataFrame([], "node long, parent long, slot long, children string")
    for x, level in [(x, 2 + i) for i, x in enumerate(levels)] + [(x, _TOP + 1 + i) for i, x in enumerate(upper)]:
        nodes = nodes.unionByName(linked(x, level).select("node", "parent", "slot", "children"))
    runs = linked(runs, 1).select("node", "parent", "slot", "first", "size", "members", "children")
    return Manifest(stage(runs, "linked-runs"), stage(nodes, "nodes"),
                    ranked.select("first", F.col("hash").alias("subroot")), last[0]["hash"] if last else None)


def _around(children: str, slot: str) -> tuple[str, str]:
    """SQL of the digests left and right of a slot."""
    return (f"substring({children}, 1, cast({HEX} * {slot} as int))",
            f"substring({children}, cast({HEX} * ({slot} + 1) + 1 as int))")


_LEFT, _RIGHT = _around("n.children", "c.slot")
_OWN_LEFT, _OWN_RIGHT = _around("children", "m.slot")

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT node AS run, parent, slot, '' AS proof,
    transform(members, m -> if(size = 1, m.claimed, sha2(concat({_OWN_LEFT}, m.claimed, {_OWN_RIGHT}), 256))) AS folded
  FROM {{runs}}
  UNION ALL
  SELECT c.run, n.parent, n.slot, concat(c.proof, {_LEFT}, {_RIGHT}),
    transform(c.folded, f -> sha2(concat({_LEFT}, f, {_RIGHT}), 256))
  FROM climb c JOIN {{nodes}} n ON c.parent = n.node
)
SELECT run, proof, folded FROM climb WHERE parent IS NULL LIMIT ALL
"""


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``key``, ``leaf``, ``subroot``, ``root``, ``proof`` (the digests
    of all siblings from the leaf to the root, left to right, one text) and ``folded``, the
    root that the claimed digest leads to along that proof."""
    runs = manifest.runs
    climbed = stage(runs.sparkSession.sql(CLIMB, runs=runs, nodes=manifest.nodes), "climb")
    whole = (runs.select(F.col("node").alias("run"), "first", "members", "children")
             .join(climbed, "run").join(manifest.groups, "first"))
    own_left, own_right = _around("children", "m.slot")
    return (whole.select("subroot", "proof", "children", F.posexplode("members").alias("i", "m"), "folded")
            .select(F.col("m.key").alias("key"), F.col("m.leaf").alias("leaf"), "subroot",
                    F.lit(manifest.root).alias("root"),
                    F.concat(F.expr(own_left), F.expr(own_right), "proof").alias("proof"),
                    F.expr("folded[i]").alias("folded")))
