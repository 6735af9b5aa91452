"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lanecost.llm.util import stage


def stars(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(u, v) of every node of the undirected ``edges`` but the smallest of its component:
    v is that smallest node.

    Alternates large-star and small-star steps (each a min per node and a join, so a
    hub's edges stay spread over rows, never gathered in a list) until the edges are
    stars around the smallest node, which one count a node tells. Rounds grow with the
    logarithm of the diameter. Every round is written to shared scratch; the first reads
    ``edges`` several times, so they should be a table. Null nodes and loops are
    ignored, repeated edges allowed.
    """
    edges = (edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
             .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))))
    cur = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    def star(e: DataFrame, large: bool) -> DataFrame:
        # least neighbour, the node itself included
        if large:
            e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = e.join(least, "u")
        if large:
            # one row an edge, so repeated ones can wait for the small step
            return j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        return (j.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())

    for _ in range(max_rounds):
        cur = stage(star(star(cur, large=True), large=False), "cc")
        ends = cur.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")),
                                            F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e"))
        ends = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.min("e.out").alias("least"))
        if not ends.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0))).agg(F.count("*")).first()[0]:
            return cur
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of the undirected ``edges``: comp is the smallest
    node of its component. See ``stars``."""
    return with_roots(stars(edges, u, v, max_rounds))


def with_roots(cur: DataFrame) -> DataFrame:
    """(node, comp) of stars, the smallest nodes included."""
    comps = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return comps.unionByName(comps.select(F.col("comp").alias("node"), "comp").distinct())
