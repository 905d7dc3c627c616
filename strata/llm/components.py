"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b), a > b.

    Large: every node hands its smallest neighbour (or itself) to its larger
    neighbours. Small: it hands it to its smaller neighbours and itself. The
    minimum is combined before the shuffle, so a node with very many edges is
    not gathered anywhere; the join back is an ordinary equi-join that adaptive
    execution splits.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    told = both.join(low, "a")
    if large:
        out = told.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = told.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long), the component
    being its smallest node. Each round is written to shared storage; only its
    row count and checksum reach the driver."""
    cur = materialise(
        edges.filter("u != v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        cur = materialise(_star(_star(cur, True), False), "cc")
        now = tuple(cur.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    inner = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.unionByName(inner.select(F.col("component").alias("node"), "component").distinct())
