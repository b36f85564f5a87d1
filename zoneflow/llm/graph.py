"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free digest of the edge set; equal digests mean a fixed point."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge table; ``component`` is the smallest node.

    Each round hooks the larger neighbours of every node to its smallest one (large star), then the
    smaller ones (small star); the number of rounds is logarithmic in the longest path. Minima are
    combined before the shuffle, so a hub costs one row per task; they are stored, so the join back to a hub's
    edges is a plain equi-join of two tables, which adaptive execution splits. Each round is a written table, so no lineage grows
    and a lost executor repeats one round at most. Nothing but a count and a digest reaches the driver.

    Edges with a null end are ignored; a self-loop makes a component of one; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    # a is always the larger end
    current = materialise(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    loops = current.filter("a = b").select(F.col("a").alias("node"))
    real = current.filter("a > b")
    before = _state(real)
    while before[0]:
        both = real.unionAll(real.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # large star: every neighbour above a node joins the node's smallest neighbour
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct())
        # small star: the neighbours below a node, and the node, join the smallest of them
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.select("a", F.col("m").alias("b"))
        )
        real = materialise(small.filter("a > b").distinct())
        after = _state(real)
        if after == before:
            break
        before = after
    found = real.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = real.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    alone = loops.join(found.select("node").unionAll(roots.select("node")), "node", "left_anti")
    return found.unionAll(roots).unionAll(alone.select("node", F.col("node").alias("component")))
