"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)``, both long -> ``(node, root)``: for each node of an edge but the
    smallest of its component, that smallest node.

    Every round hooks each node's larger neighbours to its smallest one (large
    star), then its smaller neighbours (small star); the edges of a component
    shrink to a star in O(log^2 n) rounds.  Minima are aggregated before they
    meet the edges, so a hub's neighbours never stand together in one task.
    Nulls and self-loops are dropped; no edges give no rows."""
    e = cut(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        state = e.agg(
            F.count("*").alias("n"),
            F.expr("bit_xor(xxhash64(u, v))").alias("h"),
            F.expr("sum(cast(v as decimal(38, 0)))").alias("s"),
        ).first()
        if state["n"] == 0 or seen == tuple(state):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
        )
        e = cut(small.where(F.col("u") != F.col("v")).distinct())
