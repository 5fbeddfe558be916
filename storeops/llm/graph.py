"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.llm.common import store


def crowded(edges: DataFrame) -> bool:
    """Whether the edges (a, b), a hung on b, are more than stars: some node hangs on two others, or on one and holds another."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("held")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("held")),
    )))
    return bool(ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("held").alias("held")).where("up > 1 or up = 1 and held = 1").head(1))


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of the edges (a, b); the component is its smallest node.

    Each round hangs every node on the smallest neighbour it knows, first for larger and then for smaller neighbours, and
    is written before the next; the rounds grow with the logarithm of the number of nodes.  Edges stay one per node and
    parent, so a node with many neighbours never has them gathered in one row.  The rounds end where only stars are left,
    and a round reads its edges in one pass, as the driver keeps the plans and small tables of all rounds.
    """
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while crowded(now):
        least = now.select(F.inline(F.array(pair("a", "b"), pair("b", "a")))).groupBy("a").agg(F.min("b").alias("m"))
        small = least.select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = now.join(small, "b").select("a", F.col("m").alias("b")).distinct()
        hung = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        both = hung.select(F.inline(F.array(pair("a", "m"), pair("b", "m"))))
        now = store(both.where("a <> b").distinct(), "edges")
    return now.select(F.inline(F.array(pair("a", "b"), pair("b", "b")))).toDF("node", "component").distinct()
