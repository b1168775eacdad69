"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import materialise


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """One step over directed pairs (u, v): every u sends its neighbours to the
    smallest of them and itself. Only minima are gathered per node; the join
    back is a plain equi-join, whose hot keys Spark can split."""
    if large:
        pairs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")), name + "-low")
    j = pairs.join(low, pairs["u"] == low["w"])
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` of every node of ``edges (u, v)``: the smallest node
    reachable. Each step is written to the shared folder."""
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name)
    state = None
    while True:
        edges = materialise(_star(edges, True, name), name)
        edges = materialise(_star(edges, False, name), name)
        # Finished when a round changes nothing: every node then hangs directly under its root.
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            break
        state = now
    comp = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return comp.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
