"""Connected components of a distributed edge list by alternating star contractions.

A hub with a third of all edges is never gathered: each contraction is a grouped minimum (partial aggregation) and an
equi-join back, which AQE can split. Each round is written to the shared folder, so lineage stays short; whether it
still changed an edge is observed while it is written, so a round is one query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written, written_observed


def parents(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node, root)`` for every node of an edge but the roots, once each; root is the
    smallest node reachable. Loops and repeated edges do not matter; null ends are ignored."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        both = e.select(F.expr("inline(array(struct(u, v), struct(v as u, u as v)))"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"), F.expr("m <> u").alias("moved"))
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("hi"))
        small = large.join(low, "u").select(F.expr("moved or m <> hi").alias("moved"), F.expr(
            "inline(array(struct(u, m as v), struct(v as u, m as v)))"))
        small = small.where("u <> v").groupBy("u", "v").agg(F.max("moved").alias("moved"))
        e, seen = written_observed(small, F.max("moved").alias("moved"))
        e = e.drop("moved")
        if not seen["moved"]:  # neither contraction changed an edge
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node, root)`` for every node of an edge, as of ``parents``."""
    below = parents(written(edges))
    return below.union(below.select(F.col("root").alias("node"), "root").distinct())
