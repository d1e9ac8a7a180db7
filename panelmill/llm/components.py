"""Connected components of a graph that is only ever a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; component is its least node.

    Alternates two steps until the edges no longer change: every node hands its larger neighbours
    to its least one, then its smaller neighbours.  The number of edges never grows, the graph
    becomes one star per component in a logarithmic number of rounds, and each round is written
    to shared storage, so that a lost executor costs one round.  Nodes with many neighbours meet
    one row per node in the joins, which AQE can split.

    Loops and repeated edges are allowed; edges with a null end are ignored; no edges, no rows.
    """
    spark = edges.sparkSession
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ok = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    now = stage(edges.where(ok).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # Large step: both directions, larger neighbours and the node itself go to the least one.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small step: smaller neighbours and the node itself go to the least one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stage(small.where("u != v").distinct(), "small")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
