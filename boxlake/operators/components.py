"""Connected components as a DataFrame operator: alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.runtime import discard, written


def min_label_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of an undirected edge list; component is the smallest node reached.

    Nodes may be of any orderable type. Each round links every neighbour to the smallest one it can see, first among
    larger and then among smaller neighbours, until nothing changes; the rounds are logarithmic in practice. Every step is a
    partial aggregate and an equi-join, so a node with very many edges is never gathered in one task. Edges with a
    missing end tie nothing, a node that only has an edge to itself is its own component, an empty list gives none.
    """
    pairs = edges.select(F.col(f"`{a}`").alias("u"), F.col(f"`{b}`").alias("v")).filter("u is not null and v is not null")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    now = written(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        new = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = new
        if state == seen:
            break
        seen = state
    # Now every edge leads to the smallest node of its component.
    labels = now.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(labels, nodes["node"] == labels["u"], "left").select("node", F.coalesce("component", "node").alias("component"))
