"""Consolidating pairwise matches into groups (problem 4) by low-diameter decomposition.

Every vertex draws an exponential head start; clusters grow from the vertices whose start comes first, one hop per
round, so a cluster's diameter stays logarithmic. Clusters are contracted to super-vertices and the edges between
clusters are decomposed again, until none is left; the assignments of all levels composed give the group. A level
needs few rounds, whatever the length of the chains, because growth that is cut short only leaves more for the next
level and never joins what is not tied.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.runtime import discard, written

#: Rate of the exponential head starts (its inverse is their mean, in hops) and hops that clusters grow per level.
RATE, HOPS = 0.3, 3
#: Arcs between super-vertices below which one task joins what is left; a level of jobs would cost more than that.
FEW = 2_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _grown(arcs: DataFrame, level: int, rate: float, hops: int) -> DataFrame:
    """(vertex, center) after clusters grew `hops` hops over arcs (u, v, both directions)."""
    draw = (F.xxhash64("u", F.lit(level)).bitwiseAND(F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    labels = arcs.select("u").distinct().select("u", (F.log(draw) / rate).alias("at"), F.col("u").alias("center"))
    # An arc of length 0 to itself keeps a vertex's own label in the running, so each hop reads the labels once.
    steps = arcs.select("u", "v", F.lit(1.0).alias("far")).unionByName(arcs.select("u").distinct().select("u", F.col("u").alias("v"), F.lit(0.0).alias("far")))
    steps = written(steps, "steps")
    for _ in range(hops):
        best = F.min(F.struct((F.col("at") + F.col("far")).alias("at"), "center")).alias("b")
        labels = steps.join(labels, "u").groupBy("v").agg(best).select(F.col("v").alias("u"), "b.at", "b.center")
    out = written(labels.select(F.col("u").alias("vertex"), "center"), "clusters")
    discard(steps)
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vertex, center) of all arcs of one task: the last few super-vertices, joined directly."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            u, v = top(u), top(v)
            above[max(u, v)] = min(u, v)
    held = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array([top(x) for x in held], pa.int64())], ["vertex", "center"])


def decomposed_components(edges: DataFrame, rate: float = RATE, hops: int = HOPS, few: int = FEW) -> DataFrame:
    """(vertex, component) of every vertex of an undirected edge list (a, b) of whole numbers; component is one vertex of it.

    Levels of decomposition run until `few` arcs or fewer are left; those are joined in one task. With few = 0 every
    level is decomposed.

    Edges with a missing end tie nothing; a vertex tied to itself only is a component of its own; repeated edges and
    both orders of an edge count once; an empty list has no vertices.
    """
    edges = edges.filter("a is not null and b is not null").select("a", "b")
    vertices = written(edges.select(F.explode(F.array("a", "b")).alias("vertex")).distinct(), "vertices")
    arcs = written(_both_ways(edges.filter("a <> b")).distinct(), "arcs")
    levels: list[DataFrame] = []
    while n := arcs.count():
        if n <= few:
            levels.append(written(arcs.coalesce(1).mapInArrow(_joined, "vertex bigint, center bigint"), "clusters"))
            break
        clusters = _grown(arcs, len(levels), rate, hops)
        levels.append(clusters)
        left = arcs.join(clusters.withColumnsRenamed({"vertex": "u", "center": "cu"}), "u").join(clusters.withColumnsRenamed({"vertex": "v", "center": "cv"}), "v")
        new = written(left.filter("cu <> cv").select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct(), "arcs")
        discard(arcs)
        arcs = new
    discard(arcs)
    # The last levels hold few super-vertices: compose from there down, so only the first join is of full size.
    composed = None
    for clusters in reversed(levels):
        if composed is None:
            composed = clusters.withColumnRenamed("center", "component")
        else:
            above = composed.withColumnsRenamed({"vertex": "center", "component": "higher"})
            composed = clusters.join(above, "center", "left").select("vertex", F.coalesce("higher", "center").alias("component"))
    if composed is None:
        return vertices.select("vertex", F.col("vertex").alias("component"))
    return vertices.join(composed, "vertex", "left").select("vertex", F.coalesce("component", "vertex").alias("component"))


def consolidated_groups(ties: DataFrame, listed: DataFrame, rate: float = RATE, hops: int = HOPS) -> DataFrame:
    """(ref_id, group_id, n_members): listed ids tied directly or indirectly, in groups of two or more listed ids.

    Ids that are not listed tie others without being returned; group_id is the smallest listed id of the group.
    """
    parts = decomposed_components(ties, rate, hops).withColumnRenamed("vertex", "ref_id")
    parts = written(parts.join(listed.select("ref_id").distinct(), "ref_id", "left_semi"), "listed")
    groups = parts.groupBy("component").agg(F.min("ref_id").alias("group_id"), F.count("*").alias("n_members")).filter("n_members >= 2")
    return parts.join(groups, "component").select("ref_id", "group_id", "n_members")
