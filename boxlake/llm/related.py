"""Splits that keep related records together (problem 5).

Components by hash-to-min: every node holds a cluster, sends it to the cluster's smallest node and that node to every
member, until nothing changes. Clusters are kept as rows (node, member), never as a list in one task. A component then
takes a split by weighted rendezvous hashing, which needs no counts, gives every component the same split in every run
and moves the fewest components when the proportions change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.runtime import discard, written

#: Proportions of the splits.
PROPORTIONS = {"train": 0.8, "val": 0.1, "test": 0.1}


def hash_to_min(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an undirected edge list (a, b); component is the smallest node.

    Edges with a missing end relate nothing; a node related to itself only is its own component; an empty list has no nodes.
    """
    edges = edges.filter("a is not null and b is not null")
    now = edges.select(F.explode(F.expr("array(struct(a as n, b as m), struct(b as n, a as m), struct(a as n, a as m), struct(b as n, b as m))")).alias("e")).select("e.n", "e.m").distinct()
    now, seen = written(now, "clusters"), None
    while True:
        least = now.groupBy("n").agg(F.min("m").alias("least"))
        sent = now.join(least, "n").select(F.explode(F.array(F.struct(F.col("least").alias("n"), F.col("m")), F.struct(F.col("m").alias("n"), F.col("least").alias("m")))).alias("e"))
        new = written(sent.select("e.n", "e.m").distinct(), "clusters")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("n", "m").cast("decimal(38,0)"))).first()
        discard(now)
        now = new
        if state == seen:
            break
        seen = state
    return now.groupBy("n").agg(F.min("m").alias("component")).withColumnRenamed("n", "node")


def rendezvous(key: Column, proportions: dict[str, float | Column] = PROPORTIONS, seed: int = 0) -> Column:
    """The split of a key: the one with the greatest -weight / ln(draw), a draw being a hash of key, split and seed.

    Weights may be columns; a split of weight 0 or less is never taken while another has more. Ties go to the last name.
    """
    digits = lambda name: F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(name), F.lit(str(seed)))), 1, 13), 16, 10).cast("double")
    draw = lambda name: (digits(name) + 0.5) / F.lit(float(1 << 52))
    weight = lambda w: w if isinstance(w, Column) else F.lit(float(w))
    scores = [F.struct((F.greatest(weight(w), F.lit(0.0)) / -F.log(draw(name))).alias("score"), F.lit(name).alias("split")) for name, w in proportions.items()]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["split"]


def related_groups(refs: DataFrame, ties: DataFrame) -> DataFrame:
    """refs with group_id: the smallest listed ref_id of all records related to it, or its own id.

    refs: one row per ref_id. Ids that are not in refs relate others without being returned.
    """
    parts = hash_to_min(ties).withColumnRenamed("node", "ref_id")
    placed = written(refs.join(parts, "ref_id", "left").withColumn("component", F.coalesce("component", "ref_id")), "placed")
    groups = placed.groupBy("component").agg(F.min("ref_id").alias("group_id"))
    return placed.join(groups, "component").drop("component")


def grouped_splits(refs: DataFrame, ties: DataFrame, proportions: dict[str, float] = PROPORTIONS, seed: int = 0) -> DataFrame:
    """related_groups() with new_split, which is the same for all records of a group; shares are those of records.

    A group larger than the smallest split's share of all records goes to the largest split, and the draw of the others
    takes into account what these giants fill already: one of them can neither fill nor empty a small split.
    """
    placed = written(related_groups(refs, ties), "related")
    sizes = placed.groupBy("group_id").agg(F.count("*").alias("n"))
    largest, total = max(proportions, key=lambda k: proportions[k]), sum(proportions.values())
    shares = {k: w / total for k, w in proportions.items() if w > 0}
    giant = lambda n, all_: n > all_ * min(shares.values())
    sizes = sizes.crossJoin(sizes.agg(F.sum("n").alias("all")))  # one row
    sizes = written(sizes.withColumn("giant", giant(F.col("n"), F.col("all"))), "sizes")
    sizes = sizes.crossJoin(sizes.agg(F.coalesce(F.sum(F.when(F.col("giant"), F.col("n"))), F.lit(0)).alias("filled")))  # one row
    weights = {k: F.col("all") * w - (F.col("filled") if k == largest else 0) for k, w in shares.items()}
    split = F.when(F.col("giant"), F.lit(largest)).otherwise(rendezvous(F.col("group_id"), weights, seed))
    return placed.join(sizes.select("group_id", split.alias("new_split")), "group_id").select(*placed.columns, "new_split")


def divided_groups(refs: DataFrame, ties: DataFrame) -> DataFrame:
    """(ref_id, group_id, split) of all records of groups that refs.split divides today; unknown splits don't divide."""
    related = written(related_groups(refs.select("ref_id", "split"), ties), "related")
    divided = related.groupBy("group_id").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).filter("lo <> hi").select("group_id")
    return related.join(divided, "group_id", "left_semi").select("ref_id", "group_id", "split")
