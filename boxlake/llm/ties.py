"""Ties between records: pairwise verdicts, lists of components, shared lineages and shared source images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.functions.clean import squeezed, whole_number

#: Datasets whose recordings show one scene with and without haze.
HAZY_PAIR = ("hazydet", "hazydet_clear")


def verdict_ties(match_pairs: DataFrame) -> DataFrame:
    """(a, b) of rows with both ends whose verdict is 'match' apart from case and surrounding white space."""
    rows = match_pairs.filter((squeezed(F.col("verdict")) == "match") & F.col("left_ref").isNotNull() & F.col("right_ref").isNotNull())
    return rows.select(F.col("left_ref").cast("bigint").alias("a"), F.col("right_ref").cast("bigint").alias("b"))


def shared_key_ties(rows: DataFrame, key: str, node: str) -> DataFrame:
    """(a, b): every node of a key tied to the key's smallest node, one edge per node instead of all pairs.

    The smallest node is a partial aggregate; the join back splits a hot key (adaptive skew join), since what follows
    shuffles anyway.
    """
    least = rows.groupBy(key).agg(F.min(node).alias("b"))
    return rows.join(least, key).select(F.col(node).alias("a"), "b")


def plan_ties(merged_rows: DataFrame) -> DataFrame:
    """(a, b): ids in one component_ids list, and ids of rows with equal lineage_id apart from case and white space.

    Null lists, entries and lineages tie nothing; a single id is tied to itself.
    """
    ids = F.array_sort(F.array_distinct(F.filter("component_ids", lambda x: x.isNotNull())))
    rows = merged_rows.select(F.nullif(squeezed(F.col("lineage_id")), F.lit("")).alias("lineage"), ids.alias("ids")).filter(F.size("ids") > 0)
    lists = rows.select(F.explode("ids").alias("a"), F.col("ids")[0].alias("b"))
    lineages = shared_key_ties(rows.filter("lineage is not null").select("lineage", F.col("ids")[0].alias("node")).distinct(), "lineage", "node")
    return lists.unionByName(lineages)


def source_ties(refs: DataFrame) -> DataFrame:
    """(a, b): records of the hazy datasets with the same source image, a whole number however written."""
    rows = refs.filter(F.col("dataset").isin(*HAZY_PAIR)).select(whole_number(F.col("source_image_id")).alias("source"), F.col("ref_id").alias("node")).filter("source is not null")
    return shared_key_ties(rows, "source", "node")
