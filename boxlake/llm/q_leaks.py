"""Queries of problem 7: evaluation texts leaking into training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm.leaks import RUN, leaks
from boxlake.runtime import table

#: Alignment from which an edited or paraphrased copy counts as leaked.
COPIED = 0.5


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).filter(F.col("run") >= RUN).select("doc_id", "item_id")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the items it holds: word for word, or edited."""
    kind = F.when(F.col("run") >= RUN, "exact").otherwise("edited")
    return _leaks(spark, folder).filter((F.col("run") >= RUN) | (F.col("score") >= COPIED)).withColumn("score", F.round("score", 6)).withColumn("kind", kind)


def items(spark: SparkSession, folder: str) -> DataFrame:
    """The items that leaked, in how many documents and how completely."""
    hits = scored(spark, folder).groupBy("item_id").agg(F.count("*").alias("n_documents"), F.sum(F.when(F.col("kind") == "exact", 1).otherwise(0)).alias("n_exact"), F.max("score").alias("best_score"))
    return table(spark, folder, "eval_items").select("item_id", "task", "split").join(hits, "item_id")


QUERIES = {"p7_found": found, "p7_scored": scored, "p7_items": items}
