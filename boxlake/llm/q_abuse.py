"""Queries of problem 8: abusive, hateful or sexual content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.clean import squeezed
from boxlake.llm.abuse import THRESHOLD, abuse_scores
from boxlake.runtime import table


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return abuse_scores(table(spark, folder, "documents"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    return scores(spark, folder).filter(F.col("abuse_score") >= THRESHOLD).select("doc_id").distinct()


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the share of abusive ones per source, however the source is spelled."""
    scored = abuse_scores(table(spark, folder, "documents"), keep=("source",))
    source = F.coalesce(F.nullif(F.regexp_replace(squeezed(F.col("source")), r"[\s_-]+", "-"), F.lit("")), F.lit("unknown"))
    abusive = F.sum(F.when(F.col("abuse_score") >= THRESHOLD, 1).otherwise(0))
    return scored.groupBy(source.alias("source")).agg(F.count("*").alias("n_documents"), abusive.alias("n_abusive")).withColumn("rate", F.round(F.col("n_abusive") / F.col("n_documents"), 6))


def agreement(spark: SparkSession, folder: str) -> DataFrame:
    """How the score agrees with the reviewers' majority (ties and null labels left out)."""
    labels = table(spark, folder, "review_labels").filter("abusive in (0, 1)").groupBy("doc_id").agg(F.sum(F.col("abusive") * 2 - 1).alias("v")).filter("v <> 0")
    both = scores(spark, folder).join(labels, "doc_id")
    return both.groupBy((F.col("v") > 0).alias("labelled"), (F.col("abuse_score") >= THRESHOLD).alias("scored")).agg(F.count("*").alias("n"))


QUERIES = {"p8_found": found, "p8_scores": scores, "p8_rates": rates, "p8_agreement": agreement}
