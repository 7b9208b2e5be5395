"""Queries of problem 6: texts placed in training windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm.packing import fill, packed, plan_and_place, token_counts
from boxlake.runtime import table


def containers(spark: SparkSession, folder: str) -> DataFrame:
    """A container and position for every text."""
    return packed(token_counts(table(spark, folder, "documents")), "doc_id", "n_tokens")


def report(spark: SparkSession, folder: str) -> DataFrame:
    """How well the containers are filled, beside the least number that the LP proves."""
    return fill(*plan_and_place(token_counts(table(spark, folder, "documents")), "doc_id", "n_tokens"))


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and tokens by the power of two that bounds their length."""
    counts = token_counts(table(spark, folder, "documents"))
    bound = F.when(F.col("n_tokens") > 0, F.ceil(F.log2("n_tokens")).cast("int")).otherwise(-1)
    return counts.groupBy(bound.alias("log2_bound")).agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"))


QUERIES = {"p6_containers": containers, "p6_fill": report, "p6_lengths": lengths}
