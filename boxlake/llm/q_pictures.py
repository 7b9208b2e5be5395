"""Queries of problem 1: records of val and test that also stand in train."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm.pictures import cross_split_overlaps, overlap_counts
from boxlake.runtime import table


def _overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return cross_split_overlaps(table(spark, folder, "row_refs"), table(spark, folder, "image_rows"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _overlaps(spark, folder)
    return pairs.select(F.least("eval_ref", "train_ref").alias("ref_id_a"), F.greatest("eval_ref", "train_ref").alias("ref_id_b")).distinct()


def report(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping records and pairs per split and dataset of the evaluation record."""
    counts = overlap_counts(table(spark, folder, "row_refs"), table(spark, folder, "image_rows"))
    return counts.groupBy("split", "dataset").agg(F.count("*").alias("n_records"), F.sum("n_train").alias("n_pairs"), F.round(F.avg("coverage"), 6).alias("mean_coverage"))


QUERIES = {"p1_found": found, "p1_report": report}
