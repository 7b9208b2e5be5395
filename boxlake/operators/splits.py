"""Deterministic splits and numbering for raw sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxlake.runtime import written


def timestamp_block_split(nanoseconds: Column) -> Column:
    """Minutes in turn: of ten, the first goes to val, the second to test, the rest to train."""
    block = F.pmod(F.floor(nanoseconds / 60_000_000_000), F.lit(10))
    return F.when(block == 0, "val").when(block == 1, "test").otherwise("train")


def digest_split(files: DataFrame, content: str, out: str = "split") -> DataFrame:
    """files with a split: groups of equal content, in the order of their digests, take val, test, train x 8 in turn.

    Equal contents share a split. The running number over all digests is made from counts per range of digests, so no
    task sorts them all.
    """
    hashed = files.withColumn("__digest", F.sha2(F.col(content), 256))
    numbered = dense_number(hashed.select("__digest").distinct(), "__digest", "__n")
    turn = F.col("__n") % 10
    return hashed.join(numbered, "__digest").withColumn(out, F.when(turn == 0, "val").when(turn == 1, "test").otherwise("train")).drop("__digest", "__n")


def dense_number(df: DataFrame, key: str, out: str, start: int = 0) -> DataFrame:
    """df with `out`: the rank of each row by a unique key, from `start`, without gaps.

    Range-partitioned and sorted by the key once; rows are numbered within their range in the same pass (the low bits of
    the increasing id), and each range begins where the last ended.
    """
    ranged = df.repartitionByRange(F.col(f"`{key}`")).sortWithinPartitions(F.col(f"`{key}`")).withColumn("__id", F.monotonically_increasing_id())
    ranged = written(ranged.withColumn("__part", F.shiftright("__id", 33)), "ranged")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))  # one row per range
    return ranged.join(offsets, "__part").withColumn(out, F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + start).drop("__part", "__id", "__before")


def batches(df: DataFrame, number: str, size: int) -> DataFrame:
    """df with `batch`: consecutive rows in groups of `size` by their dense number from 0."""
    return df.withColumn("batch", F.floor(F.col(number) / size))
