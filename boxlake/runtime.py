"""Session helpers: the shared work folder, written intermediate tables, table loading."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local folder
    would lose data with its executor, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="boxlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession) -> str:
    """Where this application's tables lie, below the shared folder."""
    return f"{work_folder(spark)}/boxlake/{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as a Parquet table in the shared folder, in folders by the columns `by`, and return a scan of it.

    This cuts lineage as checkpoint() does, keeps columnar pruning and statistics, and survives lost executors.
    """
    path = f"{own_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._boxlake_path = path
    return out


def cleanup(spark: SparkSession) -> None:
    """Delete all tables this application wrote; results that still read them must have been stored before."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        return  # nothing was written
    p = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame | None) -> None:
    """Delete a table made by written(), once nothing reads it any more."""
    path = getattr(df, "_boxlake_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the project's Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df on at least as many tasks as the session has cores, for costly work on a small table.

    A file of one row group is one task, however many cores are free; a table that is already read by enough tasks is
    left as it is, so large ones are never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
