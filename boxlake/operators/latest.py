"""The valid version of a record that was scanned or delivered several times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, key: str, when: str) -> DataFrame:
    """One row per key: the one with the greatest `when`; ties go to the greatest remaining values, nulls last.

    An aggregate of structs with partial aggregation before the shuffle, so a key with very many versions costs one
    row per task instead of a sorted window partition. Rows without a key are dropped, as they name no record. Columns
    of map type cannot be ordered and are not supported.
    """
    rest = [c for c in df.columns if c not in (key, when)]
    best = F.max(F.struct(F.col(f"`{when}`"), *[F.col(f"`{c}`") for c in rest])).alias("__best")
    return df.filter(F.col(f"`{key}`").isNotNull()).groupBy(f"`{key}`").agg(best).select(f"`{key}`", "__best.*").select(*[f"`{c}`" for c in df.columns])
