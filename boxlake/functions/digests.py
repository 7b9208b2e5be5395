"""BLAKE2b digests, byte for byte as tables made elsewhere hold them, in Arrow batches; SHA-256 stays inside the JVM."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def blake2b(c: Column, size: int) -> Column:
    """The hex digest of `size` bytes of binary or text; null for null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda v: None if v is None else hashlib.blake2b(v.encode() if isinstance(v, str) else bytes(v), digest_size=size).hexdigest())

    return run(c)


def annotations_blake2b(objects: Column) -> Column:
    """The 16-byte digest of the compact JSON, keys sorted, of boxes, crowd flags and labels in their order."""
    fields = F.transform(objects, lambda o: F.struct(F.transform(o["bbox"], lambda v: v.cast("double")).alias("bbox"), o["iscrowd"].alias("iscrowd"), o["meta_label"].alias("meta_label")))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda held: hashlib.blake2b(json.dumps([{"bbox": [float(v) for v in o["bbox"]], "iscrowd": bool(o["iscrowd"]), "meta_label": o["meta_label"]} for o in held], sort_keys=True, separators=(",", ":")).encode(), digest_size=16).hexdigest())

    return run(fields)
