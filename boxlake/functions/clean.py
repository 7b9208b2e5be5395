"""Cleaning rules for identity columns, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a missing value.
STAND_INS = ("", "n/a", "na", "none", "null", "nan", "unknown", "-", "?")

# The spellings of the three splits.
SPLIT_SPELLINGS = {
    "train": "train", "training": "train", "tr": "train",
    "val": "val", "valid": "val", "validation": "val", "dev": "val",
    "test": "test", "testing": "test",
}


def squeezed(c: Column) -> Column:
    """Lower case without surrounding white space of any kind."""
    return F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))


def split_name(c: Column) -> Column:
    """train, val or test however it is written; null for anything else."""
    key = squeezed(c)
    out = F.lit(None).cast("string")
    for name in ("train", "val", "test"):
        out = F.when(key.isin([k for k, v in SPLIT_SPELLINGS.items() if v == name]), F.lit(name)).otherwise(out)
    return out


def hash_text(c: Column) -> Column:
    """The 64 hex digits of a content hash apart from case, white space and a prefix; null where there are none."""
    found = F.regexp_extract(F.lower(c), r"(?:^|[^0-9a-f])([0-9a-f]{64})(?:$|[^0-9a-f])", 1)
    return F.nullif(found, F.lit(""))


def whole_number(c: Column) -> Column:
    """A whole number however written (leading zeros, white space, '77.0'), as decimal text; null otherwise.

    Negative numbers are stand-ins for a missing value and give null. Digits of any length are kept as text, so no
    number overflows.
    """
    digits = F.regexp_extract(squeezed(c), r"^\+?0*(\d+?)(?:\.0*)?$", 1)
    return F.nullif(digits, F.lit(""))


def image_number(c: Column) -> Column:
    """A source image's id: its whole number however written, else its text without stand-ins for missing values."""
    text = squeezed(c)
    return F.coalesce(whole_number(c), F.when(~text.isin(*STAND_INS) & ~text.rlike(r"^-\d+$"), F.trim(c)))
