"""Object and label rules of canonical rows, as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("native", "meta")


def label(o: Column, mode: str) -> Column:
    """An object's native or meta label."""
    if mode not in MODES:
        raise ValueError(f"unknown label mode {mode!r}; one of {', '.join(MODES)}")
    return o[f"{mode}_label"]


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_valid(o: Column, mode: str, crowd: bool = True) -> Column:
    """Not ignored, labelled in the mode, and no crowd region unless those count."""
    ok = o.isNotNull() & ~_flag(o["ignore"]) & label(o, mode).isNotNull()
    return ok if crowd else ok & ~_flag(o["iscrowd"])


def valid_objects(objects: Column, mode: str, crowd: bool = True) -> Column:
    return F.filter(F.coalesce(objects, F.array()), lambda o: is_valid(o, mode, crowd))


def labels(objects: Column, mode: str, crowd: bool = True) -> Column:
    return F.transform(valid_objects(objects, mode, crowd), lambda o: label(o, mode))


def mapped(name: Column, class_map: dict[str, str | None]) -> Column:
    """The meta label of a native label; null where the map has none or maps it to null. Exact after trimming."""
    known = {k: v for k, v in class_map.items() if v is not None}
    if not known:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())]), F.trim(name))


def named_or_unknown(c: Column) -> Column:
    """Trimmed lower-case text; 'unknown' for null and empty text."""
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown"))


def first_filled(*cs: Column) -> Column:
    """The first value that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def sanitised(c: Column) -> Column:
    """A metric key's part: lower case, anything else than letters, digits, '_', '.' and '-' as one '_'."""
    out = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("unknown"))


def plain_name(text: str) -> str:
    """sanitised() for one name on the driver."""
    import re

    return re.sub(r"[^A-Za-z0-9_.-]+", "_", text.strip().lower()).strip("_") or "unknown"


def number_or_null(c: Column) -> Column:
    """A finite number of text in plain notation, else null ('1d', 'nan' and 'inf' are none)."""
    v = F.when(F.trim(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.trim(c).try_cast("double"))
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def label_colour(name: Column) -> Column:
    """[r, g, b] of a label: 64 plus half of the first three bytes of its md5."""
    digest = F.md5(name.cast("binary"))
    byte = lambda i: F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")
    return F.array(*[(64 + F.floor(byte(i) / 2)).cast("int") for i in range(3)])
