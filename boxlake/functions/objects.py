"""JSON objects in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,variant>"


def json_object(text: Column, strict: bool = True, context: Column | None = None) -> Column:
    """A map of a JSON object in text; null and blank text is an empty one.

    Text that is no JSON object raises (strict), or is an empty one. Of repeated keys the last counts.
    """
    empty = F.create_map().cast(_MAP)
    value = F.try_parse_json(F.when(F.trim(text).startswith("{"), text))
    bad = F.raise_error(F.concat(F.lit("no JSON object in "), F.coalesce(context if context is not None else F.lit("meta_json"), F.lit("?")), F.lit(": "), F.substring(text, 1, 200))).cast(_MAP) if strict else empty
    return F.when(text.isNull() | (F.trim(text) == ""), empty).when(value.isNull(), bad).otherwise(F.try_variant_get(value, "$", _MAP))


def updated(base: Column, over: dict[str, Column] | Column) -> Column:
    """A map of variants with other entries on top: a map, or JSON texts by key."""
    if isinstance(over, dict):
        over = F.map_from_arrays(F.array(*[F.lit(k) for k in over]), F.array(*[F.parse_json(v) for v in over.values()]))
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(over), k)), over)


def object_text(held: Column, separators: tuple[str, str] = (",", ":")) -> Column:
    """JSON text of a map of variants, its keys sorted."""
    quoted = lambda k: F.regexp_extract(F.to_json(F.array(k)), r"(?s)^\[(.*)\]$", 1)
    entries = F.transform(F.array_sort(F.map_keys(held)), lambda k: F.concat(quoted(k), F.lit(separators[1]), F.coalesce(F.to_json(held[k]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(entries, separators[0]), F.lit("}"))
