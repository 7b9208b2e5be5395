"""The canonical schema of images and objects, and the fixed lists of the detection domain."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


OBJECT = _struct(bbox=T.ArrayType(T.FloatType()), native_label=_S, native_label_id=_S, meta_label=_S, ignore=_B, iscrowd=_B, meta_json=_S)
CANONICAL = _struct(
    image=_struct(bytes=T.BinaryType(), path=_S), image_id=_S, dataset=_S, split=_S, image_path=_S, width=_I, height=_I, condition=_S, domain=_S, is_synthetic=_B, objects=T.ArrayType(OBJECT), meta_json=_S
)

# The classes of the merged data, the splits in their order and by protection, the sources.
FINAL_CLASSES = ("person", "bicycle", "motorcycle", "car", "bus", "truck")
SPLITS = ("train", "val", "test")
SPLIT_PRIORITY = {"train": 0, "val": 1, "test": 2}
SOURCES = ("acdc", "bdd100k", "carpk", "dawn", "exdark", "hazydet", "hazydet_clear", "hazydet_real", "udacity", "visdrone", "voc2007", "xwod")
HAZY_PAIR = ("hazydet", "hazydet_clear")


class SchemaError(ValueError):
    """Rows that do not have the canonical schema."""


def plain(kind: T.DataType) -> T.DataType:
    """The type with everything nullable, as files do not keep nullability."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType))
    return kind


def require_canonical(df) -> None:
    """Raises SchemaError unless df has exactly the canonical columns and types."""
    if plain(df.schema) != plain(CANONICAL):
        have, want = {f.name: plain(f.dataType) for f in df.schema}, {f.name: plain(f.dataType) for f in CANONICAL}
        wrong = sorted(k for k in have.keys() | want.keys() if have.get(k) != want.get(k)) or ["order of columns"]
        raise SchemaError(f"not the canonical schema: {', '.join(wrong)}")
