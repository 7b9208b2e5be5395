"""Nested records to related flat tables by Dewey labelling.

Every node (an element of a list, at any depth) gets an ordinal path: the positions of the lists passed on the way
down. Its parent's label is that path truncated, and the path without its positions, the schema path, names the flat
table the node belongs to. Typed columns are labelled by generated expressions inside the JVM; JSON text, whose depth
no schema bounds, is walked in Arrow batches. A node's own fields are those that no node below it holds: its scalars,
its lists of scalars and the fields of plain objects within it, under dotted names.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxlake.runtime import written

#: Fields that hold a list of objects even where they are written as one object or as JSON text.
LIST_FIELDS = ("reviews", "rounds", "changes", "keypoints", "contours", "parts", "subparts", "keyframes", "occluders", "groups", "members", "history", "edits")


#: Lists of lists deeper than this are kept as text, as Spark reads no JSON much deeper than 1,000.
DEEPEST = 100
#: Characters of output after which a batch is closed.
BATCH_CHARS = 1 << 25

_TOKEN = re.compile(r'[ \t\n\r]*(?:([\[\]{},:"])|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\d.a-zA-Z]))|(true|false|null)|(-?(?:nan|inf(?:inity)?))(?![a-zA-Z]))', re.ASCII | re.IGNORECASE)
_NAMED = {"true": True, "false": False, "null": None}


class _Repeated(dict):
    """An object that names a key more than once; items() gives every one of them."""

    def __init__(self, pairs: list[tuple]):
        super().__init__(pairs)
        self.pairs = pairs

    def items(self):
        return self.pairs


def _object(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    return out if len(out) == len(pairs) else _Repeated(pairs)


def _number(text: str):
    """A number of any length; an integer too long for int() stays text."""
    if text.lstrip("-").isdigit():
        return int(text) if len(text) < 1000 else text
    return float(text)


def _parse(text: str):
    """The value of JSON text without recursion, so of any depth; commas before a closing bracket are allowed.

    Raises ValueError if it cannot be read. Far slower than json.loads, so it is for what that refuses.
    """
    stack: list[tuple] = []  # open lists and objects' pairs, with the key that waits for its value
    at, key = 0, None
    while True:
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(at)
        at, sign = m.end(), m[1]
        if sign in ("[", "{"):
            stack.append((sign, [], key))
            if sign == "[":
                continue
            m = _TOKEN.match(text, at)
            if m is None or m[1] not in ("}", '"'):
                raise ValueError(at)
            at = m.end()
            if m[1] == '"':
                key, at = _key(text, at)
                continue
            _, pairs, key = stack.pop()
            value = {}
        elif sign == "]" and stack and stack[-1][0] == "[":
            _, value, key = stack.pop()
        elif sign == '"':
            value, at = scanstring(text, at, True)
        elif sign:
            raise ValueError(at)
        elif m[2]:
            value = _number(m[2])
        elif m[3]:
            if m[3] not in _NAMED:
                raise ValueError(at)
            value = _NAMED[m[3]]
        else:
            value = float(m[4])
        while True:  # value is complete: it goes to what holds it, which may be complete in turn
            if not stack:
                if text[at:].strip(" \t\n\r"):
                    raise ValueError(at)
                return value
            kind, held, outer = stack[-1]
            held.append(value if kind == "[" else (key, value))
            m = _TOKEN.match(text, at)
            sign = m and m[1]
            if not sign or sign not in ",]}":
                raise ValueError(at)
            at = m.end()
            if sign == ",":
                if kind == "[":
                    break
                m = _TOKEN.match(text, at)
                if m is None or m[1] not in ("}", '"'):
                    raise ValueError(at)
                at, sign = m.end(), m[1]
                if sign == '"':
                    key, at = _key(text, at)
                    break
            if (kind == "[") != (sign == "]"):
                raise ValueError(at)
            stack.pop()
            value, key = held if kind == "[" else _object(held), outer


def _key(text: str, at: int) -> tuple[str, int]:
    key, at = scanstring(text, at, True)
    m = _TOKEN.match(text, at)
    if m is None or m[1] != ":":
        raise ValueError(at)
    return key, m.end()


_decode = json.JSONDecoder(object_pairs_hook=_object).decode


def _load(text: str):
    """The value of JSON text, itself perhaps JSON text once more; None if it cannot be read."""
    value = text
    while isinstance(value, str):
        try:
            value = _decode(value)
        except (ValueError, RecursionError):
            try:
                value = _parse(value)
            except ValueError:
                return None
    return value


def _safe(text: str) -> str:
    """text with halves of surrogate pairs, which UTF-8 cannot hold, written as escapes."""
    return text if text.isascii() else text.encode("utf-8", "backslashreplace").decode()


def _list_text(items: list) -> tuple[str, bool, bool, int]:
    """A list as JSON without its objects: (text, whether it holds values, whether it holds objects, depth)."""
    out, stack, values, objects, deepest = ["["], [iter(items)], False, False, 1
    first = True
    while stack:
        for x in stack[-1]:
            if not first:
                out.append(", ")
            first = False
            if isinstance(x, list):
                out.append("[")
                stack.append(iter(x))
                deepest, first = max(deepest, len(stack)), True
                break
            objects = objects or isinstance(x, dict)
            values = values or not (x is None or isinstance(x, dict))
            out.append("null" if isinstance(x, dict) else _scalar(x))
        else:
            stack.pop()
            out.append("]")
            first = False
    return "".join(out), values, objects, deepest


_encode = json.JSONEncoder(ensure_ascii=False).encode


def _scalar(x) -> str:
    """A scalar as JSON that Spark's readers take: numbers they cannot hold become text."""
    if isinstance(x, str):
        return _encode(x)
    if x is None or isinstance(x, bool):
        return "null" if x is None else "true" if x else "false"
    if isinstance(x, float):
        return repr(x) if math.isfinite(x) else '"NaN"' if x != x else '"Infinity"' if x > 0 else '"-Infinity"'
    return str(x) if -(10**38) < x < 10**38 else f'"{x}"'


def own_fields(value, fields: frozenset[str], name: str = "", taken: tuple[str, ...] = ()) -> dict[str, str]:
    """Name -> JSON text of the fields that belong to a value itself: what no node below it holds.

    Fields of plain objects have dotted names. Objects in lists are nodes of their own: of a list that holds some, the
    other elements stay, with null for each object. A name that stands already gets a trailing underscore.
    """
    out: dict[str, str] = {}
    used = set(taken)
    stack = [(name, False, value)]
    while stack:
        name, listed, value = stack.pop()
        if listed and isinstance(value, str):
            read = _load(value)
            value = read if isinstance(read, (dict, list)) else value
        if isinstance(value, dict):
            if not listed:
                stack.extend((f"{name}.{key}" if name else key, key in fields, x) for key, x in reversed(list(value.items())))
            continue
        if isinstance(value, list):
            text, values, objects, depth = _list_text(value)
            if not values and (objects or listed):
                continue
            text = _encode(text) if depth > DEEPEST else text
        else:
            text = _scalar(value)
        while name in used:
            name += "_"
        used.add(name)
        out[name] = text
    return out


def _json_object(fields: dict[str, str]) -> str:
    return _safe("{" + ", ".join(f"{_encode(_safe(k))}: {v}" for k, v in sorted(fields.items())) + "}")


def json_nodes(text: str | None, list_fields: frozenset[str] | None = None) -> list[tuple[str, dict]]:
    """(path, object) of every object that is an element of a list at any depth of JSON text.

    Unreadable text and null have no nodes. Null elements keep their position and give none. A field in list_fields
    that holds one object counts as a list of one, and one that holds JSON text counts as that JSON.
    """
    return _nodes(_load(text), frozenset(LIST_FIELDS) if list_fields is None else list_fields) if text else []


def _nodes(value, fields: frozenset[str]) -> list[tuple[str, dict]]:
    out: list[tuple[str, dict]] = []
    stack = [(value, "")]
    while stack:
        value, path = stack.pop()
        if isinstance(value, list):
            for i, x in enumerate(value):
                if isinstance(x, dict):
                    out.append((f"{path}[{i}]", x))
                if isinstance(x, (dict, list)):
                    stack.append((x, f"{path}[{i}]"))
        elif isinstance(value, dict):
            for key, x in value.items():
                if key in fields:
                    if isinstance(x, str):
                        x = _load(x)
                    if isinstance(x, dict):
                        x = [x]
                if isinstance(x, (dict, list)):
                    stack.append((x, f"{path}.{key}" if path else key))
    return out


def _may_hold_lists(text: Column, fields: tuple[str, ...]) -> Column:
    """False only for JSON text that cannot hold a list of objects, so that it need not be sent to Python."""
    if any(re.search(r'["\\/\x00-\x1f]', f) for f in fields):
        return text.isNotNull()  # such a name may be written in several ways
    return text.rlike("|".join([r"(?s)\[.*[\[{]", *map(re.escape, fields), r"\\u"]))


def _texts(column: pa.Array) -> list[str | None]:
    try:
        return column.to_pylist()
    except UnicodeDecodeError:  # cut within a character
        return [None if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def dewey_json(df: DataFrame, key: str, elements: str, text_field: str, list_name: str, with_values: bool = False, list_fields: tuple[str, ...] = LIST_FIELDS) -> DataFrame:
    """Nodes of an array<struct> column whose elements hold JSON text: its elements and everything below them.

    Returns (key, list_name, pos, child_path[, value]); value is the node's own fields as JSON (see own_fields). Those
    of an element are its other columns and what its text holds outside lists of objects, the latter named
    text_field.name; text that cannot be read stays as text_field. Null elements keep their position without a row; a
    null or empty column has no nodes; rows without a key are kept under a null key. A node is returned once for every
    row of df that holds it.
    """
    base = df.select(F.col(f"`{key}`").alias("__k"), F.posexplode(F.col(f"`{elements}`")).alias("pos", "__e")).filter("__e is not null")
    plain = [f.name for f in df.schema[elements].dataType.elementType.fields if f.name != text_field]
    base = base.select("__k", "pos", F.col("__e")[text_field].alias("__t"), *([F.to_json(F.struct(*[F.col("__e")[n].alias(n) for n in plain])).alias("__v") if plain else F.lit("{}").alias("__v")] if with_values else []))
    key_type = df.schema[key].dataType
    fields = frozenset(list_fields)

    def element(columns: str, text: str | None, read) -> str:
        """The value of an element: its columns, as JSON already, and the own fields of its text, also read."""
        if text is None or text.strip() == "null":
            return columns
        mine = own_fields(text if read is None else read, fields, text_field, tuple(plain))
        return columns if not mine else _json_object(mine) if columns == "{}" else columns[:-1] + "," + _json_object(mine)[1:]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, paths, values, chars = [], [], [], 0

            def close() -> pa.RecordBatch:
                rows = pa.array(at, pa.int64())
                out = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(paths, pa.string())]
                return pa.RecordBatch.from_arrays(out + ([pa.array(values, pa.string())] if with_values else []), ["__k", "pos", "child_path"] + ["value"] * with_values)

            own = _texts(batch.column(3)) if with_values else None
            for i, text in enumerate(_texts(batch.column(2))):
                read = _load(text) if text else None
                if with_values:
                    at.append(i)
                    paths.append("")
                    values.append(element(own[i], text, read))
                    chars += len(values[-1])
                for path, value in _nodes(read, fields):
                    at.append(i)
                    paths.append(_safe(path))
                    chars += len(path)
                    if with_values:
                        values.append(_json_object(own_fields(value, fields)))
                        chars += len(values[-1])
                    if chars > BATCH_CHARS:
                        yield close()
                        at, paths, values, chars = [], [], [], 0
            if at:
                yield close()

    schema = T.StructType([T.StructField("__k", key_type), T.StructField("pos", T.IntegerType()), T.StructField("child_path", T.StringType())] + [T.StructField("value", T.StringType())] * with_values)
    if with_values:
        nodes = base.mapInArrow(walk, schema)
    else:
        below = base.filter(_may_hold_lists(F.col("__t"), list_fields)).mapInArrow(walk, schema)
        nodes = base.selectExpr("__k", "pos", "'' as child_path").unionByName(below)
    return nodes.select(F.col("__k").alias(key), F.lit(list_name).alias("list_name"), "pos", "child_path", *["value"] * with_values)


def _lists_nodes(kind: T.DataType) -> bool:
    """Whether a list of this type holds nodes at any depth of lists."""
    return isinstance(kind, T.ArrayType) and (isinstance(kind.elementType, T.StructType) or _lists_nodes(kind.elementType))


def _typed_value(value: Column, kind: T.StructType) -> Column:
    """A node's own fields as JSON: all but lists of nodes, the fields of plain structs under dotted names."""
    out, used = [], set()

    def add(value: Column, kind: T.StructType, prefix: str) -> None:
        for f in kind.fields:
            name = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                add(value[f.name], f.dataType, name + ".")
            elif not _lists_nodes(f.dataType):
                while name in used:
                    name += "_"
                used.add(name)
                out.append(value[f.name].alias(name))

    add(value, kind, "")
    return F.to_json(F.struct(*out)) if out else F.lit(None).cast("string")


def _typed_nodes(value: Column, kind: T.DataType, path: Column, with_values: bool) -> Column | None:
    """array<struct<p, v>> of the nodes below a value of a known type, or None if the type has none."""
    if isinstance(kind, T.StructType):
        parts = [n for f in kind.fields if (n := _typed_nodes(value[f.name], f.dataType, F.concat(path, F.when(path == "", F.lit(f.name)).otherwise(F.lit("." + f.name))), with_values)) is not None]
        return None if not parts else parts[0] if len(parts) == 1 else F.concat(*parts)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        inner = kind.elementType

        def each(x: Column, i: Column) -> Column:
            here = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            below = _typed_nodes(x, inner, here, with_values)
            if not isinstance(inner, T.StructType):
                return below
            v = _typed_value(x, inner) if with_values else F.lit(None).cast("string")
            own = F.when(x.isNotNull(), F.array(F.struct(here.alias("p"), v.alias("v")))).otherwise(F.array())
            return own if below is None else F.concat(own, below)

        if not isinstance(inner, T.StructType) and _typed_nodes(value, inner, path, with_values) is None:
            return None
        return F.coalesce(F.flatten(F.transform(value, each)), F.array().cast("array<struct<p:string,v:string>>"))
    return None


def dewey_typed(df: DataFrame, key: str, elements: str, list_name: str, with_values: bool = False) -> DataFrame:
    """Nodes of a fully typed array<struct> column, labelled inside the JVM; rows as in dewey_json."""
    kind = df.schema[elements].dataType.elementType
    base = df.select(F.col(f"`{key}`").alias("__k"), F.posexplode(F.col(f"`{elements}`")).alias("pos", "__e")).filter("__e is not null")
    v = _typed_value(F.col("__e"), kind) if with_values else F.lit(None).cast("string")
    nodes = F.array(F.struct(F.lit("").alias("p"), v.alias("v")))
    below = _typed_nodes(F.col("__e"), kind, F.lit(""), with_values)
    if below is not None:
        nodes = F.concat(nodes, below)
    out = base.select("__k", "pos", F.explode(nodes).alias("__n"))
    return out.select(F.col("__k").alias(key), F.lit(list_name).alias("list_name"), "pos", F.col("__n.p").alias("child_path"), *([F.col("__n.v").alias("value")] if with_values else []))


def with_links(nodes: DataFrame) -> DataFrame:
    """Adds to Dewey-labelled nodes: schema_path (names the flat table), ordinals, parent_path and parent's table.

    parent_path is the label truncated behind the last list element above it, '' for the root element, and null for
    a root element itself.
    """
    path = F.col("child_path")
    parent = F.when(path != "", F.regexp_replace(path, r"\.?[^\[\]]*(?:\[\d+\])++$", ""))
    plain = lambda c: F.when(c.isNotNull(), F.concat(F.col("list_name"), F.lit("[]"), F.when(c == "", F.lit("")).otherwise(F.concat(F.lit("."), F.regexp_replace(c, r"\[\d+\]", "[]")))))
    ordinals = F.concat(F.array(F.col("pos")), F.transform(F.regexp_extract_all(path, F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.cast("int")))
    return nodes.withColumn("parent_path", parent).withColumn("schema_path", plain(path)).withColumn("parent_schema_path", plain(F.col("parent_path"))).withColumn("ordinals", ordinals)


_NAME = re.compile(r"(?:`((?:[^`]|``)*)`|(\w+)): ")
_MARK = re.compile(r"`(?:[^`]|``)*`|[<>(),]")


def _variant_fields(kinds: str | None) -> list[tuple[str, str]]:
    """(name, type) of the fields that schema_of_variant_agg names, with any characters in the names."""
    if not kinds or not kinds.startswith("OBJECT<"):
        return []
    text, at, out = kinds[7:-1], 0, []
    while m := _NAME.match(text, at):
        depth, end = 0, len(text)
        for mark in _MARK.finditer(text, m.end()):
            depth += (mark[0] in "<(") - (mark[0] in ">)")
            if mark[0] == "," and not depth:
                end = mark.start()
                break
        out.append((m[2] or m[1].replace("``", "`"), text[m.end() : end]))
        at = end + 2
    return out


def _column_type(kind: str) -> str:
    if kind.startswith("ARRAY<"):
        return f"array<{_column_type(kind[6:-1])}>"
    return "double" if kind.startswith("DECIMAL") else kind.lower() if kind in ("BIGINT", "DOUBLE", "BOOLEAN") else "string"


def flat_tables(nodes: DataFrame) -> dict[str, DataFrame]:
    """One flat table per schema path of with_links() nodes with values: each row names its parent and position.

    The nodes are written once, in one folder per schema path, so a table reads its own rows only. Own fields become
    typed columns (lists of scalars stay lists): one aggregate finds the fields and types of every path (a property of
    the format, so what is collected is bounded by it), a field of several types is text. A field named like a link
    column, or like another but for case, gets a trailing underscore; a path without fields has the links only; values
    that are no JSON objects have no fields.
    """
    links = [c for c in nodes.columns if c != "value"]
    # Folders are named by a hash, as a path may be longer than a file name.
    stored = written(nodes.withColumn("__table", F.md5("schema_path")), "nodes", by=("__table",))
    found = stored.groupBy("schema_path").agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("kinds")).orderBy("schema_path").collect()
    out = {}
    for path, kinds in found:
        mine = stored.filter(F.col("__table") == hashlib.md5(path.encode()).hexdigest())
        fields = [(n, T._parse_datatype_string(_column_type(k))) for n, k in _variant_fields(kinds)]
        if not fields:
            out[path] = mine.select(*links)
            continue
        # By position, as names may differ in case only.
        by_position = T.StructType([T.StructField(f"c{i}", kind) for i, (_, kind) in enumerate(fields)])
        parsed = mine.withColumn("__v", F.from_json("value", T.StructType([T.StructField(n, kind) for n, kind in fields])).cast(by_position))
        used, names = {c.lower() for c in links}, []
        for n, _ in fields:
            n = n or "_"
            while n.lower() in used:
                n += "_"
            used.add(n.lower())
            names.append(n)
        out[path] = parsed.select(*links, *[F.col(f"__v.c{i}").alias(n) for i, n in enumerate(names)])
    return out
