"""Parsers of raw annotation formats: text in, arrays of raw objects out.

A raw object is a struct<label, label_id, b (box or null), known, ignore, iscrowd, meta_json>; known is false for a
class id that the format's table does not have. What a format skips without counting is left out here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.runtime import written

RAW = f"struct<label:string,label_id:string,b:{G.BOX},known:boolean,ignore:boolean,iscrowd:boolean,meta_json:string>"

# Class, light and place codes of the formats.
VISDRONE_CLASSES = {0: "ignored_region", 1: "pedestrian", 2: "people", 3: "bicycle", 4: "car", 5: "van", 6: "truck", 7: "tricycle", 8: "awning-tricycle", 9: "bus", 10: "motor", 11: "others"}
VISDRONE_IGNORED = (0, 11)
EXDARK_CLASSES = {1: "Bicycle", 2: "Boat", 3: "Bottle", 4: "Bus", 5: "Car", 6: "Cat", 7: "Chair", 8: "Cup", 9: "Dog", 10: "Motorbike", 11: "People", 12: "Table"}
EXDARK_LIGHTING = {1: "low", 2: "ambient", 3: "object", 4: "single", 5: "weak", 6: "strong", 7: "screen", 8: "window", 9: "shadow", 10: "twilight"}
EXDARK_PLACE = {1: "indoor", 2: "outdoor"}
EXDARK_SPLITS = {1: "train", 2: "val", 3: "test"}
DRIVING_EXPORT = r"^(\d+)_jpg\.rf\.(?![0-9a-f]{32}\.jpg$).+\.jpg$"

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^[+-]?\d+$"


def number(c: Column) -> Column:
    """A number in plain notation; null for anything else (Spark would also read '1d')."""
    return F.when(F.trim(c).rlike(_NUMBER), F.trim(c).try_cast("double"))


def integer(c: Column) -> Column:
    return F.when(F.trim(c).rlike(_INTEGER), F.trim(c).try_cast("int"))


def lookup(code: Column, names: dict[int, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), code)


def raw(label: Column, label_id: Column, b: Column, known: Column | None = None, ignore: Column | None = None, iscrowd: Column | None = None, meta: Column | None = None) -> Column:
    false = F.lit(False)
    return F.struct(
        label.alias("label"), label_id.cast("string").alias("label_id"), b.alias("b"), (F.lit(True) if known is None else known).alias("known"), (false if ignore is None else ignore).alias("ignore"),
        (false if iscrowd is None else iscrowd).alias("iscrowd"), (F.lit("{}") if meta is None else meta).alias("meta_json"),
    )


def visdrone_line(line: Column, at: Column) -> Column:
    """A raw object of line `at` (from 1), 'x,y,w,h,score,class,truncation,occlusion'; null for a line that is skipped."""

    def read(part: Column) -> Column:
        field = lambda i: F.get(part, F.lit(i))
        fields = F.struct(*[number(field(i)).alias(c) for i, c in enumerate("xywh")], *[integer(field(i)).alias(c) for i, c in enumerate(("score", "code", "cut", "hidden"), 4)])
        return F.when(F.size(part) == 8, G.let(fields, made))

    def made(f: Column) -> Column:
        name = lookup(f["code"], VISDRONE_CLASSES)
        ok = name.isNotNull()
        for c in ("x", "y", "w", "h", "score", "cut", "hidden"):
            ok = ok & f[c].isNotNull()
        meta = F.to_json(F.struct(f["hidden"].alias("occlusion"), f["score"].alias("score"), at.cast("int").alias("source_line_number"), f["cut"].alias("truncation")))
        return F.when(ok, raw(name, f["code"], G.box(f["x"], f["y"], f["w"], f["h"]), ignore=(f["score"] == 0) | f["code"].isin(*VISDRONE_IGNORED), meta=meta))

    return G.let(F.split(F.trim(line), ","), read)


# A class and then numbers only, in plain notation.
_YOLO = r"^\S+(\s+[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)+$"


def yolo_line(line: Column, width: Column, height: Column, names: dict[int, str], at: Column) -> Column:
    """A raw object of line `at` (from 1): 'class cx cy w h' or 'class x1 y1 … xn yn' in shares of the picture; null if it is skipped.

    The class is tested before the coordinates: an unknown class is counted as such even if they are unreadable. One
    pattern tells whether all coordinates are numbers; those of plain boxes are read without a function per element.
    """

    def read(part: Column) -> Column:
        field, n = lambda i: F.get(part, F.lit(i)), F.size(part) - 1
        value = lambda i: field(i).try_cast("double")
        code = integer(field(0))
        name = lookup(code, names)
        meta = lambda shape: F.to_json(F.struct(at.cast("int").alias("source_line_number"), F.lit(shape).alias("source_shape")))
        plain = raw(name, code, G.from_normalised_centre(value(1), value(2), value(3), value(4), width, height), meta=meta("bbox"))

        def corners(v: Column) -> Column:
            xs, ys = F.filter(v, lambda x, i: i % 2 == 0), F.filter(v, lambda x, i: i % 2 == 1)
            return G.let(F.struct(xs.alias("x"), ys.alias("y")), lambda s: G.from_corners(F.array_min(s["x"]) * width, F.array_min(s["y"]) * height, F.array_max(s["x"]) * width, F.array_max(s["y"]) * height))

        shape = raw(name, code, G.let(F.transform(F.slice(part, F.lit(2), n), lambda x: x.try_cast("double")), corners), meta=meta("polygon"))
        known = F.when(F.trim(line).rlike(_YOLO), F.when(n == 4, plain).when((n > 4) & (n % 2 == 0), shape))
        return F.when((field(0) == "") | code.isNull(), F.lit(None)).when(name.isNull(), raw(code.cast("string"), code, F.lit(None).cast(G.BOX), known=F.lit(False))).otherwise(known)

    return G.let(F.split(F.trim(line), r"\s+"), read)


def exdark_line(line: Column, at: Column) -> Column:
    """A raw object of line `at` (from 1), 'label x y w h …'; null for comments and short or unreadable lines.

    The label is tested before the numbers: an unknown one is counted as such even if they are unreadable.
    """

    def read(part: Column) -> Column:
        fields = F.struct(F.get(part, F.lit(0)).alias("label"), *[number(F.get(part, F.lit(i))).alias(c) for i, c in enumerate("xywh", 1)])
        return F.when((F.size(part) >= 5) & ~F.get(part, F.lit(0)).startswith("%"), G.let(fields, made))

    def made(f: Column) -> Column:
        code = F.lit(None).cast("int")
        for k, name in EXDARK_CLASSES.items():
            code = F.when(f["label"] == name, F.lit(k)).otherwise(code)
        ok = f["x"].isNotNull() & f["y"].isNotNull() & f["w"].isNotNull() & f["h"].isNotNull()
        unknown = raw(f["label"], code, F.lit(None).cast(G.BOX), known=F.lit(False))
        meta = F.to_json(F.struct(at.cast("int").alias("source_line_number")))
        return F.when(code.isNull(), unknown).when(ok, raw(f["label"], code, G.box(f["x"], f["y"], f["w"], f["h"]), meta=meta))

    return G.let(F.split(F.trim(line), r"\s+"), read)


def exdark_list_line(line: Column) -> Column:
    """struct<name, class, lighting, place, split> of 'name class light place split'; null for the header and blank lines."""
    part = F.split(F.trim(line), r"\s+")
    at = lambda i: F.get(part, F.lit(i))
    code = lambda i, names: lookup(integer(at(i)), names)
    row = F.struct(at(0).alias("name"), code(1, EXDARK_CLASSES).alias("class"), code(2, EXDARK_LIGHTING).alias("lighting"), code(3, EXDARK_PLACE).alias("place"), code(4, EXDARK_SPLITS).alias("split"))
    bad = (F.size(part) != 5) | row["class"].isNull() | row["lighting"].isNull() | row["place"].isNull() | row["split"].isNull()
    fail = F.raise_error(F.concat(F.lit("image list: "), line)).cast("struct<name:string,class:string,lighting:string,place:string,split:string>")
    return F.when((F.trim(line) == "") | F.lower(F.trim(line)).startswith("name"), F.lit(None)).when(bad, fail).otherwise(row)


# The fields of the lists of a COCO document.
COCO = {
    "images": "struct<id:string,file_name:string,width:int,height:int>",
    "annotations": "struct<id:string,image_id:string,category_id:string,bbox:array<double>,area:double,iscrowd:string,ignore:string>",
    "categories": "struct<id:string,name:string>",
}


def _truthy(c: Column) -> Column:
    return F.coalesce(F.lower(c).isin("1", "true"), F.lit(False))


def document_elements(docs: DataFrame, column: str = "value") -> DataFrame:
    """(list, pos, value) of JSON documents that are one value each, as stream_json() gives them for files of any size."""
    lists = F.array(*[F.struct(F.lit(k).alias("list"), F.from_json(F.col("d")[k], "array<string>").alias("v")) for k in COCO])
    parsed = docs.select(F.from_json(column, "struct<" + ",".join(f"{k}:string" for k in COCO) + ">").alias("d"))
    return parsed.select(F.explode(lists).alias("l")).select("l.list", F.posexplode("l.v").alias("pos", "value"))


def coco_tables(elements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories) of COCO elements (list, pos, value), keyed by string ids; positions keep the file's order."""
    e = written(elements.filter(F.col("list").isin(*COCO)), "coco", by=("list",))  # read once for the three tables
    one = lambda k: e.filter(F.col("list") == k).select("pos", F.from_json("value", COCO[k]).alias("v")).select("pos", "v.*")
    notes = one("annotations").withColumn("iscrowd", _truthy(F.col("iscrowd"))).withColumn("ignore", _truthy(F.col("ignore")))
    # The last of several categories with one id counts.
    cats = one("categories").groupBy("id").agg(F.max_by(F.trim("name"), "pos").alias("name"))
    return one("images"), notes, cats


def coco_objects(notes: DataFrame, categories: DataFrame) -> DataFrame:
    """(image_id, raw): objects in annotation order; an unknown category raises."""
    j = notes.join(categories.withColumnRenamed("id", "category_id"), "category_id", "left")
    name = F.coalesce("name", F.raise_error(F.concat(F.lit("unknown category_id "), F.col("category_id"))).cast("string"))
    meta = F.to_json(F.struct(F.col("id").alias("source_annotation_id"), F.col("area").alias("source_area")), {"ignoreNullFields": "false"})
    o = raw(name, F.col("category_id"), G.from_array(F.col("bbox")), ignore=F.col("ignore"), iscrowd=F.col("iscrowd"), meta=meta)
    return j.groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", o.alias("o")))), lambda x: x["o"]).alias("raw"))


def path_part(name: Column, index: int) -> Column:
    """Part `index` of a path (negative from its end); a path without it raises."""
    parts = F.filter(F.split(name, "/"), lambda p: p != "")
    part = F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))
    return F.coalesce(part, F.raise_error(F.concat(F.lit(f"no path part {index} in "), name)).cast("string"))


SCALABEL = (
    "struct<name:string,timestamp:bigint,attributes:struct<weather:string,scene:string,timeofday:string>,"
    "labels:array<struct<id:string,category:string,manualShape:boolean,manualAttributes:boolean,attributes:string,box2d:struct<x1:double,y1:double,x2:double,y2:double>>>>"
)


def scalabel_frames(elements: DataFrame) -> DataFrame:
    """(pos, source_id, raw, condition, meta_json) of Scalabel frames (list, pos, value); labels without a box are left out.

    The document must be a list of frames; elements of a named list raise.
    """
    whole = F.when(F.col("list") == "", F.col("value")).otherwise(F.raise_error(F.lit("a Scalabel document is a list")).cast("string"))
    f = elements.select("pos", F.from_json(whole, SCALABEL).alias("f"))
    name = F.nullif(F.trim("f.name"), F.lit(""))
    category = lambda x: F.coalesce(F.nullif(F.trim(x["category"]), F.lit("")), F.raise_error(F.lit("a box has no category")).cast("string"))

    def one(x: Column) -> Column:
        meta = F.to_json(F.struct(F.coalesce(x["attributes"], F.lit("{}")).alias("attributes"), x["manualAttributes"].alias("manual_attributes"), x["manualShape"].alias("manual_shape")), {"ignoreNullFields": "false"})
        return raw(category(x), x["id"], G.from_corners(x["box2d"]["x1"], x["box2d"]["y1"], x["box2d"]["x2"], x["box2d"]["y2"]), meta=meta)

    objects = F.transform(F.filter(F.coalesce("f.labels", F.array()), lambda x: x["box2d"].isNotNull()), one)
    meta = F.to_json(F.struct(F.col("f.attributes.scene").alias("scene"), F.lit("bdd100k_scalabel").alias("source_annotation_format"), name.alias("source_file_name"), F.col("f.attributes.timeofday").alias("timeofday"), F.col("f.timestamp").alias("timestamp")), {"ignoreNullFields": "false"})
    return f.select("pos", F.coalesce(name, F.raise_error(F.lit("a frame has no name")).cast("string")).alias("source_id"), objects.alias("raw"), F.nullif("f.attributes.weather", F.lit("")).alias("condition"), meta.alias("meta_json"))


VOC = "filename string, size struct<width:int,height:int>, object array<struct<name:string,difficult:string,truncated:string,pose:string,bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>>>"


def voc_objects(text: Column) -> Column:
    """struct<filename, raw> of VOC XML: inclusive 1-based corners, 'difficult' objects are ignored; missing parts raise."""
    x = F.from_xml(text, VOC, {"rowTag": "annotation"})
    need = lambda v, what: F.coalesce(F.nullif(F.trim(v), F.lit("")), F.raise_error(F.lit(f"VOC object without {what}")).cast("string"))

    def one(o: Column) -> Column:
        x1, y1, x2, y2 = (need(o["bndbox"][k], k).cast("double") for k in ("xmin", "ymin", "xmax", "ymax"))
        meta = F.to_json(F.struct(o["pose"].alias("pose"), (F.coalesce(F.trim(o["truncated"]), F.lit("0")) != "0").alias("truncated")))
        return raw(need(o["name"], "name"), F.lit(None), G.box(x1 - 1, y1 - 1, x2 - x1 + 1, y2 - y1 + 1), ignore=F.coalesce(F.trim(o["difficult"]), F.lit("0")) != "0", meta=meta)

    return F.struct(x["filename"].alias("filename"), F.transform(F.coalesce(x["object"], F.array()), one).alias("raw"))
