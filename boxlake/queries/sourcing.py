"""Queries of the source parsers, over lines and documents rendered from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions.clean import split_name
from boxlake.functions.headers import size_of
from boxlake.queries.boxes import BRIDGE, bridge
from boxlake.queries.registry import registry
from boxlake.runtime import own_folder, table
from boxlake.schema import CANONICAL
from boxlake.sources import formats as X
from boxlake.sources.config import SourceConfig
from boxlake.sources.ingest import ingest, judge, statistics
from boxlake.sources.readers import driving_export, load_canonical, with_fallback_bytes

QUERIES, ORACLES, query = registry()

NAMES = {0: "AF", 1: "NF", 2: "NO"}
_ID = "case lab when 'AF' then 0 when 'NF' then 1 when 'NO' then 2 else 9 end"


def _code(lab):
    return F.when(lab == "AF", 0).when(lab == "NF", 1).when(lab == "NO", 2).otherwise(9)


KEYS = ("k", "ln", "pk", "sk")


def _rows(df, *keys):
    """Raw objects as rows: the keys and every field; boxes rounded to 6 places."""
    r = df.filter("r is not null")
    return r.select(*keys, "r.label", "r.label_id", "r.known", "r.ignore", "r.iscrowd", *[F.round(f"r.b.{c}", 6).alias(c) for c in "xywh"], "r.meta_json")


_BOX = "round(x,6) x, round(y,6) y, round(w,6) w, round(h,6) h"


@query("src6_visdrone", f"""with {BRIDGE}, l as (select *, ln % 2 score, pk % 13 code from o where ln % 7 <> 0)
select k, ln, pk, sk, case code when 0 then 'ignored_region' when 1 then 'pedestrian' when 2 then 'people' when 3 then 'bicycle' when 4 then 'car' when 5 then 'van' when 6 then 'truck' when 7 then 'tricycle' when 8 then 'awning-tricycle' when 9 then 'bus' when 10 then 'motor' else 'others' end as "label",
 code::varchar label_id, true known, score = 0 or code in (0, 11) "ignore", false iscrowd, {_BOX}, '{{"occlusion":0,"score":'||score||',"source_line_number":'||ln||',"truncation":1}}' meta_json from l where code <= 11""")
def visdrone(spark, folder):
    """SRC-6: VisDrone lines; a seventh of them has a field too few, class 12 is unknown."""
    b = bridge(spark, folder)
    cut = F.when(F.col("ln") % 7 == 0, F.lit("")).otherwise(F.lit(",0"))
    line = F.concat(F.concat_ws(",", "b.x", "b.y", "b.w", "b.h", F.col("ln") % 2, F.col("pk") % 13, F.lit("1")), cut)
    return _rows(b.select(*KEYS, X.visdrone_line(line, F.col("ln")).alias("r")), *KEYS)


@query("src8_yolo", f"""with {BRIDGE}, l as (select o.*, {_ID} code from i join o using (k))
select k, ln, pk, sk, case when code = 9 then '9' else lab end "label", code::varchar label_id, code <> 9 known, false "ignore", false iscrowd, round(case when code <> 9 then x end,6) x, round(case when code <> 9 then y end,6) y, round(case when code <> 9 then w end,6) w, round(case when code <> 9 then h end,6) h,
 case when code = 9 then '{{}}' else '{{"source_line_number":'||ln||',"source_shape":"'||case when w >= 0 and h >= 0 and ln % 2 = 0 then 'polygon' else 'bbox' end||'"}}' end meta_json
from l where code = 9 or ln % 5 <> 0""")
def yolo(spark, folder):
    """SRC-7 to SRC-9: YOLO boxes and polygons; a fifth of the lines has an unreadable coordinate."""
    b = bridge(spark, folder)
    n = lambda v, side: (v / F.col(side)).cast("string")
    x, y, w, h = (F.col(f"b.{c}") for c in "xywh")
    plain = F.concat_ws(" ", n(x + w / 2, "iw"), n(y + h / 2, "ih"), n(w, "iw"), n(h, "ih"))
    shape = F.concat_ws(" ", n(x, "iw"), n(y, "ih"), n(x + w, "iw"), n(y, "ih"), n(x + w, "iw"), n(y + h, "ih"))
    turned = F.when((w < 0) | (h < 0), plain).otherwise(F.when(F.col("ln") % 2 == 0, shape).otherwise(plain))
    body = F.when(F.col("ln") % 5 == 0, F.concat(plain, F.lit("x"))).otherwise(turned)
    line = F.concat_ws(" ", _code(F.col("lab")), body)
    return _rows(b.select(*KEYS, X.yolo_line(line, F.col("iw"), F.col("ih"), NAMES, F.col("ln")).alias("r")), *KEYS)


@query("src10_exdark", f"""with {BRIDGE}, l as (select *, pk % 14 code from o where ln % 6 <> 0)
select k, ln, pk, sk, case code when 1 then 'Bicycle' when 2 then 'Boat' when 3 then 'Bottle' when 4 then 'Bus' when 5 then 'Car' when 6 then 'Cat' when 7 then 'Chair' when 8 then 'Cup' when 9 then 'Dog' when 10 then 'Motorbike' when 11 then 'People' when 12 then 'Table' else 'Lamp' end "label",
 case when code between 1 and 12 then code::varchar end label_id, code between 1 and 12 known, false "ignore", false iscrowd, case when code between 1 and 12 then round(x,6) end x, case when code between 1 and 12 then round(y,6) end y, case when code between 1 and 12 then round(w,6) end w, case when code between 1 and 12 then round(h,6) end h,
 case when code between 1 and 12 then '{{"source_line_number":'||ln||'}}' else '{{}}' end meta_json from l""")
def exdark(spark, folder):
    """SRC-10: ExDark lines; a sixth of them is a comment."""
    b = bridge(spark, folder)
    name = F.coalesce(X.lookup((F.col("pk") % 14).cast("int"), X.EXDARK_CLASSES), F.lit("Lamp"))
    line = F.concat(F.when(F.col("ln") % 6 == 0, "% ").otherwise(""), F.concat_ws(" ", name, "b.x", "b.y", "b.w", "b.h", F.lit("0"), F.lit("0")))
    return _rows(b.select(*KEYS, X.exdark_line(line, F.col("ln")).alias("r")), *KEYS)


_SHARD = 256  # documents that the derived rows are written into; each is a bounded file


@query("src2_coco", f"""with {BRIDGE} select k::varchar image_id, k||'-'||ln||'-'||pk||'-'||sk note, case when {_ID} = 9 then 'other' else lab end "label", ({_ID})::varchar label_id, true known, ln % 11 = 0 "ignore", ln % 13 = 0 iscrowd, {_BOX},
 '{{"source_annotation_id":"'||k||'-'||ln||'-'||pk||'-'||sk||'","source_area":'||case when ln % 2 = 0 then 'null' else ln||'.0' end||'}}' meta_json from o join i using (k)""")
def coco(spark, folder):
    """SRC-2, J-1, J-2: COCO documents read into tables and joined by string ids; every object with its fields."""
    b = bridge(spark, folder)
    area = F.when(F.col("ln") % 2 == 1, F.col("ln").cast("double"))
    note = F.struct(F.concat_ws("-", *KEYS).alias("id"), F.col("k").alias("image_id"), _code(F.col("lab")).alias("category_id"), G.xywh(F.col("b")).alias("bbox"), area.alias("area"), (F.col("ln") % 13 == 0).cast("int").alias("iscrowd"), (F.col("ln") % 11 == 0).alias("ignore"))
    own = b.groupBy("k", "iw", "ih").agg(F.collect_list(note).alias("notes"))
    picture = F.struct(F.col("k").alias("id"), F.concat(F.lit("i/"), "k", F.lit(".png")).alias("file_name"), F.col("iw").alias("width"), F.col("ih").alias("height"))
    doc = own.groupBy((F.col("k") % _SHARD).alias("s")).agg(F.collect_list(picture).alias("images"), F.flatten(F.collect_list("notes")).alias("annotations"))
    cats = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(v).alias("name")) for k, v in {**NAMES, 9: "other"}.items()])
    doc = doc.select(F.to_json(F.struct("images", "annotations", cats.alias("categories"))).alias("value"))
    images, notes, cats = X.coco_tables(X.document_elements(doc))
    o = images.select(F.col("id").alias("image_id")).join(X.coco_objects(notes, cats), "image_id", "left")
    return _rows(o.select("image_id", F.explode("raw").alias("r")).withColumn("note", F.get_json_object("r.meta_json", "$.source_annotation_id")), "image_id", "note")


@query("src4_scalabel", f"""with {BRIDGE} select k::varchar||'.jpg' source_id, nullif(cond, 'rain') condition, ln||'-'||pk||'-'||sk label_id, lab "label", true known, false "ignore", false iscrowd, {_BOX},
 '{{"attributes":"{{}}","manual_attributes":null,"manual_shape":'||(ln % 2 = 0)||'}}' meta_json, '{{"scene":null,"source_annotation_format":"bdd100k_scalabel","source_file_name":"'||k||'.jpg","timeofday":"'||split||'","timestamp":'||k||'}}' frame_meta from i join o using (k) where ln % 4 <> 0""")
def scalabel(spark, folder):
    """SRC-4: Scalabel lists; a quarter of the labels has no box; every object with its fields."""
    b = bridge(spark, folder)
    x, y, w, h = (F.col(f"b.{c}") for c in "xywh")
    box = F.when(F.col("ln") % 4 != 0, F.struct(x.alias("x1"), y.alias("y1"), (x + w).alias("x2"), (y + h).alias("y2")))
    one = F.struct(F.concat_ws("-", "ln", "pk", "sk").alias("id"), F.col("lab").alias("category"), (F.col("ln") % 2 == 0).alias("manualShape"), box.alias("box2d"))
    frames = b.groupBy("k", "cond", "split").agg(F.collect_list(one).alias("labels"))
    attributes = F.struct(F.when(F.col("cond") != "rain", F.col("cond")).alias("weather"), F.col("split").alias("timeofday"))
    frame = F.to_json(F.struct(F.concat("k", F.lit(".jpg")).alias("name"), F.col("k").alias("timestamp"), attributes.alias("attributes"), "labels"))
    f = X.scalabel_frames(frames.select(F.lit("").alias("list"), F.col("k").alias("pos"), frame.alias("value")))
    return _rows(f.select("source_id", "condition", F.col("meta_json").alias("frame_meta"), F.explode("raw").alias("r")), "source_id", "condition", "frame_meta")


@query("src5_voc", f"""with {BRIDGE} select k::varchar||'.png' filename, lab "label", null::varchar label_id, true known, ln % 3 = 0 "ignore", false iscrowd, round(x-1,6) x, round(y-1,6) y, round(w+1,6) w, round(h+1,6) h, '{{"pose":"'||ln||'-'||pk||'-'||sk||'","truncated":'||(ln % 2 = 1)||'}}' meta_json from o""")
def voc(spark, folder):
    """SRC-5: VOC documents; inclusive corners counted from 1; every object with its fields."""
    b = bridge(spark, folder)
    x, y, w, h = (F.col(f"b.{c}") for c in "xywh")
    tag = lambda n, v: F.concat(F.lit(f"<{n}>"), v.cast("string"), F.lit(f"</{n}>"))
    corners = F.concat(tag("xmin", x), tag("ymin", y), tag("xmax", x + w), tag("ymax", y + h))
    parts = (tag("name", F.col("lab")), tag("pose", F.concat_ws("-", "ln", "pk", "sk")), tag("truncated", F.col("ln") % 2), tag("difficult", F.when(F.col("ln") % 3 == 0, 1).otherwise(0)), tag("bndbox", corners))
    o = F.concat(F.lit("<object>"), *parts, F.lit("</object>"))
    doc = b.groupBy("k").agg(F.concat(F.lit("<annotation>"), tag("filename", F.concat("k", F.lit(".png"))), F.array_join(F.collect_list(o), ""), F.lit("</annotation>")).alias("value"))
    v = doc.select(X.voc_objects(F.col("value")).alias("v")).select("v.filename", F.explode("v.raw").alias("r"))
    return _rows(v, "filename")


_JUDGED = """j as (select k, split, lab, iw, ih, x, y, w, h, case when lab='RF' then 'ignored' when w<=0 or h<=0 then 'invalid' when x>=0 and y>=0 and x+w<=iw and y+h<=ih then 'kept'
 when least(greatest(x+w,0),iw) > least(greatest(x,0),iw) and least(greatest(y+h,0),ih) > least(greatest(y,0),ih) then 'kept' else 'invalid' end s from i join o using (k)),
p as (select i.k, i.split, count(s) n, count(*) filter (s='kept') kept, count(*) filter (s='invalid') inv, count(*) filter (s='ignored') ign, count(*) filter (s='kept' and lab not in ('NF','NO','RF')) unm from i left join j using (k) group by 1, 2)"""
FLAGSHIP_SQL = f"""with {BRIDGE}, {_JUDGED} select split, count(*) source_images_seen, count(*) filter (kept > 0) source_images_kept, count(*) filter (kept = 0) dropped_empty_or_ambiguous_images, sum(n)::bigint source_objects_seen, sum(kept)::bigint source_objects_kept,
 sum(inv)::bigint dropped_invalid_boxes, 0::bigint dropped_unknown_labels, sum(ign)::bigint dropped_ignored_labels, sum(unm)::bigint unmapped_meta_labels from p group by split"""


@query("a1_import_stats", FLAGSHIP_SQL)
def import_stats(spark, folder):
    """A-1, P-5, P-6, F-7: the whole import of derived boxes, with its statistics per split."""
    b = bridge(spark, folder)
    orders = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    split = F.when(k % 10 == 0, "val").when(k % 10 == 1, "test").otherwise("train")
    images = orders.select(k.alias("k"), split.alias("split"), (320 + 40 * (k % 9)).cast("int").alias("width"), (240 + 30 * (k % 7)).cast("int").alias("height"))
    objects = b.groupBy("k").agg(F.collect_list(X.raw(F.col("lab"), _code(F.col("lab")), F.col("b"))).alias("raw"))
    pics = images.join(objects, "k", "left").withColumn("source_id", F.col("k").cast("string")).withColumn("image_path", F.concat(F.lit("p/"), "k"))
    cfg = SourceConfig.of({"key": "bridge", "source_format": "coco", "splits": {"train": {"root": "/"}}, "class_map": {"NF": "car", "NO": "truck", "RF": "bus"}, "ignore_labels": ["RF"]})
    return statistics(judge(pics, cfg), ("split",))


@query("proj6_records", f"""with {BRIDGE}, {_JUDGED} select 'bridge:'||split||':'||k image_id, 'bridge' dataset, split, kept::bigint n_objects, case split when 'train' then '{{"base": 1, "license": "x", "own": "'||k||'", "shared": "split"}}' else '{{"base": 1, "own": "'||k||'", "shared": "source"}}' end meta_json from p where kept > 0""")
def records(spark, folder):
    """P-6: canonical rows of all three splits: ids, objects and merged metadata (the record's over the split's over the source's)."""
    b = bridge(spark, folder)
    objects = b.groupBy("k", "iw", "ih", "split").agg(F.collect_list(X.raw(F.col("lab"), _code(F.col("lab")), F.col("b"))).alias("raw"))
    own = F.to_json(F.struct(F.col("k").cast("string").alias("own")))
    pics = objects.select(F.col("k").cast("string").alias("source_id"), F.lit("p").alias("image_path"), F.col("iw").cast("int").alias("width"), F.col("ih").cast("int").alias("height"), "raw", "split", own.alias("meta_json"))
    splits = {"train": {"root": "/", "meta": {"license": "x", "shared": "split"}}, "val": {"root": "/"}, "test": {"root": "/"}}
    cfg = SourceConfig.of({"key": "bridge", "source_format": "coco", "splits": splits, "ignore_labels": ["RF"], "meta": {"base": 1, "shared": "source"}})
    out = None
    for name in splits:
        rows = ingest(pics.filter(F.col("split") == name).drop("split"), cfg, name)[0].select("image_id", "dataset", "split", F.size("objects").cast("bigint").alias("n_objects"), "meta_json")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("src3_path_part", "select image_id, split_part(image_path, '/', 2) part, split_part(image_path, '/', -2) folder from image_rows where image_path is not null")
def path_part(spark, folder):
    """SRC-3: a condition from a part of the path."""
    rows = table(spark, folder, "image_rows").filter("image_path is not null")
    return rows.select("image_id", X.path_part(F.col("image_path"), 1).alias("part"), X.path_part(F.col("image_path"), -2).alias("folder"))


_GAP = r"(?:\\x0A|\\x0D|\\x09|\\x0B|\\x0C| |#(?:[^\\]|\\x[1-9A-F]|\\x0[^AD])*(?:\\x0A|\\x0D))+"
_EXPORT = f"""with {BRIDGE}, n as (select k, iw, ih, ((k * 7919) % 100000) * 1000000000 || '_jpg.rf.v3x' || k || '.jpg' filename, ((k * 7919) % 100000) s from i where k % 3 <> 0),
images as (select row_number() over (order by filename) id, filename, iw, ih, case (s // 60) % 10 when 0 then 'val' when 1 then 'test' else 'train' end split from n)"""


def _export(spark, folder):
    """(csv, sizes) of a driving export derived from orders and lineitem; a third of the pictures are of an old version."""
    b = bridge(spark, folder)
    named = lambda k: F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("_jpg.rf."), F.md5(k.cast("string")), F.lit(".jpg"))).otherwise(F.concat((((k * 7919) % 100000) * 1000000000).cast("string"), F.lit("_jpg.rf.v3x"), k.cast("string"), F.lit(".jpg")))
    x1, y1, x2, y2 = F.col("b.x"), F.col("b.y"), F.col("b.x") + F.col("b.w"), F.col("b.y") + F.col("b.h")
    fine = b.filter((x1 >= 0) & (y1 >= 0) & (x2 > x1) & (y2 > y1) & (x2 <= F.col("iw")) & (y2 <= F.col("ih")))
    csv = fine.select(named(F.col("k")).alias("filename"), F.col("iw").alias("width"), F.col("ih").alias("height"), F.concat(F.lit(" "), "lab").alias("class"), x1.alias("xmin"), y1.alias("ymin"), x2.alias("xmax"), y2.alias("ymax"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"))
    return csv, orders.select(named(F.col("k")).alias("filename"), (320 + 40 * (F.col("k") % 9)).cast("int").alias("width"), (240 + 30 * (F.col("k") % 7)).cast("int").alias("height"))


@query("src11_images", f"{_EXPORT} select id, filename, iw width, ih height, split from images")
def export_images(spark, folder):
    """SRC-11, J-6: the pictures of a driving export with ids by file name, sizes and splits."""
    return driving_export(*_export(spark, folder))[0].select(F.col("id").cast("bigint").alias("id"), "filename", F.col("width").cast("bigint").alias("width"), F.col("height").cast("bigint").alias("height"), "split")


@query("src11_annotations", f"{_EXPORT} select m.id image_id, m.filename, lab category, m.split, round(x,6) x, round(y,6) y, round(w,6) w, round(h,6) h from images m join n using (filename) join o using (k) where x >= 0 and y >= 0 and w > 0 and h > 0 and x + w <= m.iw and y + h <= m.ih")
def export_annotations(spark, folder):
    """SRC-11, J-5: the boxes of a driving export's known pictures."""
    notes = driving_export(*_export(spark, folder))[1]
    return notes.select(F.col("image_id").cast("bigint").alias("image_id"), "filename", "category", "split", *[F.round(F.col("bbox")[i], 6).alias(c) for i, c in enumerate("xywh")])


@query("src16_tables", "select split, count(*) n, count(distinct image_id) n_images, sum(coalesce(len(objects), 0))::bigint n_objects from (select image_id, objects, case when lower(trim(split, chr(32)||chr(9)||chr(10)||chr(13))) in ('train','training') then 'train' when lower(trim(split, chr(32)||chr(9)||chr(10)||chr(13))) in ('val','valid','validation') then 'val' when lower(trim(split, chr(32)||chr(9)||chr(10)||chr(13))) in ('test','testing') then 'test' end split from image_rows) where split is not null group by 1")
def canonical_tables(spark, folder):
    """SNK-1, SRC-16, SRC-19: canonical tables written per split and loaded again, with schema and splits checked."""
    rows = table(spark, folder, "image_rows").withColumn("split", split_name(F.col("split"))).filter("split is not null").select(*CANONICAL.fieldNames())
    place = f"{own_folder(spark)}/tables-{uuid.uuid4().hex}"
    for name in ("train", "val", "test"):
        rows.filter(F.col("split") == name).write.parquet(f"{place}/{name}")
    held = load_canonical(spark, place)
    return held.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("image_id").alias("n_images"), F.sum(F.size(F.coalesce("objects", F.array()))).alias("n_objects"))


@query("src17_bytes", "with f as (select image_path p, min(hex(image.bytes)) c from image_rows where image.bytes is not null group by 1) select r.image_id, r.image.bytes is null was_missing, octet_length(coalesce(r.image.bytes, unhex(f.c)))::bigint n_bytes from image_rows r left join f on f.p = coalesce(nullif(r.image.path, ''), r.image_path) where r.image.bytes is not null or f.c is not null")
def fallback_bytes(spark, folder):
    """SRC-17: missing picture bytes taken from the file that the row names, where there is one."""
    rows = table(spark, folder, "image_rows").select("image", "image_id", "image_path")
    files = rows.filter("image.bytes is not null").groupBy("image_path").agg(F.unhex(F.min(F.hex("image.bytes"))).alias("content"))
    path = F.coalesce(F.nullif("image.path", F.lit("")), F.col("image_path"))
    known = rows.filter("image.bytes is not null").unionByName(rows.filter("image.bytes is null").join(files.select(F.col("image_path").alias("__f")), path == F.col("__f"), "left_semi"))
    got = with_fallback_bytes(known.withColumn("was_missing", F.col("image.bytes").isNull()), files)
    return got.select("image_id", "was_missing", F.octet_length("image.bytes").cast("bigint").alias("n_bytes"))


@query("src15_sizes", f"""with b as (select image.bytes::varchar t from image_rows where image.bytes is not null), s as (select regexp_extract(t, '^P[25]{_GAP}([0-9]+){_GAP}([0-9]+)', ['w', 'h']) m from b) select nullif(m.w, '')::int width, nullif(m.h, '')::int height, count(*) n from s group by 1, 2""")
def sizes(spark, folder):
    """SRC-15: picture sizes from their headers."""
    rows = table(spark, folder, "image_rows").select(F.col("image.bytes").alias("b")).filter("b is not null")
    return rows.select(size_of("b").alias("s")).groupBy("s.width", "s.height").agg(F.count("*").alias("n"))


@query("j5_known_images", "select count(*) n, count(distinct image_id) n_images from detection_samples d where exists (select 1 from image_rows i where i.image_id = d.image_id)")
def known_images(spark, folder):
    """J-5: rows of known images (semi-join)."""
    d = table(spark, folder, "detection_samples").select("image_id").join(table(spark, folder, "image_rows").select("image_id"), "image_id", "left_semi")
    return d.agg(F.count("*").alias("n"), F.count_distinct("image_id").alias("n_images"))
