import json

import pytest
from pyspark.sql import functions as F

from boxlake.schema import require_canonical
from boxlake.sources import formats as X
from boxlake.sources.config import ConfigError, SourceConfig
from boxlake.sources.readers import convert, driving_export, load_canonical, read_split, reader
from tests.pictures import png


def cfg(fmt, root, paths, split="train", **more):
    s = {k: more.pop(k) for k in ("meta", "condition", "output_split") if k in more}
    return SourceConfig.of({"key": "src", "source_format": fmt, "splits": {split: {"root": str(root), "paths": paths, **s}}, **more})


def objects(rows):
    return {o["native_label"]: o for r in rows for o in r["objects"]}


def test_voc(spark, tmp_path):
    for d in ("img", "ann"):
        (tmp_path / d).mkdir()
    (tmp_path / "img/000001.jpg").write_bytes(png(20, 10))
    (tmp_path / "set.txt").write_text("000001 1\n\n")
    o = lambda n, b, d, t: f"<object><name>{n}</name><truncated>{t}</truncated><difficult>{d}</difficult><bndbox><xmin>{b[0]}</xmin><ymin>{b[1]}</ymin><xmax>{b[2]}</xmax><ymax>{b[3]}</ymax></bndbox></object>"
    (tmp_path / "ann/000001.xml").write_text(f"<annotation><filename>000001.jpg</filename>{o('car', (1, 2, 20, 10), 0, 1)}{o('person', (2, 2, 4, 5), 1, 0)}</annotation>")
    rows, stats = read_split(spark, cfg("pascal_voc", tmp_path, {"image_set": "set.txt", "annotations": "ann", "images": "img"}), "train")
    require_canonical(rows)
    got = rows.collect()
    assert len(got) == 1 and got[0]["width"] == 20 and got[0]["image_id"] == "src:train:000001"
    o = objects(got)
    assert o["car"]["bbox"] == [0, 1, 20, 9] and json.loads(o["car"]["meta_json"])["truncated"] and o["person"]["ignore"]
    assert stats.first()["source_objects_kept"] == 2


def test_coco_condition_from_path(spark, tmp_path):
    (tmp_path / "img/fog/train").mkdir(parents=True)
    (tmp_path / "img/fog/train/sample.png").write_bytes(png(20, 10))
    (tmp_path / "img/fog/train/odd.png").write_bytes(png(20, 10))
    doc = {"images": [{"id": 1, "file_name": "fog/train/sample.png", "width": 20, "height": 10}, {"id": "2", "file_name": "fog/train/odd.png", "width": 5, "height": 5}], "categories": [{"id": 1, "name": "car"}], "annotations": [{"image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4], "iscrowd": 0}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    c = cfg("coco", tmp_path, {"images": "img", "annotations": "a.json"}, class_map={"car": "car"}, meta={"condition_from_file_name_part": 0})
    rows, stats = read_split(spark, c, "train")
    got = rows.collect()
    assert [r["condition"] for r in got] == ["fog"] and objects(got)["car"]["meta_label"] == "car"
    assert json.loads(got[0]["meta_json"])["source_annotation_format"] == "coco"
    assert stats.first()["source_images_seen"] == 1  # the picture of another size is not counted
    doc["annotations"][0]["category_id"] = 7
    (tmp_path / "a.json").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="unknown category_id"):
        read_split(spark, c, "train")[0].collect()


def test_scalabel(spark, tmp_path):
    (tmp_path / "img").mkdir()
    (tmp_path / "img/f.jpg").write_bytes(png(20, 10))
    frame = {"name": "f.jpg", "attributes": {"weather": "rainy", "scene": "city street"}, "labels": [{"id": "1", "category": "car", "box2d": {"x1": -1, "y1": 1, "x2": 8, "y2": 9}}, {"id": "2", "category": "traffic sign"}]}
    (tmp_path / "a.json").write_text(json.dumps([frame]))
    got = read_split(spark, cfg("bdd100k", tmp_path, {"images": "img", "annotations": "a.json"}), "train")[0].collect()
    o = got[0]["objects"]
    assert len(o) == 1 and o[0]["bbox"] == [0, 1, 8, 8] and o[0]["native_label_id"] == "1"
    assert got[0]["condition"] == "rainy" and got[0]["domain"] == "road" and json.loads(got[0]["meta_json"])["scene"] == "city street"


def test_yolo_exdark_visdrone(spark, tmp_path):
    for d in ("img", "lab", "ex", "exa", "vi", "va"):
        (tmp_path / d).mkdir()
    (tmp_path / "img/a.PNG").write_bytes(png(20, 10))
    (tmp_path / "img/b.png").write_bytes(png(20, 10))
    (tmp_path / "lab/a.txt").write_text("0 0.5 0.5 0.2 0.4\n1 0.1 0.1 0.5 0.1 0.5 0.5\n9 x\n0 0.5 0.5 0.2 zz\n\n0 0.1 0.1 0.2\n")
    (tmp_path / "data.yaml").write_text("names: [car, bus]\nnc: 2\n")
    rows, stats = read_split(spark, cfg("yolo", tmp_path, {"images": "img", "labels": "lab"}), "train")
    got, s = rows.collect(), stats.first()
    assert len(got) == 1 and [round(v, 3) for v in objects(got)["car"]["bbox"]] == [8, 3, 4, 4] and [round(v, 3) for v in objects(got)["bus"]["bbox"]] == [2, 1, 8, 4]
    assert (s["source_images_seen"], s["dropped_unknown_labels"], s["source_objects_seen"]) == (2, 1, 3)
    (tmp_path / "list.txt").write_text("Name | Class | Light | In | Split\nOne.jpg 1 2 1 1\ntwo.jpg 2 2 1 3\n")
    (tmp_path / "ex/one.JPG").write_bytes(png(30, 30))
    (tmp_path / "exa/One.jpg.txt").write_text("% bbGt\nBicycle 1 2 3 4 0 0\nLamp 1 2 3 4 0\nshort 1\n")
    rows, stats = read_split(spark, cfg("exdark", tmp_path, {"image_list": "list.txt", "images": "ex", "annotations": "exa"}), "train")
    got = rows.collect()
    assert objects(got)["Bicycle"]["bbox"] == [1, 2, 3, 4] and json.loads(got[0]["meta_json"])["lighting"] == "ambient" and stats.first()["dropped_unknown_labels"] == 1
    (tmp_path / "vi/p.jpg").write_bytes(png(30, 30))
    (tmp_path / "va/p.txt").write_text("1,2,3,4,1,4,0,0\n1,2,3,4,0,4,0,0\n1,2,3,4,1,4\n1,2,3,x,1,4,0,0\n1,2,3,4,1,99,0,0\n")
    got = read_split(spark, cfg("visdrone_det", tmp_path, {"images": "vi", "annotations": "va"}), "train")[0].collect()
    assert [o["ignore"] for o in got[0]["objects"]] == [False, True]


def test_import_statistics(spark, tmp_path):
    from boxlake.functions import geometry as G
    from boxlake.sources.ingest import ingest

    box = lambda *v: G.box(*[F.lit(float(x)) for x in v])
    cases = {"valid": ("car", (1, 1, 4, 4)), "empty": None, "zero": ("car", (1, 1, 0, 4)), "unmapped": ("dog", (2, 2, 4, 4)), "ignored": ("ignored", (3, 3, 4, 4))}
    df = None
    for name, case in cases.items():
        raw = F.array(X.raw(F.lit(case[0]), F.lit("1"), box(*case[1]))) if case else F.array().cast(f"array<{X.RAW}>")
        one = spark.range(1).select(F.lit(name).alias("source_id"), F.lit("p").alias("image_path"), F.lit(16).alias("width"), F.lit(16).alias("height"), raw.alias("raw"))
        df = one if df is None else df.unionByName(one)
    c = SourceConfig.of({"key": "stats", "source_format": "coco", "splits": {"train": {"root": "/"}}, "bbox_policy": "drop", "class_map": {"car": "car"}, "ignore_labels": ["ignored"]})
    rows, stats = ingest(df, c, "train")
    assert {r["image_id"] for r in rows.collect()} == {"stats:train:valid", "stats:train:unmapped"}
    s = stats.first().asDict()
    assert s == {"source_images_seen": 5, "source_images_kept": 2, "dropped_empty_or_ambiguous_images": 3, "source_objects_seen": 4, "source_objects_kept": 2, "dropped_invalid_boxes": 1, "dropped_unknown_labels": 0, "dropped_ignored_labels": 1, "unmapped_meta_labels": 1}


def test_driving_export(spark):
    ns = 10**9
    names = [f"{t * ns}_jpg.rf.abc.jpg" for t in (6000, 6060, 6120, 6180)] + [f"{6000 * ns}_jpg.rf.{'a' * 32}.jpg"]
    sizes = spark.createDataFrame([(n, 100, 50) for n in names], "filename string, width int, height int")
    csv = spark.createDataFrame([(n, "100", "50", "car", "1", "1", "9", "9") for n in (names[0], names[1], names[2], names[4])], "filename string, width string, height string, class string, xmin string, ymin string, xmax string, ymax string")
    images, notes = driving_export(csv, sizes)
    assert {r["split"]: r["count"] for r in images.groupBy("split").count().collect()} == {"train": 2, "val": 1, "test": 1}
    assert notes.count() == 3
    with pytest.raises(ValueError, match="missing columns"):
        driving_export(csv.drop("xmin"), sizes)


def test_convert_and_load(spark, tmp_path):
    (tmp_path / "img").mkdir()
    (tmp_path / "lab").mkdir()
    (tmp_path / "img/a.png").write_bytes(png(20, 10))
    (tmp_path / "lab/a.txt").write_text("1 0.5 0.5 0.2 0.4\n")
    one = {"root": str(tmp_path), "paths": {"images": "img", "labels": "lab"}}
    c = SourceConfig.of({"key": "D", "source_format": "yolo_noyml", "splits": {"train": one, "validation": {**one, "output_split": "val"}}, "class_names": {1: "car"}})
    out = str(tmp_path / "out")
    assert convert(spark, c, out)["val"]["source_images_kept"] == 1
    assert load_canonical(spark, out).count() == 2 and load_canonical(spark, out, "val").first()["split"] == "validation"
    with pytest.raises(KeyError):
        load_canonical(spark, out, "test")
    with pytest.raises(Exception):
        convert(spark, c, out)
    with pytest.raises(ConfigError):
        SourceConfig.of({"key": "d", "source_format": "yolo", "splits": {"a": {"root": "/", "output_split": "x"}, "b": {"root": "/", "output_split": "x"}}}).output_splits()
    with pytest.raises(ConfigError):
        SourceConfig.of({"key": "d", "source_format": "yolo", "splits": {"a": {"root": "/"}}, "colour": 1})
    with pytest.raises(ValueError, match="supported"):
        reader("tiff")
