import json

import pytest
from pyspark.sql import functions as F

from boxlake.operators import merge as M
from boxlake.operators.components import min_label_components
from boxlake.operators.latest import latest_by
from boxlake.schema import CANONICAL, SOURCES
from tests.pictures import png

REF = "ref_id bigint, dataset string, split string, index int, image_id string, width int, height int, content_hash string, source_image_id string, object_count int, class_counts array<struct<class_name:string,n:int>>, annotation_hash string"


def ref(i, dataset, split, h, classes=("car",), width=8, src=None):
    return (i, dataset, split, i, f"{dataset}:{split}:{i}", width, 8, h, src, len(classes), [(c, 1) for c in sorted(set(classes))], "-".join(classes))


def planned(spark, rows, **k):
    linked = M.lineage(spark.createDataFrame(rows, REF))
    plan = M.plan_merge(linked, **k)
    return plan.collect(), M.merge_stats(linked, plan).first().asDict()


def test_split_conflict(spark):
    plan, stats = planned(spark, [ref(0, "acdc", "train", "h"), ref(1, "carpk", "val", "h"), ref(2, "exdark", "test", "h")])
    assert [p["representative_id"] for p in plan] == [2]
    assert stats["rows_dropped_for_split_conflict"] == 2 and stats["split_conflict_components"] == 1


def test_donor(spark):
    plan, stats = planned(spark, [ref(0, "acdc", "train", "h"), ref(1, "carpk", "train", "h", ("car", "person"))])
    assert (plan[0]["representative_id"], plan[0]["donor_id"]) == (0, 1)
    assert stats["rows_dropped_as_same_split_exact_duplicates"] == 1 and stats["annotation_enriched_rows"] == 1


def test_dimensions(spark):
    rows = [ref(0, "hazydet", "train", "a", src="9"), ref(1, "hazydet_clear", "train", "b", width=9, src="9")]
    with pytest.raises(Exception, match="mismatched dimensions"):
        planned(spark, rows)
    assert planned(spark, rows, strict=False)[0] == []


def test_left_out(spark):
    rows = [ref(0, "hazydet", "train", "a", src="9"), ref(1, "hazydet_clear", "train", "b", width=9, src="9"), ref(2, "hazydet", "val", "c", src="9"), ref(3, "acdc", "train", "d"), ref(4, "acdc", "train", "e", ())]
    linked = M.lineage(spark.createDataFrame(rows, REF))
    plan = M.plan_merge(linked, strict=False)
    s, out = M.merge_stats(linked, plan).first().asDict(), M.left_out(linked).collect()
    assert [tuple(r) for r in out] == [(0, 3, 1)]
    dropped = sum(v for k, v in s.items() if k.startswith("rows_dropped"))
    assert s["output_rows"] + dropped + sum(r["n_left_out"] for r in out) == len(rows)
    told = json.loads(M.manifest(spark.createDataFrame([], CANONICAL), linked, plan))["deduplication"]
    assert (told["components_of_several_sizes"], told["rows_of_several_sizes"], told["rows_dropped_for_several_sizes"]) == (1, 3, 1)


def test_meta_label_is_authority(spark):
    o = lambda n, m, i=False: ([1.0, 1.0, 4.0, 4.0], n, None, m, i, False, "{}")
    rows = [(None, "i", "carpk", "train", "p", 16, 16, "c", "d", None, [o("biker", None), o("not-a-car", "car"), o("car", "boat"), o("bus", "bus", True)], "{}")]
    r = M.retained_objects(spark.createDataFrame(rows, CANONICAL)).first()
    assert (r["total"], r["ignored"], r["excluded"]) == (4, 1, 2) and [(x["native_label"], x["meta_label"]) for x in r["objects"]] == [("not-a-car", "car")]


def sources(spark, tmp_path):
    """One row per source; acdc and carpk share bytes, the hazy pair a source image; exdark keeps nothing."""
    splits = {"acdc": "train", "carpk": "test", "voc2007": "val", "udacity": "val", "visdrone": "val", "xwod": "test"}
    for n, s in enumerate(SOURCES):
        split = splits.get(s, "train")
        data = png(8, 8, 1 if s in ("acdc", "carpk") else 10 + n)
        o = [([0.0, 0.0, 4.0, 4.0], "auto", None, "car", False, False, "{}")]
        if s == "exdark":
            o = [([0.0, 0.0, 4.0, 4.0], "Dog", None, None, False, False, "{}"), ([0.0, 0.0, 4.0, 4.0], "Bus", None, "bus", True, False, "{}")]
        meta = '{"source_image_id": 9}' if s.startswith("hazydet") and s != "hazydet_real" else "{}"
        row = ((bytearray(data), "p"), f"{s}:{split}:1", s, split, "p", 8, 8, "clear", "road", False, o, meta)
        spark.createDataFrame([row], CANONICAL).write.parquet(str(tmp_path / "in" / s / split))
    return str(tmp_path / "in")


def test_twelve_sources(spark, tmp_path):
    from boxlake.__main__ import merge

    root, out = sources(spark, tmp_path), str(tmp_path / "out")
    first = merge(spark, root, out, False)
    rows = spark.read.parquet(out)
    assert rows.count() == 10 and first["output"]["rows"] == 10 and sum(first["output"]["splits"].values()) == 10
    ids = {r["image_id"] for r in rows.select("image_id").collect()}
    assert "carpk:test:1" in ids and "acdc:train:1" not in ids and "exdark:train:1" not in ids
    assert rows.filter("dataset like 'hazydet%' and dataset <> 'hazydet_real'").select("lineage_id").distinct().count() == 1
    x = first["input"]["datasets"]["exdark"]
    assert x["observed_mappings"] == [{"native_label": "Bus", "meta_label": "bus", "objects": 1}, {"native_label": "Dog", "meta_label": None, "objects": 1}]
    assert x["excluded_native_label_counts"] == {"Dog": 1} and x["ignored_native_label_counts"] == {"Bus": 1}
    meta = json.loads(rows.filter("dataset = 'carpk'").first()["meta_json"])
    assert meta["merge_source_datasets"] == ["acdc", "carpk"] and len(meta["merge_source_records"]) == 2 and meta["merge_original_split"] == "test"
    assert json.loads(rows.filter("dataset = 'carpk'").first()["objects"][0]["meta_json"])["merge_annotation_source"]["dataset"] == "acdc"
    with pytest.raises(FileExistsError):
        merge(spark, root, out, False)
    assert merge(spark, root, out, True) == first
    for bad in (root, f"{root}/acdc", f"{root}/acdc/x"):
        with pytest.raises(ValueError, match="source dataset"):
            M.publish(spark.range(1), bad, (f"{root}/acdc",), True)


def test_violations(spark):
    o = lambda m: [([0.0], "a", None, m, False, False, "{}")]
    df = spark.createDataFrame([("a", "train", "h", "l", o("car")), ("a", "val", "h", "l", o("boat")), ("b", "odd", None, None, [])], "image_id string, split string, content_hash string, lineage_id string, objects array<struct<bbox:array<float>,native_label:string,native_label_id:string,meta_label:string,ignore:boolean,iscrowd:boolean,meta_json:string>>")
    assert {r["check"] for r in M.violations(df).collect()} == {"repeated image_id", "hash in several splits", "lineage in several splits", "no objects", "illegal object", "unknown split"}


def test_delivered_violations(spark, tmp_path):
    import __spark_entry__ as entry

    o = [([0.0, 0.0, 4.0, 4.0], "a", None, "car", False, False, "{}")]
    pic = lambda i, split, data: ((bytearray(data), "p"), f"acdc:{i}", "acdc", split, "p", 8, 8, "c", "d", False, o, "{}")
    rows = [pic(0, "train", b"x"), pic(1, "Val ", b"x"), pic(2, "train", b"y"), pic(2, "train", b"y"), pic(3, "train", b"v"), pic(4, "test", b"w")]
    spark.createDataFrame(rows, CANONICAL).withColumn("delivered_at", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "image_rows.parquet"))
    scans = [(i, "acdc", s, i, f"acdc:{i}", 8, 8, h * 64, None, 1, [("car", 1)], "a") for i, s, h in ((0, "train", "1"), (1, "val", "1"), (3, "train", "2"), (4, "test", "2"))]
    spark.createDataFrame(scans, REF.replace(" index int", " row_index int")).withColumn("scanned_at", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "row_refs.parquet"))
    got = {(r["check"], r["n"]) for r in entry.queries()["f11_delivered_violations"](spark, str(tmp_path)).collect()}
    assert got == {("repeated image_id", 2), ("hash in several splits", 2), ("lineage in several splits", 2)}
    assert [(r["check"], r["key"]) for r in entry.queries()["f11_merged_violations"](spark, str(tmp_path)).collect()] == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(20)] + [(7, 7), (999, 999), (None, 3)]
    got = dict(map(tuple, min_label_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got[30] == 0 and got[219] == 100 and got[999] == 999 and len(got) == 31 + 21 + 1
    assert min_label_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, None), (1, 7, "b"), (None, 9, "c"), (2, None, "d")], "k int, t int, v string")
    assert {tuple(r) for r in latest_by(df, "k", "t").collect()} == {(1, 7, "b"), (2, None, "d")}
    assert latest_by(df.filter(F.lit(False)), "k", "t").count() == 0


def test_merge_order_and_manifest(spark, tmp_path):
    """Rows of one split keep the sources' and the files' order; the manifest lies in the output and tells it; BLAKE2b equals hashlib's."""
    import hashlib

    from boxlake.__main__ import merge

    root, out = sources(spark, tmp_path), str(tmp_path / "out")
    o = [([0.0, 0.0, 4.0, 4.0], "auto", None, "car", False, False, '{"k": 1, "merge_annotation_source": 0}')]
    rows = [((bytearray(png(8, 8, 100 + i)), "p"), f"voc2007:val:{9 - i}", "voc2007", "val", "p", 8, 8, "clear", "road", False, o, '{"z": [1], "a": "x"}') for i in range(5)]
    spark.createDataFrame(rows, CANONICAL).coalesce(1).write.mode("overwrite").parquet(f"{root}/voc2007/val")
    made = merge(spark, root, out, False, "blake2b")
    held = json.loads((tmp_path / "out/_manifest.json").read_text())
    assert held == made and set(held["output"]["record_order_hashes"]) == {"train", "val", "test"} and held["output"]["splits"]["val"] == 7
    val = spark.read.parquet(f"{out}/split=val")
    ids = [r["image_id"] for r in val.coalesce(1).collect()]
    assert [i for i in ids if i.startswith("voc")] == [f"voc2007:val:{9 - i}" for i in range(5)]
    r = val.filter("image_id = 'voc2007:val:9'").first()
    meta = json.loads(r["meta_json"])
    assert meta["merge_content_hash"] == hashlib.blake2b(png(8, 8, 100), digest_size=32).hexdigest() == r["content_hash"] and meta["z"] == [1] and list(meta) == sorted(meta)
    name = f"voc2007|val|voc2007:val:9|{r['content_hash']}"
    assert meta["merge_lineage_id"] == hashlib.blake2b(name.encode(), digest_size=16).hexdigest()
    own = json.loads(r["objects"][0]["meta_json"])
    assert own["k"] == 1 and own["merge_annotation_source"]["dataset"] == "voc2007"
    rows.reverse()
    spark.createDataFrame(rows, CANONICAL).coalesce(1).write.mode("overwrite").parquet(f"{root}/voc2007/val")
    other = merge(spark, root, out, True, "blake2b")["output"]["record_order_hashes"]
    assert other["val"] != held["output"]["record_order_hashes"]["val"] and other["train"] == held["output"]["record_order_hashes"]["train"]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".out")]


def test_merge_refuses_rows_of_elsewhere_and_bad_json(spark, tmp_path):
    from boxlake.__main__ import merge

    root, out = sources(spark, tmp_path), str(tmp_path / "out")
    o = [([0.0, 0.0, 4.0, 4.0], "auto", None, "car", False, False, "{}")]
    row = lambda dataset, split, meta: ((bytearray(png(8, 8, 77)), "p"), "x", dataset, split, "p", 8, 8, "clear", "road", False, o, meta)
    for bad, match in ((row("acdc", "train", "{}"), "row of voc2007/val says acdc/train"), (row("voc2007", "val", "[1]"), "no JSON object in x"), (row("voc2007", "val", '{"a": '), "no JSON object in x")):
        spark.createDataFrame([bad], CANONICAL).write.mode("overwrite").parquet(f"{root}/voc2007/val")
        with pytest.raises(Exception, match=match):
            merge(spark, root, out, False)
        assert not (tmp_path / "out").exists()


def test_records_without_a_hash_stay_apart(spark):
    rows = [(i, "hazydet", "train", i, f"i{i}", 8, 8, None, "s", 1, [("car", 1)], "a") for i in range(2)]
    refs = spark.createDataFrame(rows, REF)
    plan = M.plan_merge(M.lineage(refs), strict=True).collect()
    assert sorted(r["representative_id"] for r in plan) == [0, 1] and {r["n_same"] for r in plan} == {1}


def test_failed_swap_brings_the_old_output_back(spark, tmp_path):
    df, out = spark.range(3).selectExpr("id", "'train' split"), str(tmp_path / "out")
    M.publish(df, out)
    with pytest.raises(ValueError, match="no"):
        M.publish(df, out, force=True, check=lambda d: (_ for _ in ()).throw(ValueError("no")))
    assert spark.read.parquet(out).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["out"]
