import math

import pytest
from pyspark.sql import functions as F

from boxlake.functions import labels as L
from boxlake.functions.clean import hash_text, split_name, whole_number
from boxlake.operators import evaluate as E
from boxlake.operators import runs as R
from boxlake.operators import splits as S
from boxlake.operators import targets as T
from boxlake.schema import CANONICAL


def col(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_parser_statistics(spark):
    o = lambda n, m, i: ([1.0, 1.0, 4.0, 4.0], n, None, m, i, False, "{}")
    rows = spark.createDataFrame([(None, "i", "d", "val", "p", 9, 9, "c", "d", None, [o("car", "car", True), o("dog", None, False), o("dog", "dog", False)], "{}")], CANONICAL)
    s = T.filtering_stats(rows, ["car"]).first().asDict()
    assert s == {"total": 3, "ignored": 1, "missing_label": 1, "not_in_classes": 1, "invalid_bbox": 0, "kept": 0}
    assert T.parse_targets(rows, ["car"]).first()["targets"] == []
    with pytest.raises(ValueError):
        T.class_index(F.lit("a"), ["a", "a"])


def test_heads_and_batches(spark):
    t = F.array(F.struct(F.lit(0).alias("label_id"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("w"), F.lit(4.0).alias("h"), F.lit(False).alias("iscrowd")))
    assert col(spark, T.head_targets(t, "roi"))[0]["label"] == 1 and col(spark, T.head_targets(t, "anchor"))[0]["label"] == 0
    rows = spark.range(2).select(F.col("id").alias("n"), F.lit(10).alias("width"), F.lit(10).alias("height"), F.when(F.col("id") == 1, t).otherwise(F.array()).alias("targets"))
    assert [r["batch_idx"] for r in T.batched_boxes(rows, "n", 2).collect()] == [1]
    p = F.array(*[F.struct(F.lit(s).alias("score"), F.lit(i).alias("i")) for i, s in enumerate((0.5, 0.9, 0.9, 0.1))])
    assert [x["i"] for x in col(spark, T.top_predictions(p, 0.2, 2))] == [1, 2]


TRUTH = "image_id string, label string, x double, y double, w double, h double, iscrowd boolean, pos int"
PRED = "image_id string, label string, score double, x double, y double, w double, h double, pos int"


def scored(spark, truth, preds, images, classes=("car",), most=300):
    r = E.evaluate(spark.createDataFrame(truth, TRUTH), spark.createDataFrame(preds, PRED), spark.createDataFrame(images, "image_id string, ord bigint, condition string, domain string"), list(classes), most)
    return {(x["scope"], x["grp"], x["metric"]): x["value"] for x in r.collect()}, r


def test_perfect_and_empty(spark):
    truth, image = [("i", "car", 4.0, 5.0, 8.0, 10.0, False, 0)], [("i", 0, "clear", "general")]
    r, df = scored(spark, truth, [("i", "car", 0.9, 4.0, 5.0, 8.0, 10.0, 0), ("other", "car", 0.9, 0.0, 0.0, 1.0, 1.0, 0), ("i", "cat", 0.9, 0.0, 0.0, 1.0, 1.0, 1)], image)
    assert r["overall", "", "map_50_95"] > 0.9 and ("overall", "", "ar_300") in r and ("overall", "", "ap_medium") not in r
    assert ("class", "car", "map_50") in r and ("condition", "clear", "map_50") in r and ("domain", "general", "map_50") in r and r["size", "small", "ap"] > 0.9
    assert E.require_metric(df, "map_50") > 0.9
    with pytest.raises(ValueError, match="missing_metric"):
        E.require_metric(df, "missing_metric")
    r, _ = scored(spark, truth, [], image)
    assert r["overall", "", "map_50_95"] == 0 and ("overall", "", "ap_small") not in r and len([k for k in r if k[0] == "overall"]) == 6


@pytest.mark.parametrize(("most", "want"), [(100, 84 / 101), (300, 1.0)])
def test_dense_scene(spark, most, want):
    cell = [(float(k % 12 * 10), float(k // 12 * 10)) for k in range(120)]
    r, _ = scored(spark, [("i", "car", x, y, 5.0, 5.0, False, k) for k, (x, y) in enumerate(cell)], [("i", "car", 1 - 0.001 * k, x, y, 5.0, 5.0, k) for k, (x, y) in enumerate(cell)], [("i", 0, "clear", "general")], most=most)
    assert math.isclose(r["overall", "", "map_50_95"], want, rel_tol=1e-9)


def test_early_stopping(spark):
    rows = [(1, e, 0.2 if e == 1 else 0.2005) for e in range(1, 15)] + [(2, 1, 0.3), (2, 2, 0.3005)]
    r = {x["run"]: x for x in R.early_stopping(spark.createDataFrame(rows, "run int, epoch int, m double"), "run", "epoch", "m").collect()}
    assert (r[1]["stop_epoch"], r[1]["best_epoch"]) == (10, 1) and (r[2]["stop_epoch"], r[2]["best_epoch"], r[2]["top_epoch"]) == (None, 1, 2)


def test_schedule_and_trials(spark):
    f = lambda s: col(spark, R.warmup_cosine(F.lit(s), 101, 5050, 0.01))
    assert f(101) == 1.0 and math.isclose(f(5050), 0.01) and f(0) == 0
    t = spark.createDataFrame([(0, None), (1, 0.3), (2, 0.2), (3, 0.3)], "trial int, m double")
    assert tuple(R.best_trial(t, "trial", "m").first()) == (1, 0.3)
    b = lambda v: col(spark, R.boundary(F.lit(v), 3e-6, 3e-3))
    assert (b(3e-6), b(math.sqrt(3e-6 * 3e-3)), b(3e-3)) == ("lower", None, "upper")


def test_seed_aggregate(spark):
    rows = [(0, "val", 2.0), (1, "val", 4.0), (2, "val", None), (0, "only", 1.0)]
    r = R.seed_aggregate(spark.createDataFrame(rows, "seed int, metric string, v double"), "seed", "metric", "v").collect()
    assert len(r) == 1 and r[0]["mean"] == 3.0 and math.isclose(r[0]["std"], math.sqrt(2)) and r[0]["values"] == [2.0, 4.0]
    one = R.seed_aggregate(spark.createDataFrame([(0, "test", 2.0)], "seed int, metric string, v double"), "seed", "metric", "v").first()
    assert one["std"] == 0.0


def test_flatten(spark):
    e = spark.createDataFrame([("class", "big car", "map_50", 0.5), ("condition", "low light", "map_50", 0.1), ("overall", "", "map_50", float("nan"))], "scope string, grp string, metric string, value double")
    assert {r["key"] for r in R.flattened(e, "eval/test").collect()} == {"eval/test/per_class/big_car/map_50", "eval/test/per_condition/low_light/map_50"}
    log = spark.createDataFrame([(1, {"step": "2", "loss": "1.5", "name": "x", "bad": "1d"}), (2, {"epoch": "3", "train/box_loss": "1.5", "lr/pg0": "0.01"})], "e int, m map<string,string>")
    assert {r["key"] for r in R.flattened_log(log, "e", "m", "train", True).collect()} == {"train/loss", "train/epoch", "train/box_loss", "train/lr/pg0"}
    assert [r[0] for r in log.select(R.log_step(F.col("m"))).collect()] == [2, 3]


def test_digest_split(spark):
    files = [(f"image-{i}", bytearray(f"{i}".encode())) for i in range(20)] + [("copy", bytearray(b"0"))]
    df = spark.createDataFrame(files, "name string, content binary")
    a, b = ({r["name"]: r["split"] for r in S.digest_split(df, "content").collect()} for _ in range(2))
    assert a == b and len(a) == 21 and set(a.values()) == {"train", "val", "test"} and a["copy"] == a["image-0"]


def test_cleaning(spark):
    values = {" TRAIN\t": "train", "validation": "val", "Testing": "test", "": None, None: None, "other": None}
    for v, want in values.items():
        assert col(spark, split_name(F.lit(v).cast("string"))) == want
    for v, want in {" 007 ": "7", "77.0": "77", "-9": None, "n/a": None, "0": "0", "00": "0", "1e3": None, "12\t": "12"}.items():
        assert col(spark, whole_number(F.lit(v))) == want
    h = "ab" * 32
    for v in (h, h.upper(), f"blake2b:{h}", f" {h} "):
        assert col(spark, hash_text(F.lit(v))) == h
    assert col(spark, hash_text(F.lit("ab" * 31))) is None
    assert col(spark, L.sanitised(F.lit("__A b/c__"))) == "a_b_c" and col(spark, L.named_or_unknown(F.lit(" "))) == "unknown"
