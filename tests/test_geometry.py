import math

import pytest
from pyspark.sql import functions as F

from boxlake.functions import geometry as G


def value(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def lit_box(*v):
    return G.box(*[F.lit(float(x)) for x in v])


def tup(r):
    return None if r is None else tuple(round(v, 6) for v in (r["x"], r["y"], r["w"], r["h"]))


def test_policies(spark):
    w, h = F.lit(16), F.lit(16)
    apply = lambda b, p: tup(value(spark, G.apply_policy(lit_box(*b), w, h, p)))
    assert apply((-1, 1, 9, 8), "clip") == (0, 1, 8, 8)
    assert apply((-1, 1, 9, 8), "drop") is None
    assert apply((1, 1, 4, 4), "strict") == (1, 1, 4, 4)
    assert apply((1, 1, 0, 4), "clip") is None
    assert apply((20, 20, 4, 4), "clip") is None
    assert apply((float("nan"), -1, 4, 4), "drop") is None
    for b, p in (((-1, 1, 9, 8), "strict"), ((1, 1, 0, 4), "strict"), ((float("nan"), 1, 4, 4), "clip"), ((float("nan"), 1, 4, 4), "drop")):
        with pytest.raises(Exception):
            apply(b, p)
    with pytest.raises(ValueError):
        G.apply_policy(lit_box(1, 1, 1, 1), w, h, "other")
    short = F.array(F.lit(1.0), F.lit(2.0))
    assert value(spark, G.apply_policy(G.from_array(short), w, h, "clip")) is None


@pytest.mark.parametrize(
    ("bbox", "size", "want"),
    [((3109.10009765625, 1101.824951171875, 730.9000244140625, 485.0), (3840, 2160), "w"), ((0.005, 38.86000061035156, 1268.57, 681.1400146484375), (1280, 720), "h"), ((3109.1, 1101.8, 731.0, 485.0), (3840, 2160), "exceeds")],
)
def test_float32_clip(spark, bbox, size, want):
    b, w, h = lit_box(*bbox), F.lit(size[0]), F.lit(size[1])
    got, status = value(spark, G.checked(b, w, h)), value(spark, G.checked_status(b, w, h))
    if want == "exceeds":
        assert got is None and status == "exceeds"
        return
    assert status is None
    if want == "w":
        assert got["x"] + got["w"] == size[0]
    else:
        assert got["y"] + got["h"] <= size[1] and math.isclose(got["h"], 681.1399536132812)


def test_resize(spark):
    plan = lambda w, h, *a: value(spark, G.resize_plan(F.lit(w), F.lit(h), *a))
    move = lambda *a: tup(value(spark, G.resized(lit_box(4, 5, 8, 10), G.resize_plan(F.lit(32), F.lit(24), *a))))
    assert move("letterbox", (64, 64)) == (8, 18, 16, 20)
    assert move("exact", (80, 60)) == (10, 12.5, 20, 25)
    p = plan(2000, 1000, "shortest_edge", (800, 800), 1333)
    assert (p["width"], p["height"]) == (1333, 666)
    p = plan(1000, 2000, "shortest_edge", (800, 800), 1333)
    assert (p["width"], p["height"]) == (666, 1333)
    flipped = G.flipped(G.resized(lit_box(4, 5, 8, 10), G.resize_plan(F.lit(32), F.lit(24), "letterbox", (32, 32))), F.lit(32))
    assert tup(value(spark, flipped)) == (20, 9, 8, 10)


def test_round_trip(spark):
    sizes = [(480, 960), (1920, 1080), (640, 640), (17, 31), (31, 17), (853, 481)]
    df = spark.createDataFrame(sizes, "w int, h int").withColumn("p", G.resize_plan(F.col("w"), F.col("h"), "letterbox", (640, 640)))
    df = df.withColumn("b", G.box(F.lit(2), F.lit(3), F.lit(9), F.lit(8))).withColumn("f", G.resized(F.col("b"), F.col("p"))).withColumn("r", G.restored(F.col("f"), F.col("p"), F.col("w"), F.col("h")))
    for r in df.collect():
        assert all(abs(r["r"][k] - r["b"][k]) < 1e-2 for k in "xywh")


def test_predictions(spark):
    plan = G.resize_plan(F.lit(32), F.lit(24), "letterbox", (64, 64))
    canon = lambda *v: tup(value(spark, G.canonical_prediction(F.array(*[F.lit(float(x)) for x in v]), plan, F.lit(32), F.lit(24))))
    assert canon(-1, -1, 65, 65) == (0, 0, 32, 24)
    for bad in ((1, 2, 3), (9, 1, 2, 5), (1, 9, 5, 2), (3, 3, 3, 9), (70, 70, 80, 80), (float("nan"), 1, 2, 3), (1, 1, float("inf"), 3)):
        assert canon(*bad) is None
