"""Decoding, drawing, digests, JSON objects, JSON streams, predictions: small cases with known results."""

import hashlib
import json
import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.functions import drawing as D
from boxlake.functions import geometry as G
from boxlake.functions import pictures as P
from boxlake.functions.digests import annotations_blake2b, blake2b
from boxlake.functions.objects import json_object, object_text, updated
from boxlake.operators import evaluate as E
from boxlake.operators import runs as R
from boxlake.operators import targets as T
from boxlake.sources.json_stream import elements, stream_json


def filtered_png(a, how, colour):
    """A PNG whose lines all use one filter."""
    h, w, c = a.shape
    flat, body, above = a.reshape(h, -1).astype(int), b"", np.zeros(w * c, int)
    for row in flat:
        left, corner = np.concatenate([np.zeros(c, int), row[:-c]]), np.concatenate([np.zeros(c, int), above[:-c]])
        p = left + above - corner
        da, db, dc = abs(p - left), abs(p - above), abs(p - corner)
        guess = [0 * row, left, above, (left + above) // 2, np.where((da <= db) & (da <= dc), left, np.where(db <= dc, above, corner))][how]
        body += bytes([how]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        above = row
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def test_decoding():
    rng = np.random.default_rng(1)
    for c, colour in ((1, 0), (3, 2), (2, 4), (4, 6)):
        a = rng.integers(0, 256, (5, 7, c), np.uint8)
        want = a[..., :3] if c >= 3 else np.repeat(a[..., :1], 3, -1)
        for how in range(5):
            assert (P.rgb_pixels(filtered_png(a, how, colour)) == want).all(), (c, how)
    a = rng.integers(0, 256, (4, 3, 3), np.uint8)
    assert (P.rgb_pixels(D.png_bytes(a)) == a).all() and (P.rgb_pixels(b"P6 3 4 255\n" + a.tobytes()) == a).all()
    line = np.zeros((4, 12), np.uint8)
    line[:, :9] = a[::-1, :, ::-1].reshape(4, 9)
    bmp = b"BM" + struct.pack("<IHHI", 54 + 48, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 3, 4, 1, 24, 0, 48, 0, 0, 0, 0) + line.tobytes()
    assert (P.rgb_pixels(bmp) == a).all()
    for bad in (None, b"", b"\xff\xd8\xff", D.png_bytes(a)[:40], b"P6 9 9 255\nab", b"BM12"):
        assert P.rgb_pixels(bad) is None and P.grey_pixels(bad) is None
    assert np.allclose(P.grey_pixels(b"P5 2 1 255\n\x00\xff"), [[0, 1]]) and P.grey_pixels(D.png_bytes(a)).shape == (4, 3)


def test_drawing(spark):
    p = np.zeros((10, 12, 3), np.uint8)
    D.draw_box(p, (2, 3, 6, 5), (9, 8, 7), 1)
    assert (p[3, 2:8] == (9, 8, 7)).all() and (p[3:8, 2] == (9, 8, 7)).all() and not p[5, 4].any() and not p[0].any()
    D.draw_box(p, (-5, -5, 100, 100), (1, 1, 1))
    assert D.grid([p, p, p], 2).shape == (20, 24, 3) and D.grid([], 2).size == 0
    with pytest.raises(ValueError):
        D.grid([p], 0)
    o = [([1.0, 1.0, 5.0, 5.0], "car", None, "car", False, False, "{}"), ([2.0, 2.0, 5.0, 5.0], "dog", None, None, True, False, "{}"), ([2.0, 2.0, 0.0, 5.0], "x", None, None, False, False, "{}")]
    schema = "image struct<bytes:binary,path:string>, image_id string, objects array<struct<bbox:array<float>,native_label:string,native_label_id:string,meta_label:string,ignore:boolean,iscrowd:boolean,meta_json:string>>, png int"
    rows = spark.createDataFrame([((bytearray(D.png_bytes(np.zeros((10, 12, 3), np.uint8))), "p"), "a", o, 1), ((bytearray(b"x"), "p"), "b", o, 1), ((None, "p"), "c", None, 1)], schema)
    got = {r["image_id"]: r["png"] for r in D.drawn(rows).collect()}
    assert got["b"] is None and got["c"] is None and P.rgb_pixels(bytes(got["a"]))[1, 3].any() and len({tuple(x) for x in P.rgb_pixels(bytes(got["a"])).reshape(-1, 3)}) == 2
    shown = rows.filter("image_id = 'a'").select(F.transform("objects", lambda x: T.drawable(x)).alias("a"), F.transform("objects", lambda x: T.drawable(x, "native", True)).alias("b"), F.transform("objects", lambda x: T.drawable(x, "meta")).alias("c")).first()
    assert (list(shown["a"]), list(shown["b"]), list(shown["c"])) == ([True, False, False], [True, True, False], [True, False, False])


def test_digests(spark):
    df = spark.createDataFrame([(bytearray(b"abc"), "t", [([1.5, 0.1, 2.0, 3.0], False, "car")]), (None, None, [])], "b binary, s string, o array<struct<bbox:array<float>,iscrowd:boolean,meta_label:string>>")
    a, b = df.select(blake2b(F.col("b"), 32).alias("b"), blake2b(F.col("s"), 16).alias("s"), annotations_blake2b(F.col("o")).alias("o")).collect()
    text = json.dumps([{"bbox": [1.5, float(np.float32(0.1)), 2.0, 3.0], "iscrowd": False, "meta_label": "car"}], sort_keys=True, separators=(",", ":"))
    assert a["b"] == hashlib.blake2b(b"abc", digest_size=32).hexdigest() and a["s"] == hashlib.blake2b(b"t", digest_size=16).hexdigest() and a["o"] == hashlib.blake2b(text.encode(), digest_size=16).hexdigest()
    assert b["b"] is None and b["s"] is None and b["o"] == hashlib.blake2b(b"[]", digest_size=16).hexdigest()


def test_json_objects(spark):
    df = spark.createDataFrame([('{"b": [1, {"x": null}], "a\\"q": "é", "k": 1}',), (" ",), (None,), ("{}",)], "t string")
    got = [r[0] for r in df.select(object_text(updated(json_object(F.col("t")), {"k": F.lit("2"), "z": F.lit('{"y":[]}')}))).collect()]
    assert json.loads(got[0]) == {"b": [1, {"x": None}], 'a"q': "é", "k": 2, "z": {"y": []}} and list(json.loads(got[0])) == sorted(json.loads(got[0])) and got[1] == got[2] == got[3] == '{"k":2,"z":{"y":[]}}'
    for bad in ('{"a": ', "[1]", "5", "x"):
        odd = spark.createDataFrame([(bad,)], "t string")
        assert odd.select(object_text(json_object(F.col("t"), strict=False))).first()[0] == "{}"
        with pytest.raises(Exception, match="no JSON object"):
            odd.select(object_text(json_object(F.col("t")))).collect()


def test_json_stream(spark, tmp_path):
    rng = random.Random(1)

    def value(d=0):
        k = rng.randrange(6 if d < 3 else 3)
        return [1, 'a"[{\\,]}x', None][k] if k < 3 else [value(d + 1) for _ in range(rng.randrange(3))] if k < 5 else {f'k{i}"[': value(d + 1) for i in range(rng.randrange(3))}

    for n in range(300):
        doc = {f"l{i}[": [value() for _ in range(rng.randrange(4))] if rng.random() < 0.7 else value() for i in range(rng.randrange(4))} if n % 2 else [value() for _ in range(rng.randrange(5))]
        text, size = json.dumps(doc, indent=rng.choice([None, 2])), rng.choice([1, 2, 3, 7, 1000])
        want = [("", i, v) for i, v in enumerate(doc)] if isinstance(doc, list) else [(k, i, v) for k, x in doc.items() if isinstance(x, list) for i, v in enumerate(x)]
        assert [(a, b, json.loads(c)) for a, b, c in elements(text[i : i + size] for i in range(0, len(text), size))] == want
    for bad in ("5", "[1,2", '{"a":[1', "[1,,2]", "", '"x"', "[1]]"):
        with pytest.raises(ValueError):
            list(elements([bad]))
    (tmp_path / "d.json").write_text(json.dumps({"images": [{"id": i} for i in range(5000)], "info": {"x": [1]}, "annotations": []}))
    got = stream_json(spark, str(tmp_path / "d.json"))
    assert got.count() == 5000 and got.filter("list = 'images' and get_json_object(value, '$.id') = pos").count() == 5000


def test_predictions(spark):
    p = [("car", 0.9, [-1.0, -1.0, 65.0, 65.0]), ("car", 0.9, [1.0, 1.0, 2.0, 2.0]), ("dog", 0.8, [1.0, 1.0, 2.0, 2.0]), ("car", 0.05, [1.0, 1.0, 2.0, 2.0]), ("bus", 0.95, [5.0, 5.0, 1.0, 9.0]), ("bus", 0.5, [1.0, math.nan, 2.0, 3.0]), ("bus", 0.6, [1.0, 2.0, 3.0]), ("bus", 0.7, [40.0, 1.0, 50.0, 2.0]), None]
    rows = spark.createDataFrame([("a", 32, 24, p), ("b", 32, 24, None), ("c", 32, 24, [])], "image_id string, width int, height int, raw array<struct<label:string,score:double,box:array<double>>>")
    got = {r["image_id"]: r for r in T.usable_predictions(rows, "raw", ["car", "bus"], 0.1, 10).collect()}
    assert [tuple(x) for x in got["a"]["predictions"]] == [("car", 0.9, 0.0, 0.0, 32.0, 24.0), ("car", 0.9, 1.0, 1.0, 1.0, 1.0)] and got["a"]["n_invalid"] == 4
    assert got["b"]["predictions"] == [] and got["c"]["n_invalid"] == 0 and len(T.usable_predictions(rows, "raw", ["car"], 0.1, 1).filter("image_id = 'a'").first()["predictions"]) == 1
    counts = E.evaluation_counts(rows, rows.limit(0), T.usable_predictions(rows, "raw", ["car", "bus"], 0.1, 10)).first()
    assert tuple(counts) == (3, 0, 2, 4)
    assert E.required({"m": 0.5}, "m") == 0.5
    for bad in ({}, {"m": None}, {"m": math.nan}):
        with pytest.raises(ValueError, match="missing"):
            E.required(bad, "m")


def test_long_pictures_and_odd_metrics(spark):
    one = spark.createDataFrame([(10_000, 3), (2, 9000)], "w int, h int")
    for mode, target in (("letterbox", (64, 64)), ("shortest_edge", (800, 800))):
        plans = [r[0] for r in one.select(G.resize_plan(F.col("w"), F.col("h"), mode, target, 1333)).collect()]
        assert all(p["scale_x"] > 0 and p["scale_y"] > 0 and p["width"] >= 1 and p["height"] >= 1 for p in plans)
    with pytest.raises(Exception, match="not finite in epoch 2"):
        R.early_stopping(spark.createDataFrame([(1, 1, 0.1), (1, 2, math.nan)], "run int, epoch int, m double"), "run", "epoch", "m").collect()
    j = spark.range(2000).select(G.colour_jitter(F.col("id"), 3, 0.4, 0.5).alias("j")).select("j.*")
    r = j.agg(F.avg(F.col("applied").cast("int")).alias("p"), F.min("brightness").alias("lo"), F.max("brightness").alias("hi"), F.max(F.abs("hue")).alias("hue")).first()
    assert 0.45 < r["p"] < 0.55 and 0.6 <= r["lo"] < 0.65 and 1.35 < r["hi"] <= 1.4 and 0.15 < r["hue"] <= 0.2
    assert j.filter("not applied and (brightness <> 1 or hue <> 0)").count() == 0


def test_collating(spark):
    rows = spark.createDataFrame([(i, f"i{i}", i * 2) for i in range(5)], "ord int, image_id string, width int")
    got = {r["batch"]: (list(r["image_id"]), list(r["width"])) for r in T.collated(rows, "ord", 2, ("image_id", "width")).collect()}
    assert got == {0: (["i0", "i1"], [0, 2]), 1: (["i2", "i3"], [4, 6]), 2: (["i4"], [8])}
