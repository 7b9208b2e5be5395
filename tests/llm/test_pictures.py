import random

import numpy as np



from boxlake.functions.headers import picture_size
from boxlake.functions.pictures import content_hash, decode_graymap, thumbnail
from boxlake.llm.pictures import APART, PASSAGES, cross_split_overlaps, near_pairs, normalised, overlap_counts, passages, sketches, spellings
from boxlake.llm.survivors import survivors
from tests.pictures import pgm, png

REFS = "ref_id bigint, dataset string, split string, row_index int, image_id string, width int, height int, content_hash string, source_image_id string, object_count int, class_counts array<struct<class_name:string,n:int>>, annotation_hash string, sequence_id string, scanned_at timestamp, pos int, thumb string, key string"
IMAGES = "image struct<bytes:binary,path:string>, image_id string, picture_hash string, class_id int"


def ref(i, split, image, h=None, dataset="acdc", count=1, classes=("car",), when=0, **more):
    import datetime

    at = datetime.datetime(2025, 1, 1) + datetime.timedelta(days=when)
    row = dict(width=8, height=8, source_image_id=None, annotation_hash=None, sequence_id=None) | more
    return (i, dataset, split, i, image, row["width"], row["height"], h, row["source_image_id"], count, [(c, 1) for c in classes] if classes is not None else None, row["annotation_hash"], row["sequence_id"], at, 0, "t", "k")


def scene(seed):
    rng = np.random.default_rng(seed)
    return np.kron(rng.integers(20, 230, (6, 8)), np.ones((2, 2), int))


def noisy(a, seed, scale=4):
    return np.clip(a + np.random.default_rng(seed).integers(-scale, scale + 1, a.shape), 0, 255)


def tables(spark, refs, images):
    return spark.createDataFrame(refs, REFS), spark.createDataFrame([((None if b is None else bytearray(b), "p"), k, "x", 3) for k, b in images], IMAGES)


def pairs(spark, refs, images):
    out = cross_split_overlaps(*tables(spark, refs, images)).collect()
    return {(r["eval_ref"], r["train_ref"]) for r in out}


def test_formats():
    a = scene(1)
    forms = [pgm(a.tolist()), pgm(a.tolist(), plain=True), pgm((a * 257).tolist(), 65535), pgm(a.tolist(), comment="# made\n"), pgm(np.kron(a, np.ones((2, 2), int)).tolist())]
    for f in forms:
        assert np.allclose(thumbnail(decode_graymap(f)), a / 255)
    assert decode_graymap(b"P5\n4 4\n255\nab") is None and decode_graymap(b"GIF") is None and decode_graymap(None) is None
    odd = thumbnail(np.arange(35.0).reshape(5, 7))
    assert odd.shape == (12, 16) and np.isclose(odd.mean(), 17)
    assert picture_size(png(30, 20)) == (30, 20) and picture_size(forms[4]) == (32, 24) and picture_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x14\x00\x1e") == (30, 20) and picture_size(b"BM") is None


def test_same_and_near(spark):
    a, b, c = scene(1), scene(2), scene(3)
    pa = pgm(a.tolist())
    h = content_hash(pa).hex()
    refs = [
        ref(1, "train", "a"), ref(2, "Validation ", "b", h.upper()), ref(3, "test", "c"), ref(4, "train", "d"), ref(5, "test", "e"), ref(6, "train", "f", f"blake2b:{h}"), ref(7, None, "a"), ref(8, "test", None, None), ref(9, "train", "z"), ref(9, "test", "a", when=-3),
    ]
    refs.append(refs[0])
    images = [("a", pa), ("a", pa), ("c", pgm(noisy(a, 5).tolist(), plain=True)), ("d", pgm(b.tolist())), ("e", pgm(np.clip(b * 0.5 + 60, 0, 255).astype(int).tolist())), ("f", None), ("z", b"broken"), (None, pa), ("q", pgm(c.tolist()))]
    assert pairs(spark, refs, images) == {(2, 1), (2, 6), (3, 1), (3, 6), (5, 4)}
    assert pairs(spark, refs, images[:0]) == {(2, 6)}
    assert pairs(spark, refs[:0], images) == set()


def test_recall_against_all_pairs(spark):
    rng = random.Random(4)
    base = [scene(s) for s in range(60)]
    made = [(i, noisy(base[rng.randrange(60)], i, rng.choice((3, 10, 25)))) for i in range(160)]
    refs = [ref(i, "train" if i % 2 else "val", f"i{i}") for i, _ in made]
    got = pairs(spark, refs, [(f"i{i}", pgm(a.tolist())) for i, a in made])
    z = np.array([a.ravel() - a.mean() for _, a in made], float)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    want = {(i, j) for i in range(0, 160, 2) for j in range(1, 160, 2) if z[i] @ z[j] >= 0.9}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 30


def test_hot_shards_are_cut(spark, monkeypatch):
    import boxlake.llm.pictures as P

    made = [(i, noisy(scene(1), i)) for i in range(24)] + [(i, scene(i)) for i in range(24, 30)]
    refs, images = [ref(i, "train" if i % 3 else "test", f"i{i}") for i, _ in made], [(f"i{i}", pgm(a.tolist())) for i, a in made]
    want = {(i, j) for i in range(0, 24, 3) for j in range(24) if j % 3}
    assert pairs(spark, refs, images) == want
    monkeypatch.setattr(P, "SHARD_ROWS", 5)
    assert pairs(spark, refs, images) == want


def test_flat_pictures_have_no_near_pairs(spark):
    flat = [("a", pgm([[9] * 16] * 12)), ("b", pgm([[7] * 16] * 12))]
    assert pairs(spark, [ref(1, "train", "a"), ref(2, "test", "b")], flat) == set()


def test_passages():
    codes, weak = passages(normalised(scene(1).reshape(1, -1).astype(np.float32))[0], 2)
    rows, spelled = spellings(codes[0], weak[0])
    assert codes.shape == (1, PASSAGES) and len(rows) == 4 * PASSAGES and len({(r, c) for r, c in zip(rows.tolist(), spelled.tolist())}) == len(rows)
    assert all((c ^ codes[0][r]) & ~weak[0][r] == 0 for r, c in zip(rows.tolist(), spelled.tolist()))


def changed(rng, pictures, kind, r):
    """Pictures whose correlation with the given ones is r, by noise of pixels, noise of cells, or light that changes smoothly."""
    n = len(pictures)
    if kind == "pixels":
        noise = rng.standard_normal((n, 12, 16))
    elif kind == "cells":
        noise = np.kron(rng.standard_normal((n, 6, 8)), np.ones((2, 2)))
    else:
        y, x = np.mgrid[0:1:12j, 0:1:16j]
        noise = sum(rng.standard_normal((n, 1, 1)) * f for f in (y, x, x * y, np.cos(3 * x), np.cos(3 * y)))
    z = pictures / np.linalg.norm(pictures, axis=1, keepdims=True)
    e = noise.reshape(n, -1)
    e = e - e.mean(1, keepdims=True)
    e = e - (e * z).sum(1, keepdims=True) * z
    return r * z + np.sqrt(1 - r * r) * e / np.linalg.norm(e, axis=1, keepdims=True)


def passage_recall(rng, pictures, kind, r):
    """The share of changed pictures that meet their original in a passage and by their sketches."""
    a = normalised(pictures.astype(np.float32))[0]
    b = changed(rng, a.astype(float), kind, r).astype(np.float32)
    (codes, weak), (other, _) = passages(a), passages(b, 0)
    met = (((codes ^ other) & ~weak) == 0).any(1)
    apart = np.bitwise_count((sketches(a) ^ sketches(b)).view(np.uint64)).sum(1)
    return float((met & (apart <= APART)).mean())


def test_recall_near_the_threshold():
    rng = np.random.default_rng(6)
    pictures = np.stack([noisy(scene(s), s, 20).ravel() for s in range(800)]).astype(float)
    for kind in ("pixels", "cells", "light"):
        for r in (0.9, 0.91, 0.92, 0.95):
            assert passage_recall(rng, pictures, kind, r) >= 0.97, (kind, r)


def test_one_passage_shared_by_all(spark):
    """50,000 pictures alike in the signs of one passage and otherwise different, and a few true pairs among them."""
    import pandas as pd

    from boxlake.llm.pictures import _TURNED, SIGNS

    rng = np.random.default_rng(9)
    x = rng.standard_normal((50_000, len(_TURNED))).astype(np.float32)
    x[:, :SIGNS] = np.abs(x[:, :SIGNS]) * np.where(np.arange(SIGNS) % 3, 1, -1)
    x[1000:1020] = x[:20] + 0.2 * rng.standard_normal((20, x.shape[1]))
    z = x @ _TURNED
    z = z - z.mean(1, keepdims=True)
    pixels = np.rint(32768 + 6000 * z / z.std(1, keepdims=True)).clip(0, 65535).astype("<u2")
    frame = pd.DataFrame({"class_id": np.arange(50_000), "thumb": [p.tobytes() for p in pixels]})
    classes = spark.createDataFrame(frame, "class_id bigint, thumb binary").selectExpr("*", "class_id >= 1000 as in_train", "class_id < 1000 or class_id >= 25000 as in_eval").repartition(8)
    got = {(r["eval_id"], r["train_id"]) for r in near_pairs(classes).filter("eval_id <> train_id").collect()}
    assert got == {(i, 1000 + i) for i in range(20)}


def test_counts_are_those_of_the_pairs(spark):
    """Copies, records of two classes (bytes and hash of different pictures) and records without a picture."""
    a, b = (pgm(scene(s).tolist()) for s in (1, 2))
    ha, hb = content_hash(a).hex(), content_hash(b).hex()
    refs = [ref(i, "train", "a") for i in range(5)] + [ref(5, "train", "a", hb), ref(6, "test", "b", ha), ref(7, "val", "b"), ref(8, "test", None, ha), ref(9, "train", None, "f" * 64), ref(10, "val", None, "f" * 64), ref(11, "val", "q")]
    t = tables(spark, refs, [("a", a), ("b", b)])
    want = {}
    for r in cross_split_overlaps(*t).collect():
        want.setdefault(r["eval_ref"], set()).add(r["train_ref"])
    got = {r["ref_id"]: r["n_train"] for r in overlap_counts(*t).collect()}
    assert got == {k: len(v) for k, v in want.items()} == {6: 6, 7: 1, 8: 6, 10: 1}


def test_survivors(spark):
    a, b, c = (pgm(scene(s).tolist()) for s in (1, 2, 3))
    h = content_hash(a).hex()
    refs = [
        ref(10, "train", "a", dataset="bdd100k", count=3, classes=("car", "bus"), width=640, sequence_id="s1"), ref(11, "Test", "x", h, dataset="acdc", count=2, classes=("car",), width=640, sequence_id="s1"),
        ref(12, "val", "a", dataset="xwod", count=None, classes=None, width=320), ref(20, "train", "b", count=0, classes=()), ref(21, "test", "b", count=None, classes=None), ref(30, "train", "c"), ref(31, None, None, None),
        ref(12, "val", "a", dataset="xwod", count=9, classes=("dog",) * 9, when=-1),
    ]
    refs.append(refs[0])
    got = survivors(*tables(spark, refs, [("a", a), ("b", b), ("c", c), ("a", a)])).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["group_id"], r["representative_id"], r["donor_id"], r["n_members"]) == (10, 11, 10, 3)
    assert r["width"] == 640 and r["sequence_id"] == "s1" and r["annotation_hash"] is None and "car" in {x["class_name"] for x in r["class_counts"]}
    assert survivors(*tables(spark, refs[:0], [])).count() == 0


def test_survivor_identity(spark):
    data = pgm(scene(1).tolist())
    refs, images = tables(spark, [ref(1, "train", "a"), ref(2, "test", "b", dataset="xwod")], [("a", data), ("b", data)])
    r = survivors(refs.selectExpr("*", "ref_id + 10 row_order"), images).first()
    assert (r["dataset"], r["split"], r["row_index"], r["row_order"], r["image_id"], r["content_hash"]) == ("xwod", "test", 2, 12, "b", content_hash(data).hex())


def test_contradicting_hashes_still_tie(spark):
    a, b = pgm(scene(1).tolist()), pgm(scene(2).tolist())
    refs = [ref(1, "train", "a", content_hash(b).hex()), ref(2, "train", "b"), ref(3, "val", "x", content_hash(b).hex())]
    assert {(r["group_id"], r["n_members"]) for r in survivors(*tables(spark, refs, [("a", a), ("b", b)])).collect()} == {(1, 3)}



def test_quality_finds_the_poor_source(spark):
    from boxlake.llm.survivors import _claims, _facts, source_quality

    rng, rows = random.Random(1), []
    for g in range(150):
        truth = rng.sample(["car", "bus", "dog", "cat"], 2)
        for s in ("good", "good2", "bad"):
            own = truth if s != "bad" or rng.random() < 0.3 else rng.sample(["car", "bus", "dog", "cat"], 2)
            rows.append((g, s, 1, 1, 1, None, None, None, [(c, 1) for c in own]))
    m = spark.createDataFrame(rows, "group_id bigint, dataset string, width int, height int, object_count int, annotation_hash string, source_image_id string, sequence_id string, class_counts array<struct<class_name:string,n:int>>")
    q = {(r["kind"], r["source"]): (r["sensitivity"], r["specificity"]) for r in source_quality(_facts(_claims(m)))[0].collect()}
    assert q["class", "good"][0] > q["class", "bad"][0] + 0.15 and q["class", "good"][1] > q["class", "bad"][1]


def test_model_beats_the_majority(spark):
    """Two good and two poor sources teach the model; then one good source stands against two poor ones that agree."""
    rng, refs, images = random.Random(2), [], []
    truth, values = {}, list(range(1, 7))

    def group(g, claims):
        data = pgm(np.random.default_rng(g).integers(0, 255, (4, 4)).tolist())
        for s, v in claims:
            k = len(refs)
            refs.append(ref(k, "train", f"i{k}", dataset=s, width=v, classes=("car",)))
            images.append((f"i{k}", data))
        return len(refs) - len(claims)

    for g in range(120):
        true = rng.choice(values)
        group(g, [("good", true), ("fine", true), *((s, true if rng.random() < 0.25 else rng.choice(values)) for s in ("poor", "bad"))])
    for g in range(200, 220):
        true, wrong = rng.sample(values, 2)
        truth[group(g, [("good", true), ("poor", wrong), ("bad", wrong)])] = (true, wrong)
    got = {r["group_id"]: r["width"] for r in survivors(*tables(spark, refs, images)).collect()}
    assert sum(got[g] == true for g, (true, _) in truth.items()) >= 19 and len(got) == 140
