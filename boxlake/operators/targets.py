"""Training targets from canonical rows, predictions from a model, and the shapes that trainers take."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions.labels import label, named_or_unknown

#: Label offsets of detector heads: region heads keep 0 for the background.
HEAD_OFFSETS = {"roi": 1, "anchor": 0}
REASONS = ("ignored", "missing_label", "not_in_classes", "invalid_bbox", "kept")


def class_index(name: Column, classes: list[str]) -> Column:
    """The position of a class in the list; null if it is not there."""
    if len(set(classes)) != len(classes) or not classes or any(not c.strip() for c in classes):
        raise ValueError("classes must be non-empty, unique and not blank")
    out = F.lit(None).cast("int")
    for i, c in enumerate(classes):
        out = F.when(name == c, F.lit(i)).otherwise(out)
    return out


def target_status(o: Column, classes: list[str], mode: str = "meta") -> Column:
    """Why an object becomes no target, tested in order; 'kept' if it does. A NaN coordinate passes, as comparisons with it are false."""
    name = label(o, mode)
    b = G.from_array(o["bbox"])
    bad = lambda v, zero_too: ~F.isnan(v) & ((v <= 0) if zero_too else (v < 0))
    invalid = b.isNull() | bad(b["x"], False) | bad(b["y"], False) | bad(b["w"], True) | bad(b["h"], True)
    return (
        F.when(o.isNull() | F.coalesce(o["ignore"], F.lit(False)), "ignored").when(F.coalesce(name, F.lit("")) == "", "missing_label")
        .when(~name.isin(*classes), "not_in_classes").when(invalid, "invalid_bbox").otherwise("kept")
    )


def parse_targets(rows: DataFrame, classes: list[str], mode: str = "meta") -> DataFrame:
    """rows with `targets` (array<struct<label, label_id, x, y, w, h, iscrowd>>) instead of objects; pixels are not read."""
    objects = F.filter(F.coalesce("objects", F.array()), lambda o: target_status(o, classes, mode) == "kept")

    def target(o: Column) -> Column:
        b = G.from_array(o["bbox"])
        return F.struct(label(o, mode).alias("label"), class_index(label(o, mode), classes).alias("label_id"), b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h"), F.coalesce(o["iscrowd"], F.lit(False)).alias("iscrowd"))

    return rows.withColumn("targets", F.transform(objects, target)).drop("objects")


def filtering_stats(rows: DataFrame, classes: list[str], mode: str = "meta", by: tuple[str, ...] = ()) -> DataFrame:
    """How many objects became targets, and why the others did not."""
    o = rows.select(*by, F.explode("objects").alias("o")).select(*by, target_status(F.col("o"), classes, mode).alias("s"))
    return o.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("s") == r).alias(r) for r in REASONS])


def coco_annotations(targets: Column) -> Column:
    """Annotations with ids from 0, contiguous categories, area and a numeric crowd flag."""
    return F.transform(targets, lambda t, i: F.struct(i.alias("id"), t["label_id"].alias("category_id"), F.array(t["x"], t["y"], t["w"], t["h"]).alias("bbox"), (t["w"] * t["h"]).alias("area"), t["iscrowd"].cast("int").alias("iscrowd")))


def head_targets(targets: Column, head: str) -> Column:
    """Corners, offset labels, areas and crowd flags for a detector head ('roi' or 'anchor')."""
    offset = HEAD_OFFSETS[head]
    return F.transform(targets, lambda t: F.struct(F.array(t["x"], t["y"], t["x"] + t["w"], t["y"] + t["h"]).alias("box"), (t["label_id"] + offset).alias("label"), (t["w"] * t["h"]).alias("area"), t["iscrowd"].cast("int").alias("iscrowd")))


def batched_boxes(rows: DataFrame, order: str, size: int) -> DataFrame:
    """(batch, batch_idx, cls, cx, cy, w, h): normalised boxes with their picture's place in a batch of `size` rows.

    `order` is a dense row number from 0, so a batch is arithmetic and no window is needed.
    """
    t = rows.select(F.floor(F.col(order) / size).alias("batch"), (F.col(order) % size).cast("int").alias("batch_idx"), "width", "height", F.explode("targets").alias("t"))
    n = G.normalised_centre(G.box(F.col("t.x"), F.col("t.y"), F.col("t.w"), F.col("t.h")), F.col("width"), F.col("height"))
    t = t.select("batch", "batch_idx", F.col("t.label_id").alias("cls"), n.alias("n"))
    return t.select("batch", "batch_idx", "cls", *[F.col("n")[i].alias(c) for i, c in enumerate(("cx", "cy", "w", "h"))])


def collated(rows: DataFrame, order: str, size: int, columns: tuple[str, ...]) -> DataFrame:
    """(batch, one list per column): samples of a batch of `size` rows as parallel lists, in their order."""
    held = rows.select(F.floor(F.col(order) / size).alias("batch"), F.struct(order, *columns).alias("s"))
    sorted_ = held.groupBy("batch").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return sorted_.select("batch", *[F.col("s").getField(c).alias(c) for c in columns])


def transform_of(preprocess: dict, augmentation: dict | None = None, seed: int = 0) -> Callable[[DataFrame], DataFrame]:
    """The transformation of rows with targets that an experiment's preprocess and augmentation sections describe.

    Only the policies 'basic' and 'weather' flip and jitter; 'none' and 'provider' leave pictures as they are.
    """
    from boxlake.plans.experiments import check_preprocess

    p, a = check_preprocess(dict(preprocess)), augmentation or {}
    on = a.get("policy", "none") in ("basic", "weather")
    mode = p["resize_mode"]
    target = (p["shortest_edge"], p["shortest_edge"]) if mode == "shortest_edge" else (p["width"], p["height"])
    flip, strength, chance = (float(a.get(k, 0.0)) if on else 0.0 for k in ("horizontal_flip_p", "color_jitter_strength", "color_jitter_p"))

    def run(rows: DataFrame) -> DataFrame:
        out = transformed(rows, mode, target, p.get("longest_edge"), flip, seed)
        return out.withColumn("jitter", G.colour_jitter(F.col("image_id"), seed, strength, chance))

    return run


def transformed(rows: DataFrame, mode: str, target: tuple[int, int], longest: int | None = None, flip: float = 0.0, seed: int = 0) -> DataFrame:
    """rows with targets moved into the resized (and perhaps flipped) picture; boxes that fall outside are dropped."""
    out = rows.withColumn("resize", G.resize_plan(F.col("width"), F.col("height"), mode, target, longest)).withColumn("flip", G.flip_coin(F.col("image_id"), seed, flip))
    moved = F.transform("targets", lambda t: t.withField("b", G.resized(G.box(t["x"], t["y"], t["w"], t["h"]), F.col("resize"))))
    out = out.withColumn("targets", moved)
    turned = F.transform("targets", lambda t: t.withField("b", F.when(F.col("flip"), G.flipped(t["b"], F.col("resize.width"))).otherwise(t["b"])))
    out = out.withColumn("targets", turned)
    cut = F.filter(F.transform("targets", lambda t: t.withField("b", G.clipped(t["b"], F.col("resize.width"), F.col("resize.height")))), lambda t: t["b"].isNotNull())
    out = out.withColumn("targets", cut)
    return out.withColumn("targets", F.transform("targets", lambda t: t.withField("x", t["b"]["x"]).withField("y", t["b"]["y"]).withField("w", t["b"]["w"]).withField("h", t["b"]["h"]).dropFields("b")))


def top_predictions(predictions: Column, confidence: float, most: int) -> Column:
    """Predictions of `confidence` or more, best first, at most `most`; equal scores keep their order."""
    kept = F.filter(predictions, lambda p: p["score"] >= confidence)
    keyed = F.transform(kept, lambda p, i: F.struct((-p["score"]).alias("k"), i.alias("i"), p.alias("p")))
    return F.transform(F.slice(F.array_sort(keyed), 1, most), lambda k: k["p"])


def usable_predictions(rows: DataFrame, raw: str, classes: list[str], confidence: float, most: int) -> DataFrame:
    """(image_id, predictions, n_invalid) of rows with an array<struct<label, score, box>> column of corners in pixels.

    In this order: predictions below `confidence` are dropped, then those of no known class, then those whose box is not
    four finite corners with an area inside the picture, which n_invalid counts; the best `most` of the rest remain, equal
    scores in their order. Rows need image_id, width and height; null arrays and null entries hold nothing.
    """
    known = F.filter(F.coalesce(F.col(raw), F.array()), lambda p: F.coalesce((p["score"] >= confidence) & p["label"].isin(*classes), F.lit(False)))
    checked = F.transform(known, lambda p: F.struct(p["label"].alias("label"), p["score"].cast("double").alias("score"), G.canonical_corners(p["box"], F.col("width"), F.col("height")).alias("b")))
    df = rows.select("image_id", checked.alias("c"))
    fine = F.filter("c", lambda p: p["b"].isNotNull())
    plain = F.transform(fine, lambda p: F.struct(p["label"].alias("label"), p["score"].alias("score"), *[p["b"][k].alias(k) for k in "xywh"]))
    return df.select("image_id", top_predictions(plain, confidence, most).alias("predictions"), F.size(F.filter("c", lambda p: p["b"].isNull())).alias("n_invalid"))


def drawable(o: Column, mode: str = "native", draw_ignored: bool = False, draw_crowd: bool = True) -> Column:
    """Whether an object is drawn: it has a label of the mode and a box of area, and is not left out as ignored or crowd."""
    b = G.from_array(o["bbox"])
    shown = (F.coalesce(label(o, mode), F.lit("")) != "") & b.isNotNull() & (b["w"] > 0) & (b["h"] > 0)
    return F.coalesce(shown, F.lit(False)) & (F.lit(draw_ignored) | ~F.coalesce(o["ignore"], F.lit(False))) & (F.lit(draw_crowd) | ~F.coalesce(o["iscrowd"], F.lit(False)))


PREDICTIONS = "array<struct<label:string,score:double,x:double,y:double,w:double,h:double>>"


def predict(rows: DataFrame, predictor: Callable[[pd.DataFrame], pd.Series], columns: tuple[str, ...]) -> DataFrame:
    """(image_id, predictions) from a predictor that maps Arrow batches of `columns` to lists of predictions.

    The predictor is the seam for a model: it is called once per batch in the Python workers.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"image_id": b["image_id"], "predictions": predictor(b)})

    return rows.select("image_id", *[c for c in columns if c != "image_id"]).mapInPandas(run, f"image_id string, predictions {PREDICTIONS}")


def sample_groups(rows: DataFrame) -> DataFrame:
    """image_id with its condition and domain as evaluation groups them."""
    return rows.select("image_id", named_or_unknown(F.col("condition")).alias("condition"), named_or_unknown(F.col("domain")).alias("domain"))
