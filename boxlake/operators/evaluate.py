"""Average precision and recall of detections by the rules of the COCO benchmark.

Matching is local to one picture and class: its detections and objects become one row, and an Arrow function matches
them greedily for ten overlap thresholds and four area ranges at once, leaving two bit masks per detection. Accumulation
is global per class: detections are range-partitioned in score order, running counts are made from the counts of the
partitions before, and precision at a recall threshold is the greatest precision at or beyond it, which is a maximum
per recall bucket. No class is ever gathered in one task, and one pass serves every scope (overall, per class,
condition, domain, size).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxlake.runtime import written

# Overlap thresholds, recall thresholds, area ranges (both ends included).
OVERLAPS = np.linspace(0.5, 0.95, 10)
RECALLS = np.linspace(0.0, 1.0, 101)
AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}
_BITS = len(OVERLAPS) * len(AREAS)


def match(boxes: np.ndarray, objects: np.ndarray, crowd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matched, ignored, counted): per detection and (area, overlap) whether it matched and is ignored; objects per area.

    boxes: detections (n, 4) by falling score. Each takes the free object of the greatest overlap from the threshold on
    (later objects win ties, a crowd region is never used up), one that counts before one that does not. Objects that
    are crowds or outside the area range do not count, nor do unmatched detections outside it.
    """
    n, m = len(boxes), len(objects)
    area_d, area_g = boxes[:, 2] * boxes[:, 3], objects[:, 2] * objects[:, 3]
    over = np.zeros((n, m))
    if n and m:
        iw = np.minimum(boxes[:, None, 0] + boxes[:, None, 2], objects[None, :, 0] + objects[None, :, 2]) - np.maximum(boxes[:, None, 0], objects[None, :, 0])
        ih = np.minimum(boxes[:, None, 1] + boxes[:, None, 3], objects[None, :, 1] + objects[None, :, 3]) - np.maximum(boxes[:, None, 1], objects[None, :, 1])
        inter = np.clip(iw, 0, None) * np.clip(ih, 0, None)
        union = np.where(crowd[None, :], area_d[:, None], area_d[:, None] + area_g[None, :] - inter)
        over = np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)
    matched, ignored = np.zeros((n, _BITS), bool), np.zeros((n, _BITS), bool)
    lo, hi = np.array([v[0] for v in AREAS.values()]), np.array([v[1] for v in AREAS.values()])
    off = crowd[None, :] | (area_g[None, :] < lo[:, None]) | (area_g[None, :] > hi[:, None])
    counted = (~off).sum(1).astype(np.int64)
    each = len(OVERLAPS)
    ignored[:] = np.repeat((area_d[:, None] < lo) | (area_d[:, None] > hi), each, 1)
    # One row of `free` and `off` per area and threshold: a detection is matched for all of them at once.
    off = np.repeat(off, each, 0)
    least = np.tile(np.minimum(OVERLAPS, 1 - 1e-10), len(AREAS))
    free = np.ones((_BITS, m), bool)
    rows = np.arange(_BITS)
    # Only objects that overlap enough for the lowest threshold can ever be taken; the last of equal overlaps wins.
    for d in np.flatnonzero((over >= OVERLAPS[0] - 1e-9).any(1)) if m else ():
        near = np.flatnonzero(over[d] >= OVERLAPS[0] - 1e-9)[::-1]
        may = (over[d, near][None, :] >= least[:, None]) & (free[:, near] | crowd[near][None, :])
        if len(near) == 1:
            hit, at, found_off = may[:, 0], np.zeros(_BITS, np.int64), off[:, near[0]]
        else:
            counts = may & ~off[:, near]
            some = counts.any(1)
            may = np.where(some[:, None], counts, may)
            hit, found_off = may.any(1), ~some
            at = np.where(may, over[d, near][None, :], -1.0).argmax(1)
        free[rows[hit], near[at[hit]]] = False
        matched[d] = hit
        ignored[d] = np.where(hit, found_off, ignored[d])
    return matched, ignored, counted


def _masks(bits: np.ndarray) -> np.ndarray:
    return bits.astype(np.int64) @ (1 << np.arange(_BITS, dtype=np.int64))


def _unmasked(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(_BITS, dtype=np.int64)) & 1


def matched_detections(truth: DataFrame, predictions: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(detections, counts) of matching per picture and class.

    truth: (image_id, ord, label, x, y, w, h, iscrowd, pos), predictions: (image_id, label, score, x, y, w, h, pos).
    detections: (image_id, label, score, pos, matched, ignored) of the `most` best per picture and class, pos by rank;
    counts: (image_id, label, n_all, n_small, n_medium, n_large). Ties in score keep the order of pos.
    """
    box = lambda *more: F.struct(*more, "x", "y", "w", "h")
    d = predictions.groupBy("image_id", "label").agg(F.slice(F.array_sort(F.collect_list(box((-F.col("score")).alias("k"), "pos"))), 1, most).alias("d"))
    g = truth.groupBy("image_id", "label").agg(F.array_sort(F.collect_list(box("pos", F.col("iscrowd").cast("int").alias("c")))).alias("g"))
    both = g.join(d, ["image_id", "label"], "full")
    flat = lambda c, fields: F.flatten(F.transform(c, lambda e: F.array(*[e[f].cast("double") for f in fields])))
    both = both.select("image_id", "label", F.coalesce(flat("d", ("x", "y", "w", "h", "k")), F.array().cast("array<double>")).alias("d"), F.coalesce(flat("g", ("x", "y", "w", "h", "c")), F.array().cast("array<double>")).alias("g"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for image, name, d, g in zip(b["image_id"], b["label"], b["d"], b["g"], strict=True):
                d, g = np.asarray(d, float).reshape(-1, 5), np.asarray(g, float).reshape(-1, 5)
                hit, off, n = match(d[:, :4], g[:, :4], g[:, 4] > 0)
                scores, hit, off = -d[:, 4], _masks(hit), _masks(off)
                rows.append((image, name, scores, hit, off, n))
            yield pd.DataFrame(rows, columns=["image_id", "label", "score", "matched", "ignored", "counted"])

    out = written(both.mapInPandas(run, "image_id string, label string, score array<double>, matched array<bigint>, ignored array<bigint>, counted array<bigint>"), "matched")
    det = out.select("image_id", "label", F.posexplode(F.arrays_zip("score", "matched", "ignored")).alias("pos", "z")).select("image_id", "label", "pos", "z.score", "z.matched", "z.ignored")
    counts = out.select("image_id", "label", *[F.col("counted")[i].alias(f"n_{a}") for i, a in enumerate(AREAS)])
    return det, counts


def _scoped(df: DataFrame, images: DataFrame) -> DataFrame:
    """df once for each scope of its picture: overall, its condition and its domain."""
    scopes = F.array(F.struct(F.lit("overall").alias("scope"), F.lit("").alias("grp")), F.struct(F.lit("condition").alias("scope"), F.col("condition").alias("grp")), F.struct(F.lit("domain").alias("scope"), F.col("domain").alias("grp")))
    return df.join(images.select("image_id", "ord", "condition", "domain"), "image_id").withColumn("__s", F.explode(scopes)).select("__s.*", *[c for c in df.columns], "ord")


_KEYS = ["scope", "grp", "label"]


#: Detections whose running counts are held at once.
_CHUNK = 20_000


def _groups(pdf: pd.DataFrame) -> Iterator[tuple[tuple[str, str, str], pd.DataFrame]]:
    """((scope, grp, label), rows): the detections of a partition by class, and of each class by condition and domain."""
    for name, own in pdf.groupby("label", sort=False):
        yield ("overall", "", name), own
        for scope in ("condition", "domain"):
            for grp, part in own.groupby(scope, sort=False):
                yield (scope, grp, name), part


def _true_false(own: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(rows, 40) true and false detections; ignored ones are neither."""
    hit, off = _unmasked(own["matched"].to_numpy(np.int64)), _unmasked(own["ignored"].to_numpy(np.int64))
    return hit & (1 - off), (1 - hit) & (1 - off)


def curves(detections: DataFrame, counts: DataFrame, images: DataFrame, most: int) -> DataFrame:
    """(scope, grp, label, area, cap, overlap, n_objects, precision, recall): mean precision over the recall thresholds, and final recall.

    images: (image_id, ord, condition, domain). Classes without counted objects in a scope have no row. Every detection
    is sorted once, by class and score; the scopes are parts of that order.
    """
    caps = sorted({1, 10, most})
    spark = detections.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    order = ["label", F.col("score").desc(), "ord", "pos"]
    d = detections.join(images.select("image_id", "ord", "condition", "domain"), "image_id")
    d = d.repartitionByRange(int(parts), *order).withColumn("part", F.spark_partition_id())
    d = written(d, "ordered")

    def totals(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, part = [], int(pdf["part"].iloc[0])
        for key, own in _groups(pdf):
            for cap in caps:
                kept = own[own["pos"] < cap]
                if len(kept):
                    t, f = np.zeros(_BITS, np.int64), np.zeros(_BITS, np.int64)
                    for i in range(0, len(kept), _CHUNK):
                        true, false = _true_false(kept.iloc[i : i + _CHUNK])
                        t, f = t + true.sum(0), f + false.sum(0)
                    rows.append((*key, part, cap, t, f))
        return pd.DataFrame(rows, columns=[*_KEYS, "part", "cap", "t", "f"])

    sums = d.groupBy("part").applyInPandas(totals, "scope string, grp string, label string, part int, cap int, t array<bigint>, f array<bigint>")
    sums = sums.select(*_KEYS, "part", "cap", F.posexplode(F.arrays_zip("t", "f")).alias("bit", "z")).select(*_KEYS, "part", "cap", "bit", "z.t", "z.f")
    before = Window.partitionBy(*_KEYS, "cap", "bit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*_KEYS, "part", "cap", "bit", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"), F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f"))
    offsets = offsets.groupBy(*_KEYS, "part").agg(F.array_sort(F.collect_list(F.struct("cap", "bit", "t", "f"))).alias("o"))
    needed = _scoped(counts, images).groupBy(*_KEYS).agg(*[F.sum(f"n_{a}").alias(f"n_{a}") for a in AREAS])
    needed = written(needed.withColumn("n", F.array(*[f"n_{a}" for a in AREAS])).select(*_KEYS, "n"), "counted")
    starts = offsets.join(needed, _KEYS)

    def buckets(key, pdf: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        rows = []
        start = {tuple(r[k] for k in _KEYS): r for r in given.to_dict("records")}
        pdf = pdf.sort_values(["label", "score", "ord", "pos"], ascending=[True, False, True, True], kind="stable")
        bits = np.arange(_BITS)
        for name, own in _groups(pdf):
            r = start.get(name)
            if r is None:
                continue
            base = {(o["cap"], o["bit"]): (o["t"], o["f"]) for o in r["o"]}
            n = np.repeat(np.array([int(v) for v in r["n"]]), len(OVERLAPS))
            for cap in caps:
                kept = own[own["pos"] < cap]
                if not len(kept):
                    continue
                t, f = (np.array([base.get((cap, bit), (0, 0))[k] for bit in range(_BITS)], np.int64) for k in (0, 1))
                best, top = np.full((len(RECALLS), _BITS), -1.0), np.zeros(_BITS)
                for i in range(0, len(kept), _CHUNK):
                    true, false = _true_false(kept.iloc[i : i + _CHUNK])
                    true, false = np.cumsum(true, 0) + t, np.cumsum(false, 0) + f
                    t, f = true[-1], false[-1]
                    recall, precision = true / np.maximum(n, 1), true / (true + false + np.spacing(1))
                    slot = np.searchsorted(RECALLS, recall.ravel(), "right").reshape(recall.shape) - 1
                    np.maximum.at(best, (slot.ravel(), np.tile(bits, len(slot))), precision.ravel())
                    top = np.maximum(top, recall.max(0))
                for s, bit in zip(*np.nonzero((best >= 0) & (n > 0)), strict=True):
                    rows.append((*name, cap, int(bit), int(n[bit]), int(s), float(best[s, bit]), float(top[bit])))
        return pd.DataFrame(rows, columns=[*_KEYS, "cap", "bit", "n", "slot", "precision", "recall"])

    held = d.groupBy("part").cogroup(starts.groupBy("part")).applyInPandas(buckets, "scope string, grp string, label string, cap int, bit int, n bigint, slot int, precision double, recall double")
    best = held.groupBy(*_KEYS, "cap", "bit", "n").agg(F.max("recall").alias("recall"), F.collect_list(F.struct("slot", "precision")).alias("b"))
    # At most 101 buckets each: precision at a threshold is the greatest in its bucket or a later one.
    at = F.transform(F.sequence(F.lit(0), F.lit(len(RECALLS) - 1)), lambda i: F.coalesce(F.array_max(F.transform(F.filter("b", lambda z: z["slot"] >= i), lambda z: z["precision"])), F.lit(0.0)))
    best = best.select(*_KEYS, "cap", "bit", "recall", (F.aggregate(at, F.lit(0.0), lambda x, v: x + v) / len(RECALLS)).alias("precision"))
    every = needed.select(*_KEYS, F.posexplode("n").alias("a", "n_objects")).filter("n_objects > 0")
    every = every.withColumn("cap", F.explode(F.array(*[F.lit(c) for c in caps]))).withColumn("t", F.explode(F.array(*[F.lit(i) for i in range(len(OVERLAPS))]))).withColumn("bit", F.col("a") * len(OVERLAPS) + F.col("t"))
    out = every.join(best, [*_KEYS, "cap", "bit"], "left")
    area = F.element_at(F.array(*[F.lit(a) for a in AREAS]), F.col("a") + 1)
    return out.select(*_KEYS, area.alias("area"), "cap", F.round(0.5 + 0.05 * F.col("t"), 2).alias("overlap"), "n_objects", F.coalesce("precision", F.lit(0.0)).alias("precision"), F.coalesce("recall", F.lit(0.0)).alias("recall"))


def metrics(curve: DataFrame, most: int, by: tuple[str, ...] = ("scope", "grp")) -> DataFrame:
    """(*by, metric, value): average precision and recall; a metric without any counted object is missing."""
    c = F.col
    full = c("cap") == most
    named = {
        "map_50_95": (full & (c("area") == "all"), "precision"), "map_50": (full & (c("area") == "all") & (c("overlap") == 0.5), "precision"), "map_75": (full & (c("area") == "all") & (c("overlap") == 0.75), "precision"),
        **{f"ap_{a}": (full & (c("area") == a), "precision") for a in ("small", "medium", "large")},
        **{f"ar_{n}": ((c("cap") == n) & (c("area") == "all"), "recall") for n in sorted({1, 10, most})},
        **{f"ar_{a}": (full & (c("area") == a), "recall") for a in ("small", "medium", "large")},
    }
    wide = curve.groupBy(*by).agg(*[F.avg(F.when(cond, c(v))).alias(name) for name, (cond, v) in named.items()])
    return wide.unpivot(list(by), list(named), "metric", "value").filter("value is not null")


def evaluate(truth: DataFrame, predictions: DataFrame, images: DataFrame, classes: list[str], most: int = 300) -> DataFrame:
    """(scope, grp, metric, value) of detections against objects, overall and per class, condition, domain and size.

    truth and predictions as in matched_detections(), images: (image_id, ord, condition, domain), one row each.
    Predictions of unknown classes or of other pictures take no part. A scope without objects, or without any usable
    prediction, has the six zero metrics only; a class without objects has none.
    """
    known = F.col("label").isin(*classes)
    use = predictions.filter(known).join(images.select("image_id"), "image_id", "left_semi")
    det, counts = matched_detections(truth.filter(known), use, most)
    curve = written(curves(det, counts, images, most), "curves")
    out = metrics(curve, most)
    per_class = metrics(curve.filter("scope = 'overall'"), most, ("label",)).select(F.lit("class").alias("scope"), F.col("label").alias("grp"), "metric", "value")
    scopes = _scoped(images.select("image_id"), images).select("scope", "grp").distinct()
    seen = _scoped(use.select("image_id"), images).select("scope", "grp").distinct()
    held = _scoped(truth.filter(known).select("image_id"), images).select("scope", "grp").distinct()
    usable = seen.join(held, ["scope", "grp"], "left_semi")
    zeros = F.explode(F.array(*[F.lit(m) for m in ("map_50_95", "map_50", "map_75", "ar_1", "ar_10", f"ar_{most}")]))
    unusable = scopes.join(usable, ["scope", "grp"], "left_anti")
    zero = unusable.withColumn("metric", zeros).withColumn("value", F.lit(0.0))
    # Without any usable detection every class has the zero metrics too, else a class has what its own objects give.
    idle = unusable.filter("scope = 'overall'").select(F.lit("class").alias("scope"), F.explode(F.array(*[F.lit(c) for c in classes])).alias("grp")).withColumn("metric", zeros).withColumn("value", F.lit(0.0))
    per_class = per_class.join(usable.filter("scope = 'overall'").select(F.lit("class").alias("scope")), "scope", "left_semi").unionByName(idle)
    out = out.join(usable, ["scope", "grp"], "left_semi").unionByName(zero)
    size = out.filter("scope = 'overall'").filter(F.col("metric").rlike("^a[pr]_(small|medium|large)$"))
    size = size.select(F.lit("size").alias("scope"), F.regexp_extract("metric", "_(.*)$", 1).alias("grp"), F.when(F.col("metric").startswith("ap"), "ap").otherwise(f"ar_{most}").alias("metric"), "value")
    return out.unionByName(per_class).unionByName(size)


def evaluation_counts(rows: DataFrame, truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: num_images, num_ground_truth, num_predictions, num_dropped_boxes.

    All predictions count, also those of unknown classes or of other pictures; dropped boxes are the predictor's
    n_invalid (0 where it has none, as usable_predictions() counts them).
    """
    dropped = F.coalesce(F.sum("n_invalid"), F.lit(0)) if "n_invalid" in predictions.columns else F.lit(0)
    p = predictions.agg(F.coalesce(F.sum(F.size(F.coalesce("predictions", F.array()))), F.lit(0)).cast("bigint").alias("num_predictions"), dropped.cast("bigint").alias("num_dropped_boxes"))
    out = rows.agg(F.count("*").alias("num_images")).crossJoin(truth.agg(F.count("*").alias("num_ground_truth"))).crossJoin(p)  # one row each
    return out.select("num_images", "num_ground_truth", "num_predictions", "num_dropped_boxes")


def required(metrics: dict[str, float], name: str) -> float:
    """A metric's value; an error naming the available ones if it is missing or not finite."""
    value = metrics.get(name)
    if value is None or not np.isfinite(value):
        raise ValueError(f"metric {name!r} is missing; available: {', '.join(sorted(metrics)) or 'none'}")
    return value


def require_metric(result: DataFrame, name: str) -> float:
    """The overall value of a metric; an error naming the available ones if it is missing or not finite."""
    return required({r["metric"]: r["value"] for r in result.filter("scope = 'overall'").select("metric", "value").collect()}, name)
