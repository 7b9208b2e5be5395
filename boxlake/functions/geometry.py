"""Box algebra as Column expressions.

A box is a struct<x, y, w, h> of doubles, or null. Comparisons follow IEEE rules (a comparison with NaN is false),
which Spark's own ordering of NaN does not, so every rule tests for NaN first. Rules name their arguments several
times: give long derivations a column of their own (withColumn) before passing them on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tolerance of the merge's extent check, of the within-image check, and the largest float32.
GEOMETRY_EPSILON, WITHIN_EPSILON, FLOAT32_MAX = 1e-3, 1e-6, 3.4028234663852886e38

BOX = "struct<x:double,y:double,w:double,h:double>"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value computed once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), w.cast("double").alias("w"), h.cast("double").alias("h"))


def from_array(values: Column) -> Column:
    """A box of an array [x, y, w, h]; null unless it has exactly four non-null values."""
    ok = (F.size(values) == 4) & ~F.exists(values, lambda v: v.isNull())
    return F.when(ok, box(*[F.get(values, F.lit(i)) for i in range(4)]))


def from_xyxy(values: Column) -> Column:
    """A box of an array of corners [x1, y1, x2, y2]; null unless it has exactly four non-null values."""
    ok = (F.size(values) == 4) & ~F.exists(values, lambda v: v.isNull())
    x1, y1, x2, y2 = (F.get(values, F.lit(i)).cast("double") for i in range(4))
    return F.when(ok, box(x1, y1, x2 - x1, y2 - y1))


def from_corners(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return box(x1, y1, x2 - x1, y2 - y1)


def xyxy(b: Column) -> Column:
    return F.when(b.isNotNull(), F.array(b["x"], b["y"], b["x"] + b["w"], b["y"] + b["h"]))


def xywh(b: Column) -> Column:
    return F.when(b.isNotNull(), F.array(b["x"], b["y"], b["w"], b["h"]))


def cxcywh(b: Column) -> Column:
    return F.when(b.isNotNull(), F.array(b["x"] + b["w"] / 2, b["y"] + b["h"] / 2, b["w"], b["h"]))


def area(b: Column) -> Column:
    return b["w"] * b["h"]


def normalised_centre(b: Column, width: Column, height: Column) -> Column:
    """[cx, cy, w, h] as shares of the image; null for an image without area."""
    share = lambda v, n: F.try_divide(v.cast("double"), n.cast("double"))
    ok = b.isNotNull() & (width > 0) & (height > 0)
    return F.when(ok, F.array(share(b["x"] + b["w"] / 2, width), share(b["y"] + b["h"] / 2, height), share(b["w"], width), share(b["h"], height)))


def from_normalised_centre(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    return box((cx - w / 2) * width, (cy - h / 2) * height, w * width, h * height)


def has_nan(b: Column) -> Column:
    return F.isnan(b["x"]) | F.isnan(b["y"]) | F.isnan(b["w"]) | F.isnan(b["h"])


def _less(a: Column, b: Column) -> Column:
    """a < b, false where either is NaN."""
    return ~F.isnan(a) & ~F.isnan(b) & (a < b)


def _clamp(v: Column, top: Column) -> Column:
    """v within 0..top; a NaN becomes 0, as max(0, min(NaN, top)) does."""
    return F.when(F.isnan(v), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(v, top.cast("double"))))


def clipped(b: Column, width: Column, height: Column) -> Column:
    """The part of a box within its image; null if that has no area."""
    x1, y1 = _clamp(b["x"], width), _clamp(b["y"], height)
    x2, y2 = _clamp(b["x"] + b["w"], width), _clamp(b["y"] + b["h"], height)
    return F.when((x2 > x1) & (y2 > y1), box(x1, y1, x2 - x1, y2 - y1))


def within(b: Column, width: Column, height: Column, epsilon: float = WITHIN_EPSILON) -> Column:
    return ~has_nan(b) & (b["x"] >= -epsilon) & (b["y"] >= -epsilon) & (b["x"] + b["w"] <= width + F.lit(epsilon)) & (b["y"] + b["h"] <= height + F.lit(epsilon))


def out_of_bounds(b: Column, width: Column, height: Column) -> Column:
    """Exactly outside, without tolerance; coordinates that are NaN decide nothing."""
    zero = F.lit(0.0)
    return _less(b["x"], zero) | _less(b["y"], zero) | _less(width.cast("double"), b["x"] + b["w"]) | _less(height.cast("double"), b["y"] + b["h"])


def no_area(b: Column) -> Column:
    zero = F.lit(0.0)
    at_most = lambda v: ~F.isnan(v) & (v <= zero)
    return at_most(b["w"]) | at_most(b["h"])


def apply_policy(b: Column, width: Column, height: Column, policy: str) -> Column:
    """The box that an import policy lets through: strict raises, drop gives null, clip clamps to the image.

    A box without four values or without area is dropped (strict: raises). A box with a NaN that its other
    coordinates do not already put outside raises under every policy, as it cannot be stored.
    """
    if policy not in ("strict", "drop", "clip"):
        raise ValueError(f"unknown box policy {policy!r}; one of strict, drop, clip")
    fail = lambda why: F.raise_error(F.concat(F.lit(why + ": "), F.coalesce(F.to_json(b), F.lit("null")))).cast(BOX)
    none = F.lit(None).cast(BOX)
    outside = fail("box exceeds its image") if policy == "strict" else none if policy == "drop" else clipped(b, width, height)
    bad = fail("box has no area") if policy == "strict" else none
    return F.when(b.isNull() | no_area(b), bad).when(out_of_bounds(b, width, height), outside).when(has_nan(b), fail("box is not a number")).otherwise(b)


def _single(v: Column) -> Column:
    return v.cast("float").cast("double")


def checked_status(b: Column, width: Column, height: Column) -> Column:
    """Why the merge refuses a box (null: it does not): not_finite, invalid or exceeds."""
    finite = lambda v: ~F.isnan(v) & (F.abs(v) <= FLOAT32_MAX)
    f = [_single(b[n]) for n in "xywh"]
    bad = (f[0] < 0) | (f[1] < 0) | (f[2] <= 0) | (f[3] <= 0)
    far = (f[0] + f[2] > width + F.lit(GEOMETRY_EPSILON)) | (f[1] + f[3] > height + F.lit(GEOMETRY_EPSILON))
    ok = finite(b["x"]) & finite(b["y"]) & finite(b["w"]) & finite(b["h"])
    return F.when(b.isNull(), "arity").when(~ok, "not_finite").when(bad, "invalid").when(far, "exceeds")


def _fitted(start: Column, extent: Column, limit: Column) -> Column:
    """A float32 extent that reaches over limit by rounding only, shrunk to the largest float32 that does not."""
    near = _single(limit - start)
    # The spacing of float32 values below `near`; halves and quarters of it cover a binade's edge.
    step = F.pow(F.lit(2.0), F.floor(F.log2(near)) - 23)
    tries = [_single(near - step * k) for k in (0.0, 0.25, 0.5, 1.0, 2.0)]
    return F.when(start + extent <= limit, extent).otherwise(F.coalesce(*[F.when((start + t <= limit) & (t > 0), t) for t in tries]))


def checked(b: Column, width: Column, height: Column) -> Column:
    """The box as float32 values within its image; null where checked_status() gives a reason."""
    x, y, w, h = (_single(b[n]) for n in "xywh")
    fw, fh = _fitted(x, w, width.cast("double")), _fitted(y, h, height.cast("double"))
    return F.when(checked_status(b, width, height).isNull() & fw.isNotNull() & fh.isNotNull(), box(x, y, fw, fh))


def resize_plan(width: Column, height: Column, mode: str, target: tuple[int, int], longest: int | None = None) -> Column:
    """struct<width, height, scale_x, scale_y, pad_x, pad_y> of a resize, rounding half to even; no side gets shorter than a pixel.

    exact: to target (width, height). letterbox: into target with equal padding (the left half rounded down).
    shortest_edge: the shorter side to target[0], unless the longer side would exceed `longest`.
    """
    w, h = width.cast("double"), height.cast("double")
    tw, th = (F.lit(float(t)) for t in target)
    zero = F.lit(0)
    if mode == "exact":
        nw, nh, px, py, cw, ch = tw, th, zero, zero, tw, th
    elif mode == "letterbox":
        scale = F.least(tw / w, th / h)
        nw, nh = F.greatest(F.lit(1.0), F.rint(w * scale)), F.greatest(F.lit(1.0), F.rint(h * scale))
        px, py, cw, ch = F.floor((tw - nw) / 2), F.floor((th - nh) / 2), tw, th
    elif mode == "shortest_edge":
        scale = F.least(tw / F.least(w, h), F.lit(float(longest if longest is not None else 2**31)) / F.greatest(w, h))
        nw, nh = F.greatest(F.lit(1.0), F.rint(w * scale)), F.greatest(F.lit(1.0), F.rint(h * scale))
        px, py, cw, ch = zero, zero, nw, nh
    else:
        raise ValueError(f"unknown resize mode {mode!r}; one of exact, letterbox, shortest_edge")
    return F.struct(cw.cast("int").alias("width"), ch.cast("int").alias("height"), (nw / w).alias("scale_x"), (nh / h).alias("scale_y"), px.cast("int").alias("pad_x"), py.cast("int").alias("pad_y"))


def resized(b: Column, plan: Column) -> Column:
    return F.when(b.isNotNull(), box(b["x"] * plan["scale_x"] + plan["pad_x"], b["y"] * plan["scale_y"] + plan["pad_y"], b["w"] * plan["scale_x"], b["h"] * plan["scale_y"]))


def flipped(b: Column, width: Column) -> Column:
    return F.when(b.isNotNull(), box(width - b["x"] - b["w"], b["y"], b["w"], b["h"]))


def flip_coin(key: Column, seed: int, probability: float) -> Column:
    """True for about `probability` of the keys, the same in every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < F.lit(int(probability * 1_000_000))


def restored(b: Column, plan: Column, width: Column, height: Column) -> Column:
    """A box of the resized picture in its original picture, clamped; null if nothing of it is left."""
    back = lambda v, pad, scale: (v - pad) / scale
    x1, y1 = back(b["x"], plan["pad_x"], plan["scale_x"]), back(b["y"], plan["pad_y"], plan["scale_y"])
    x2, y2 = back(b["x"] + b["w"], plan["pad_x"], plan["scale_x"]), back(b["y"] + b["h"], plan["pad_y"], plan["scale_y"])
    return clipped(box(x1, y1, x2 - x1, y2 - y1), width, height)


def draw(key: Column, seed: int, what: str) -> Column:
    """A number from 0 to 1 (without 1) that depends on the key, the seed and what it is drawn for."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(what)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def colour_jitter(key: Column, seed: int, strength: float, probability: float) -> Column:
    """struct<applied, brightness, contrast, saturation, hue>: the factors of a random change of colour, 1 and 0 if not applied.

    Factors lie within strength of 1 (and not below 0), the shift of the hue within half of it, at most half a turn.
    """
    on = draw(key, seed, "jitter") < probability
    lo, hi, turn = max(0.0, 1 - strength), 1 + strength, min(0.5, strength * 0.5)
    factor = lambda name: F.when(on, lo + draw(key, seed, name) * (hi - lo)).otherwise(F.lit(1.0)).alias(name)
    hue = F.when(on, (draw(key, seed, "hue") * 2 - 1) * turn).otherwise(F.lit(0.0))
    return F.struct(on.alias("applied"), factor("brightness"), factor("contrast"), factor("saturation"), hue.alias("hue"))


def canonical_corners(corners: Column, width: Column, height: Column) -> Column:
    """Corners [x1, y1, x2, y2] in a picture as a box cut to it; null unless they are four finite numbers in order with an area inside."""
    values = [F.get(corners, F.lit(i)).cast("double") for i in range(4)]
    usable = (F.size(corners) == 4) & (width > 0) & (height > 0)
    for v in values:
        usable = usable & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    x1, x2 = (F.greatest(F.lit(0.0), F.least(v, width.cast("double"))) for v in (values[0], values[2]))
    y1, y2 = (F.greatest(F.lit(0.0), F.least(v, height.cast("double"))) for v in (values[1], values[3]))
    return F.when(F.coalesce(usable & (x2 > x1) & (y2 > y1), F.lit(False)), from_corners(x1, y1, x2, y2))


def canonical_prediction(corners: Column, plan: Column, width: Column, height: Column) -> Column:
    """Predicted corners [x1, y1, x2, y2] in the resized picture as a box of the original; null if unusable."""
    values = [F.get(corners, F.lit(i)).cast("double") for i in range(4)]
    usable = (F.size(corners) == 4) & (width > 0) & (height > 0)
    for v in values:
        usable = usable & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    x1, x2 = (F.greatest(F.lit(0.0), F.least(v, plan["width"].cast("double"))) for v in (values[0], values[2]))
    y1, y2 = (F.greatest(F.lit(0.0), F.least(v, plan["height"].cast("double"))) for v in (values[1], values[3]))
    return F.when(usable & (x2 > x1) & (y2 > y1), restored(from_corners(x1, y1, x2, y2), plan, width, height))


def iou(a: Column, b: Column, crowd: Column | None = None) -> Column:
    """Intersection over union; against a crowd region, over the area of a alone."""
    iw = F.greatest(F.lit(0.0), F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]))
    ih = F.greatest(F.lit(0.0), F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]))
    inter = iw * ih
    union = area(a) + area(b) - inter
    return F.try_divide(inter, union if crowd is None else F.when(crowd, area(a)).otherwise(union))
