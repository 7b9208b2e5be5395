"""Model adapters: what trains and predicts, named by a backend, between tables of rows and tables of predictions."""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.operators import evaluate as E
from boxlake.operators import splits as S
from boxlake.operators import targets as T
from boxlake.plans.tuning import NullLog


class ModelAdapter(ABC):
    """One model. Artifacts are mappings that JSON can hold; settings are sections of an experiment."""

    def __init__(self, model: dict) -> None:
        self.model = model

    @abstractmethod
    def train(self, train: DataFrame, val: DataFrame, settings: dict, evaluation: dict | None = None, log=None) -> dict:
        """Trains on canonical rows and returns the artifact. With `evaluation` every epoch is scored on val."""

    @abstractmethod
    def predict(self, rows: DataFrame, artifact: dict, settings: dict) -> DataFrame:
        """(image_id, predictions, n_invalid) of canonical rows; predictions are already filtered as usable_predictions() does."""

    def evaluate(self, rows: DataFrame, artifact: dict, settings: dict, log=None, prefix: str | None = None) -> dict:
        """Predicts and scores: metrics, groups and counts. The settings of the evaluation are those of the prediction."""
        predict = {k: settings[k] for k in ("classes", "label_mode", "conf_threshold", "iou_threshold", "max_detections_per_image", "preprocess") if k in settings}
        predictions = self.predict(rows, artifact, predict).persist()  # read by the scores and by the counts
        try:
            result = scored(rows, predictions, settings)
        finally:
            predictions.unpersist()
        E.required(result["metrics"], settings.get("primary_metric", "map_50_95"))
        (log or NullLog()).eval_result(result, prefix=prefix)
        return result


def scored(rows: DataFrame, predictions: DataFrame, settings: dict) -> dict:
    """The evaluator's result for predictions (image_id, predictions[, n_invalid]): metrics by scope, and counts."""
    classes, most = settings["classes"], int(settings.get("max_detections_per_image", 300))
    slim = rows.drop("image")
    parsed = T.parse_targets(slim, classes, settings.get("label_mode", "meta")).select("image_id", F.posexplode("targets").alias("pos", "t")).select("image_id", "pos", "t.label", "t.x", "t.y", "t.w", "t.h", "t.iscrowd")
    boxes = predictions.select("image_id", F.posexplode("predictions").alias("pos", "p")).select("image_id", "pos", "p.*")
    images = S.dense_number(T.sample_groups(slim), "image_id", "ord")
    held: dict[str, dict] = {}
    for r in E.evaluate(parsed, boxes, images, classes, most).collect():  # one row per scope, group and metric
        held.setdefault(r["scope"], {}).setdefault(r["grp"], {})[r["metric"]] = r["value"]
    overall = held.pop("overall", {})
    counts = E.evaluation_counts(slim, parsed, predictions).first().asDict()
    return {"metrics": next(iter(overall.values()), {}), **{f"per_{k}": v for k, v in held.items()}, "counts": counts}


ADAPTERS: dict[str, Callable[[dict], ModelAdapter]] = {}


def register(backend: str):
    """Decorator: names the adapter of a backend."""

    def add(cls):
        ADAPTERS[backend] = cls
        return cls

    return add


def adapter_of(model: dict) -> ModelAdapter:
    """The adapter of a model's backend; a backend without one raises."""
    backend = model.get("backend")
    if backend not in ADAPTERS:
        raise NotImplementedError(f"no adapter is registered for backend {backend!r}; registered: {', '.join(sorted(ADAPTERS)) or 'none'}")
    return ADAPTERS[backend](model)


@register("reference")
class ReferenceAdapter(ModelAdapter):
    """A stand-in without a network: it learns the mean box of every class and condition, and predicts that.

    Training is one aggregate; the learning rate only sets how far the boxes are moved towards the mean from the whole
    picture, so that experiments, searches and final runs can be driven from end to end.
    """

    def train(self, train, val, settings, evaluation=None, log=None):
        rate = float((settings.get("hparams") or {}).get("learning_rate", 1e-3))
        t = T.parse_targets(train.drop("image"), settings["classes"], settings.get("label_mode", "meta")).select("width", "height", F.explode("targets").alias("t")).filter("width > 0 and height > 0")
        share = [F.avg(F.col(f"t.{c}") / F.col(side)).alias(c) for c, side in (("x", "width"), ("y", "height"), ("w", "width"), ("h", "height"))]
        means = t.groupBy("t.label").agg(*share, F.count("*").alias("n")).orderBy("label").collect()  # one row per class
        pull = 1 - math.exp(-rate * 1000)
        boxes = {r["label"]: [pull * r["x"], pull * r["y"], pull * r["w"] + 1 - pull, pull * r["h"] + 1 - pull] for r in means}
        total = sum(r["n"] for r in means) or 1
        artifact = {"run_key": settings.get("run_key"), "backend": "reference", "boxes": boxes, "scores": {r["label"]: r["n"] / total for r in means}, "artifact_path": settings.get("output_dir"), "checkpoint_path": None, "meta": {"classes": settings["classes"], "seed": settings.get("seed")}}
        for epoch in range(1, int(settings.get("max_epochs", 1)) + 1 if evaluation else 1):
            (log or NullLog()).log(self.evaluate(val, artifact, evaluation)["metrics"], epoch)
        return artifact

    def predict(self, rows, artifact, settings):
        one = lambda k, b: F.struct(F.lit(k).alias("label"), F.lit(float(artifact["scores"][k])).alias("score"), F.array(*[F.lit(float(v)) for v in (b[0], b[1], b[0] + b[2], b[1] + b[3])]).alias("share"))
        held = [one(k, b) for k, b in artifact["boxes"].items()]
        made = F.array(*held) if held else F.array().cast("array<struct<label:string,score:double,share:array<double>>>")
        side = F.array("width", "height", "width", "height")
        raw = F.transform(made, lambda p: F.struct(p["label"].alias("label"), p["score"].alias("score"), F.zip_with(p["share"], side, lambda a, b: a * b).alias("box")))
        return T.usable_predictions(rows.drop("image").withColumn("raw", raw), "raw", settings["classes"], float(settings.get("conf_threshold", 0.0)), int(settings.get("max_detections_per_image", 300)))
