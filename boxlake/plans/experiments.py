"""Experiment plans: one description of data, classes and protocol times many models.

Plans are small YAML trees and are expanded on the driver; plan_table() shows the result as a DataFrame.
"""

from __future__ import annotations

import copy
import itertools
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Names of the run templates and what they are without a plan's own.
TEMPLATES = {
    ("train", "run_key"): ("run_key", "{model_key}_{dataset_key}_{protocol}"),
    ("train", "output_dir"): ("output_dir", "runs/{model_key}/{dataset_key}/{protocol}"),
    ("tuning", "study_name"): ("tuning_study_name", "{model_key}_{dataset_key}_{protocol}"),
    ("tuning", "output_dir"): ("tuning_output_dir", "runs/hpo/{model_key}_{dataset_key}_{protocol}"),
    ("final", "output_dir"): ("final_output_dir", "runs/{model_key}/{dataset_key}/{protocol}/final"),
}
SECTIONS = ("train", "eval", "predict", "tuning", "final", "logging")
SHARED = ("train", "eval", "predict")
BACKENDS = ("hf_trainer", "ultralytics", "torchvision", "reference")

# Ranges of numbers by section and key (a dotted key lies deeper): lowest, highest, whole, and whether the ends
# themselves are out; None is no bound.
RANGES = {
    "train": {
        "batch_size": (1, None, True, False), "max_epochs": (1, None, True, False), "max_steps": (1, None, True, False), "logging_steps": (1, None, True, False),
        "augmentation.horizontal_flip_p": (0, 1, False, False), "augmentation.color_jitter_p": (0, 1, False, False), "augmentation.color_jitter_strength": (0, None, False, False),
        "loader.num_workers": (0, None, True, False), "loader.prefetch_factor": (1, None, True, False), "loader.profile_every_n": (1, None, True, False),
        "optimizer.weight_decay": (0, None, False, False), "optimizer.epsilon": (0, None, False, True),
        "scheduler.warmup_epochs": (0, None, False, False), "scheduler.total_epochs": (1, None, True, False), "scheduler.min_lr_ratio": (0, 1, False, False),
        "early_stopping.min_epochs": (1, None, True, False), "early_stopping.patience": (1, None, True, False), "early_stopping.min_delta": (0, None, False, False), "eval_strategy.every_epochs": (1, None, True, False), "checkpoint.save_every_epochs": (1, None, True, False),
    },
    "eval": {"batch_size": (1, None, True, False), "conf_threshold": (0, 1, False, False), "iou_threshold": (0, 1, False, False), "max_detections_per_image": (1, None, True, False)},
    "predict": {"batch_size": (1, None, True, False), "conf_threshold": (0, 1, False, False), "iou_threshold": (0, 1, False, False), "max_detections_per_image": (1, None, True, False)},
    "tuning": {"n_trials": (1, None, True, False), "trial_epochs": (1, None, True, False), "timeout_seconds": (1, None, True, False)},
}
# What some settings may be.
CHOICES = {
    "train": {"augmentation.policy": ("none", "basic", "weather", "provider"), "optimizer.name": ("adamw",), "scheduler.name": ("warmup_cosine",), "loader.decode_backend": ("pil", "opencv"), "early_stopping.mode": ("max",), "label_mode": ("meta", "native")},
    "eval": {"label_mode": ("meta", "native")}, "predict": {"label_mode": ("meta", "native")}, "tuning": {"direction": ("maximize", "minimize"), "sampler": ("tpe", "random"), "pruner": ("none", "median", "asha")},
}


class PlanError(ValueError):
    """A plan or experiment that cannot be used."""


def deep_merge(base: dict, over: dict) -> dict:
    """over laid on base: mappings are merged, everything else is replaced. Neither is changed."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def class_list(values) -> list[str]:
    out = [str(v).strip() for v in values or []]
    if not out or "" in out or len(set(out)) < len(out):
        raise PlanError("classes must be non-empty, not blank and unique")
    return out


def check_preprocess(p: dict) -> dict:
    """Dimensions that a resize mode needs, and no others."""
    mode, given = p.get("resize_mode"), {k for k in ("height", "width", "shortest_edge", "longest_edge") if p.get(k) is not None}
    need = {"letterbox": {"height", "width"}, "exact": {"height", "width"}, "shortest_edge": {"shortest_edge", "longest_edge"}}.get(mode)
    if need is None:
        raise PlanError(f"unknown resize_mode {mode!r}")
    if given != need or any(p[k] <= 0 for k in need):
        raise PlanError(f"{mode} needs exactly {', '.join(sorted(need))}, all positive")
    if mode == "letterbox" and p["height"] != p["width"]:
        raise PlanError("letterbox needs equal height and width")
    if mode == "shortest_edge" and p["longest_edge"] < p["shortest_edge"]:
        raise PlanError("longest_edge is below shortest_edge")
    return p


def check_search_space(params: dict) -> dict:
    """Named ranges or choices to search; log needs positive bounds."""
    for name, s in params.items():
        kind = s.get("type")
        if kind == "categorical":
            if not isinstance(s.get("choices"), list) or not s["choices"]:
                raise PlanError(f"{name}: no choices")
            if "log" in s:
                raise PlanError(f"{name}: log is for numbers only")
        elif kind in ("float", "int"):
            if "choices" in s:
                raise PlanError(f"{name}: choices are for categories only")
            if s.get("low") is None or s.get("high") is None or s["low"] > s["high"]:
                raise PlanError(f"{name}: low must not exceed high")
            if s.get("log") and s["low"] <= 0:
                raise PlanError(f"{name}: log needs a positive low")
        else:
            raise PlanError(f"{name}: unknown type {kind!r}")
    return params


def read_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f)
    if not isinstance(data, dict):
        raise PlanError(f"{path} is no mapping")
    return data


def beside(path: str, other: str) -> str:
    """A path named in a file: absolute, or relative to that file."""
    return other if os.path.isabs(other) else os.path.join(os.path.dirname(path), other)


def search_space(data: dict) -> dict:
    """The parameters of a search space, with or without their wrapper."""
    return check_search_space(data.get("params", data))


@dataclass(frozen=True)
class Plan:
    """A plan file with the files it names."""

    key: str
    dataset: dict
    classes: dict
    recipe: dict
    models: list[dict]
    backend_defaults: dict = field(default_factory=dict)
    model_overrides: dict = field(default_factory=dict)
    run_template: dict = field(default_factory=dict)
    tags: list[str] = field(default_factory=list)

    @classmethod
    def load(cls, path: str) -> Plan:
        d = read_yaml(path)
        if not d.get("model_files") and not d.get("model_group_file"):
            raise PlanError("a plan needs model_files, a model_group_file, or both")
        files = [beside(path, m) for m in d.get("model_files") or []]
        if d.get("model_group_file"):
            group = beside(path, d["model_group_file"])
            files += [beside(group, m) for m in read_yaml(group)["models"]]
        recipe_path = beside(path, d["recipe_file"])
        recipe = read_yaml(recipe_path)
        for k, wrap in (("augmentation", lambda x: x), ("search_space", search_space)):
            if recipe.get(f"{k}_file"):
                recipe[k] = wrap(read_yaml(beside(recipe_path, recipe[f"{k}_file"])))
        key = str(d.get("key", "")).strip().lower()
        if not key:
            raise PlanError("a plan needs a key")
        return cls(key, read_yaml(beside(path, d["dataset_file"])), read_yaml(beside(path, d["class_space_file"])), recipe, [read_yaml(f) for f in files], d.get("backend_defaults") or {}, d.get("model_overrides") or {}, d.get("run_template") or {}, d.get("tags") or [])


def _rendered(template: str, values: dict) -> str:
    try:
        return template.format(**values)
    except KeyError as e:
        raise PlanError(f"unknown variable {e} in run template {template!r}") from e


def expand(plan: Plan, models: list[str] | None = None) -> list[dict]:
    """One checked experiment per model (or per selected model), in the plan's order."""
    wanted, out = set(models or []), []
    protocol = plan.recipe.get("protocol", "controlled")
    for model in plan.models:
        key = str(model.get("key", "")).strip().lower()
        if wanted and key not in wanted:
            continue
        backend = model.get("backend")
        if backend not in plan.backend_defaults:
            raise PlanError(f"plan {plan.key} has no defaults for backend {backend!r} of model {key}")
        layers = [plan.backend_defaults[backend] or {}, plan.model_overrides.get(key) or {}]
        if "search_space" in plan.recipe and any(x.get("search_space") or x.get("search_space_file") for x in layers):
            raise PlanError(f"the recipe's search space may not be overridden for model {key}")
        e = {"dataset": {k: plan.dataset[k] for k in ("path", "train_split", "val_split", "test_split") if k in plan.dataset}, "classes": class_list(plan.classes.get("classes")), "model": {**model, "key": key}}
        e |= {s: copy.deepcopy(plan.recipe.get(s) or {}) for s in SECTIONS}
        e |= {k: copy.deepcopy(plan.recipe[k]) for k in ("augmentation", "search_space") if k in plan.recipe}
        e["train"].setdefault("protocol", protocol)
        for s in SHARED:
            e[s].setdefault("label_mode", plan.classes.get("label_mode", "meta"))
        for layer in layers:
            e = deep_merge(e, layer)
        values = {"model_key": key, "dataset_key": plan.dataset["key"], "protocol": protocol, "plan_key": plan.key}
        for (section, name), (template, default) in TEMPLATES.items():
            e[section][name] = _rendered(plan.run_template.get(template, default), values)
        wandb = e["logging"].setdefault("wandb", {})
        wandb["project"] = _rendered(plan.run_template.get("wandb_project", "{dataset_key}_{protocol}"), values)
        wandb["tags"] = list(dict.fromkeys([*(wandb.get("tags") or []), *plan.tags]))
        out.append(checked(e))
    if missing := wanted - {e["model"]["key"] for e in out}:
        raise PlanError(f"plan {plan.key} has no models {sorted(missing)}")
    return out


def _setting(section: dict, key: str):
    for part in key.split("."):
        section = section.get(part) if isinstance(section, dict) else None
    return section


def check_settings(e: dict) -> None:
    """Numbers within their ranges, names among their choices, and a run key that is not blank."""
    for name, keys in RANGES.items():
        for key, (lo, hi, whole, open_) in keys.items():
            v = _setting(e.get(name) or {}, key)
            if v is None:
                continue
            if isinstance(v, bool) or not isinstance(v, (int, float)):
                raise PlanError(f"{name}.{key} is no number: {v!r}")
            if v < lo or (open_ and v == lo) or (hi is not None and v > hi) or (whole and v != int(v)):
                raise PlanError(f"{name}.{key} is out of range: {v}")
    for name, keys in CHOICES.items():
        for key, allowed in keys.items():
            v = _setting(e.get(name) or {}, key)
            if v is not None and v not in allowed:
                raise PlanError(f"{name}.{key} is {v!r}, not one of {', '.join(allowed)}")
    for k in ("beta1", "beta2"):
        v = _setting(e.get("train") or {}, f"optimizer.{k}")
        if v is not None and not 0 <= v < 1:
            raise PlanError(f"train.optimizer.{k} is out of range: {v}")
    run_key = (e.get("train") or {}).get("run_key")
    if run_key is not None and not str(run_key).strip():
        raise PlanError("train.run_key is blank")


def checked(e: dict) -> dict:
    """An experiment with its shared settings filled in, or an error saying what is wrong with it."""
    e = copy.deepcopy(e)
    for name in ("model", "augmentation", "search_space"):
        if e.get(name) and e.get(f"{name}_file"):
            raise PlanError(f"use either {name} or {name}_file")
    if not e.get("model") and not e.get("model_file"):
        raise PlanError("an experiment needs a model")
    e["classes"] = class_list(e.get("classes"))
    model = e.get("model") or {}
    if model and not str(model.get("key", "")).strip():
        raise PlanError("a model needs a key")
    if model and model.get("backend") not in BACKENDS:
        raise PlanError(f"unknown backend {model.get('backend')!r}")
    for s in SHARED:
        if s in e or s != "predict":
            part = e.setdefault(s, {})
            part.setdefault("classes", e["classes"])
            if "preprocess" in model:
                part.setdefault("preprocess", model["preprocess"])
            part.setdefault("label_mode", e["train"].get("label_mode", "meta"))
            if "preprocess" in part:
                check_preprocess(part["preprocess"])
    if e.get("augmentation"):
        e["train"].setdefault("augmentation", e["augmentation"])
    check_settings(e)
    seeds = (e.get("final") or {}).get("seeds", [0, 1, 2])
    if not seeds or len(set(seeds)) < len(seeds):
        raise PlanError("final seeds must be non-empty and unique")
    if e.get("search_space"):
        check_search_space(e["search_space"])
    return e


def load_experiment(path: str) -> dict:
    """An experiment file with the model, augmentation and search-space files it names, relative to itself."""
    e = read_yaml(path)
    for name, wrap in (("model", lambda x: x), ("augmentation", lambda x: x), ("search_space", search_space)):
        if e.get(f"{name}_file"):
            if e.get(name):
                raise PlanError(f"use either {name} or {name}_file")
            e[name] = wrap(read_yaml(beside(path, e.pop(f"{name}_file"))))
    return checked(e)


def write_resolved(plan: Plan, folder: str, models: list[str] | None = None) -> list[str]:
    """One YAML file per model's experiment."""
    import yaml

    os.makedirs(folder, exist_ok=True)
    out = []
    for e in expand(plan, models):
        out.append(os.path.join(folder, f"{e['model']['key']}.yaml"))
        with open(out[-1], "w", encoding="utf-8") as f:
            yaml.safe_dump(e, f, sort_keys=False)
    return out


def plan_table(spark: SparkSession, plans: list[Plan]) -> DataFrame:
    """(plan, model, backend, run_key, output_dir) of every experiment."""
    rows = [(p.key, e["model"]["key"], e["model"]["backend"], e["train"]["run_key"], e["train"]["output_dir"]) for p in plans for e in expand(p)]
    return spark.createDataFrame(rows, "plan string, model string, backend string, run_key string, output_dir string")


def grid(params: dict, points: int = 4) -> list[dict]:
    """A grid over a search space: every choice, and `points` values per range (evenly on its scale)."""
    axes = []
    for name, s in params.items():
        if s["type"] == "categorical":
            axes.append([(name, c) for c in s["choices"]])
            continue
        lo, hi = float(s["low"]), float(s["high"])
        at = [i / max(1, points - 1) for i in range(points)]
        values = [lo * (hi / lo) ** t if s.get("log") else lo + (hi - lo) * t for t in at]
        axes.append([(name, round(v) if s["type"] == "int" else v) for v in values])
    return [dict(c) for c in itertools.product(*axes)]


def sample(params: dict, seed: int, trial: int) -> dict:
    """Random values of a search space, the same for equal seed and trial."""
    import math
    import random

    rng, out = random.Random(f"{seed}:{trial}"), {}
    for name, s in params.items():
        if s["type"] == "categorical":
            out[name] = rng.choice(s["choices"])
        elif s.get("log"):
            v = math.exp(rng.uniform(math.log(s["low"]), math.log(s["high"])))
            out[name] = max(s["low"], min(s["high"], round(v))) if s["type"] == "int" else v
        else:
            out[name] = rng.randint(s["low"], s["high"]) if s["type"] == "int" else rng.uniform(s["low"], s["high"])
    return out
