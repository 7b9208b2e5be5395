"""Loops over trials and seeds, and logs: the driver decides, training and evaluation are the caller's."""

from __future__ import annotations

import json
import math
import os
import random
from collections.abc import Callable

from boxlake.plans.experiments import deep_merge, sample

#: Trials at random before the tree-structured sampler uses what it saw, its candidates, and the share of good trials.
STARTUP, CANDIDATES, GOOD = 3, 24, 0.25


def require_single_process(what: str) -> None:
    """Searches and final runs are sequential: started once per process of a group they would overwrite each other."""
    size = os.environ.get("WORLD_SIZE", "1")
    if size.strip() not in ("", "0", "1"):
        raise RuntimeError(f"{what} must run in a single process, WORLD_SIZE is {size}")


def check_controlled(space: dict, tuning: dict) -> None:
    """A controlled search varies the learning rate alone and never stops a trial early."""
    if tuning.get("early_stopping"):
        raise ValueError("a controlled search requires early_stopping: false")
    if set(space) != {"learning_rate"}:
        raise ValueError(f"a controlled search samples 'learning_rate' only, not {sorted(space)}")
    if tuning.get("sampler", "random") not in ("random", "tpe"):
        raise ValueError(f"unknown sampler {tuning['sampler']!r}")


def boundary_warning(hparams: dict, space: dict, margin: float = 0.05) -> str | None:
    """What to say if the best learning rate lies within `margin` of an end of its logarithmic range."""
    s, value = space.get("learning_rate") or {}, hparams.get("learning_rate")
    if value is None or s.get("type") != "float" or not s.get("log") or not 0 < float(s["low"]) < float(s["high"]) or value <= 0:
        return None
    at = math.log(value / s["low"]) / math.log(s["high"] / s["low"])
    side = "lower" if at <= margin else "upper" if at >= 1 - margin else None
    return side and f"best learning_rate={value:g} lies within {margin:.0%} of the {side} end {s['low' if side == 'lower' else 'high']:g} of its logarithmic range"


def tree_sample(space: dict, seed: int, trial: int, history: list[tuple[dict, float]], maximise: bool = True) -> dict:
    """Values by a tree-structured Parzen estimator: of candidates drawn around the good trials, the one where good
    trials are densest compared with the others. Random until STARTUP trials are finished; parameters are independent."""
    if len(history) < STARTUP:
        return sample(space, seed, trial)
    ranked = sorted(history, key=lambda h: -h[1] if maximise else h[1])
    n = max(1, math.ceil(GOOD * len(ranked)))
    rng, out = random.Random(f"{seed}:{trial}:tree"), {}
    for name, s in space.items():
        good, rest = [h[0][name] for h in ranked[:n]], [h[0][name] for h in ranked[n:]]
        if s["type"] == "categorical":
            weight = lambda c: (good.count(c) + 1) / (rest.count(c) + 1)  # noqa: B023, E731
            out[name] = max(s["choices"], key=lambda c: (weight(c), rng.random()))
            continue
        scale = (math.log, math.exp) if s.get("log") else (float, float)
        lo, hi = scale[0](s["low"]), scale[0](s["high"])
        width = max((hi - lo) / (len(ranked) + 1), 1e-12)
        density = lambda at, around: (sum(math.exp(-0.5 * ((at - scale[0](x)) / width) ** 2) for x in around) + 0.1) / (len(around) + 1)  # noqa: B023, E731
        drawn = [min(hi, max(lo, rng.gauss(scale[0](rng.choice(good)), width))) for _ in range(CANDIDATES)]
        value = scale[1](max(drawn, key=lambda at: density(at, good) / density(at, rest)))
        out[name] = max(s["low"], min(s["high"], round(value) if s["type"] == "int" else value))
    return out


def optimise(experiment: dict, objective: Callable[[dict, int], float], trials: int, seed: int = 0, catch: bool = False, maximise: bool = True, sampler: str = "random") -> dict:
    """Tries `trials` settings of the experiment's search space; returns best, all trials and a warning.

    objective(experiment with the trial's settings, trial) gives the metric. A failing trial is recorded; without
    `catch` its error is raised, with the trials so far as its `trials`. The earliest of equal trials is best; without a
    finished trial best is None. The warning tells that the best learning rate lies at an end of its range.
    """
    space, done = experiment["search_space"], []
    for n in range(trials):
        finished = [(t["hparams"], t["value"]) for t in done if t["value"] is not None]
        params = tree_sample(space, seed, n, finished, maximise) if sampler == "tpe" else sample(space, seed, n)
        settings = deep_merge(experiment, {"train": {"hparams": params}})
        try:
            value = float(objective(settings, n))
            if not math.isfinite(value):
                raise ValueError(f"the objective is {value}")
            done.append({"trial": n, "state": "complete", "hparams": params, "value": value, "error": None})
        except Exception as e:
            done.append({"trial": n, "state": "failed", "hparams": params, "value": None, "error": f"{type(e).__name__}: {e}"})
            if not catch:
                e.trials = done
                raise
    finished = [t for t in done if t["value"] is not None]
    best = max(finished, key=lambda t: (t["value"] if maximise else -t["value"], -t["trial"]), default=None)
    return {"best": best, "trials": done, "warning": boundary_warning(best["hparams"], space) if best else None}


def final_seeds(experiment: dict, best: dict, run: Callable[[dict, int], dict]) -> list[dict]:
    """Runs the best settings once per seed; a seed that fails is recorded and the others go on.

    run may raise with a `partial` mapping on its error: what it had finished is kept.
    """
    if "learning_rate" not in best["hparams"]:
        raise ValueError("the best trial has no learning_rate")
    out = []
    for seed in (experiment.get("final") or {}).get("seeds", [0, 1, 2]):
        settings = deep_merge(experiment, {"train": {"hparams": best["hparams"], "seed": seed}})
        try:
            out.append({"seed": seed, "state": "complete", "result": run(settings, seed), "error": None})
        except Exception as e:
            out.append({"seed": seed, "state": "failed", "result": getattr(e, "partial", None), "error": f"{type(e).__name__}: {e}"})
    return out


def aggregate_seeds(runs: list[dict], split: str) -> dict:
    """{metric: mean, std, values} over completed seeds, of metrics that all of them have; std of one seed is 0."""
    held = [r["result"][split]["metrics"] for r in runs if r["state"] == "complete" and (r["result"] or {}).get(split)]
    out = {}
    for name in sorted(set.intersection(*map(set, held))) if held else ():
        values = [float(m[name]) for m in held]
        mean = sum(values) / len(values)
        out[name] = {"mean": mean, "std": math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else 0.0, "values": values}
    return out


def write_json(path: str, data) -> str:
    """An artifact: two spaces of indent and a final line end."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(data, indent=2, default=str) + "\n")
    return path


def flat_metrics(result: dict, base: str | None = None) -> dict[str, float]:
    """One level of names of an evaluation's result: metric, or per_scope/group/metric; finite numbers only."""
    from boxlake.functions.labels import plain_name

    out = {}
    for scope, held in result.items():
        if scope == "metrics":
            out |= {plain_name(k): v for k, v in held.items()}
        elif scope.startswith("per_"):
            out |= {f"{scope}/{plain_name(g)}/{plain_name(k)}": v for g, m in held.items() for k, v in m.items()}
    return {f"{base}/{k}" if base else k: float(v) for k, v in out.items() if v is not None and math.isfinite(v)}


class NullLog:
    """Keeps nothing; the interface of all logs."""

    def start(self, name: str, config: dict) -> None:
        pass

    def start_trial(self, trial: int, hparams: dict) -> None:
        pass

    def finish_trial(self, state: str, error: str | None = None) -> None:
        pass

    def log(self, values: dict, step: int | None = None) -> None:
        pass

    def eval_result(self, result: dict, step: int | None = None, prefix: str | None = None) -> None:
        pass

    def artifact(self, path: str, name: str | None = None) -> None:
        pass

    def finish(self, status: str = "finished", error: str | None = None) -> None:
        pass


class LocalLog(NullLog):
    """Appends events as JSON lines."""

    def __init__(self, path: str) -> None:
        self.path = path
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)

    def _write(self, **row) -> None:
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps(row, default=str, sort_keys=True) + "\n")

    def start(self, name, config):
        self._write(event="start_run", name=name, config=config)

    def start_trial(self, trial, hparams):
        self._write(event="start_trial", trial_number=trial, hparams=hparams)

    def finish_trial(self, state, error=None):
        self._write(event="finish_trial", state=state, error=error)

    def log(self, values, step=None):
        self._write(event="metrics", step=step, metrics=values)

    def eval_result(self, result, step=None, prefix=None):
        self._write(event="eval_result", step=step, prefix=prefix, metrics=flat_metrics(result, prefix), result=result)

    def artifact(self, path, name=None):
        self._write(event="artifact", path=str(path), name=name)

    def finish(self, status="finished", error=None):
        self._write(event="finish_run", state=status, error=error)


class CompositeLog(NullLog):
    """Passes everything on to several logs; ends trials and runs in reverse order."""

    def __init__(self, logs: list) -> None:
        self.logs = logs

    def start(self, name, config):
        for x in self.logs:
            x.start(name, config)

    def start_trial(self, trial, hparams):
        for x in self.logs:
            x.start_trial(trial, hparams)

    def finish_trial(self, state, error=None):
        for x in reversed(self.logs):
            x.finish_trial(state, error)

    def log(self, values, step=None):
        for x in self.logs:
            x.log(values, step)

    def eval_result(self, result, step=None, prefix=None):
        for x in self.logs:
            x.eval_result(result, step, prefix)

    def artifact(self, path, name=None):
        for x in self.logs:
            x.artifact(path, name)

    def finish(self, status="finished", error=None):
        for x in reversed(self.logs):
            x.finish(*((status, error) if error is not None else (status,)))


#: Further log backends by name: a function of (path, run name, configuration) that returns a log.
BACKENDS: dict[str, Callable[[str, str, dict], NullLog]] = {}


def logs(backends: list[str], path: str, name: str = "", config: dict | None = None):
    """The log of backend names ('none' stands alone, names count once); hosted ones must be registered in BACKENDS."""
    names = list(dict.fromkeys(backends))
    if "none" in names and len(names) > 1:
        raise ValueError("'none' excludes other log backends")
    if unknown := [n for n in names if n not in ("none", "local") and n not in BACKENDS]:
        raise ValueError(f"unknown log backends: {', '.join(unknown)}")
    made = [LocalLog(path) if n == "local" else BACKENDS[n](path, name, config or {}) for n in names if n != "none"]
    return NullLog() if not made else made[0] if len(made) == 1 else CompositeLog(made)


def log_of(logging: dict | None, path: str, name: str):
    """The log that an experiment's logging section asks for; a path of its own there replaces the default one."""
    section = logging or {}
    chosen = section.get("backends") or [section.get("backend", "local")]
    return logs(list(chosen), section.get("path") or path, name, section)


def child_logs(logging: dict | None) -> Callable[[str, str], NullLog]:
    """A factory (run name, default path) for the trials and seeds of a run; every child has a file of its own."""
    own = {k: v for k, v in (logging or {}).items() if k != "path"}
    return lambda name, path: log_of(own, path, name)
