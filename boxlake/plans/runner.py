"""Experiments from end to end: train, evaluate, search, final runs, alone or for all models of a plan."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.operators.evaluate import required
from boxlake.plans.adapters import ModelAdapter, adapter_of
from boxlake.plans.experiments import Plan, deep_merge, expand, write_resolved
from boxlake.plans.tuning import aggregate_seeds, check_controlled, child_logs, final_seeds, log_of, optimise, require_single_process, write_json


def effective_batch(experiment: dict) -> dict:
    """The batch that all processes of a run make together."""
    size, world = int(experiment["train"].get("batch_size", 1)), int(os.environ.get("WORLD_SIZE", "1") or 1)
    return {"batch_size": size, "world_size": world, "gradient_accumulation": False, "effective_batch_size": size * world}


def steps_per_epoch(n_batches: int) -> int:
    """Optimizer steps of an epoch: its batches, at least one."""
    if n_batches <= 0:
        raise ValueError("an epoch needs at least one batch")
    return int(n_batches)


def worker_options(loader: dict) -> dict:
    """A loader's options; those of workers only where there are workers."""
    out = {"num_workers": int(loader.get("num_workers", 0)), "pin_memory": bool(loader.get("pin_memory", False))}
    if out["num_workers"] > 0:
        out |= {"persistent_workers": bool(loader.get("persistent_workers", False)), **({"prefetch_factor": int(loader["prefetch_factor"])} if loader.get("prefetch_factor") is not None else {})}
    return out


def checkpoint_manifest(history: list[dict], metric: str, seed: int | None = None) -> dict:
    """Which epoch's checkpoint is best and last, from (epoch, metrics) rows: the strictly greatest value, the earliest on ties."""
    rows = [(int(h["epoch"]), h.get("metrics", {}).get(metric)) for h in history]
    best = max(((v, -e) for e, v in rows if v is not None), default=None)
    return {"metric": metric, "seed": seed, "epochs": [e for e, _ in rows], "best_epoch": -best[1] if best else None, "best_value": best[0] if best else None, "last_epoch": rows[-1][0] if rows else None}


class Runner:
    """Runs one experiment with the adapter of its model; rows come from the folder its dataset names."""

    def __init__(self, spark: SparkSession, experiment: dict, adapter: ModelAdapter | None = None) -> None:
        self.spark, self.experiment = spark, experiment
        self.adapter = adapter or adapter_of(experiment.get("model") or {})

    def rows(self, split: str) -> DataFrame:
        """Canonical rows of one of the dataset's splits: a folder per split, or a table with a split column."""
        path = self.experiment["dataset"]["path"].rstrip("/")
        p = lambda x: self.spark._jvm.org.apache.hadoop.fs.Path(x)
        fs = p(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = sorted(f.getPath().getName() for f in fs.listStatus(p(path)) if f.isDirectory())
        if split in found:
            return self.spark.read.parquet(f"{path}/{split}").withColumn("split", F.lit(split))
        named = [f.removeprefix("split=") for f in found if f.startswith("split=")]
        if split in named:
            return self.spark.read.parquet(path).filter(F.col("split") == split)
        raise KeyError(f"no split {split!r}; available: {', '.join(named or found) or 'none'}")

    def split(self, which: str) -> DataFrame:
        """The rows of the train, val or test split, under whatever name the dataset gives it."""
        return self.rows(self.experiment["dataset"].get(f"{which}_split", which))

    def config(self) -> dict:
        return {**self.experiment, "batch": effective_batch(self.experiment)}

    def _logged(self, log, name: str, work, config: dict | None = None):
        """work(log) between the log's start and its end, which tells a failure."""
        state, error = "finished", None
        try:
            log.start(name, config or self.config())
            log.log({"run/started": 1}, 0)
            return work(log)
        except Exception as e:
            state, error = "failed", repr(e)
            raise
        finally:
            log.finish(state, error)

    def train(self) -> dict:
        e = self.experiment
        log = log_of(e.get("logging"), f"{e['train']['output_dir']}/logs/events.jsonl", e["train"]["run_key"])
        each = e["eval"] if (e["train"].get("eval_strategy") or {}).get("enabled") else None

        def work(log) -> dict:
            artifact = self.adapter.train(self.split("train"), self.split("val"), e["train"], each, log)
            if artifact.get("checkpoint_path"):
                log.artifact(artifact["checkpoint_path"], "checkpoint")
            return artifact

        return self._logged(log, e["train"]["run_key"], work)

    def evaluate(self, artifact: dict, split: str = "test", out: str | None = None) -> dict:
        e = self.experiment
        folder = os.path.dirname(out) if out else f"{artifact.get('artifact_path') or e['train']['output_dir']}/logs"
        name = f"{artifact.get('run_key')}_eval_{split}"

        def work(log) -> dict:
            result = self.adapter.evaluate(self.rows(split), artifact, e["eval"], log, f"eval/{split}")
            if out:
                log.artifact(out, f"eval_{split}")
            return result

        return self._logged(log_of(e.get("logging"), f"{folder}/events.jsonl", name), name, work)

    def optimise(self) -> dict:
        """The search over learning rates: every trial trains without early stopping and is scored on val."""
        e, tuning = self.experiment, self.experiment.get("tuning")
        if not tuning:
            raise ValueError("the experiment has no tuning section")
        if not e.get("search_space"):
            raise ValueError("the experiment has no search_space")
        require_single_process("a search")
        check_controlled(e["search_space"], tuning)
        metric, make = tuning.get("objective_metric", "map_50_95"), child_logs(e.get("logging"))
        train, val = self.split("train"), self.split("val")
        held: dict[int, dict] = {}

        def objective(settings: dict, n: int) -> float:
            folder, name = f"{tuning['output_dir']}/trial_{n:04d}", f"{tuning['study_name']}_trial_{n:04d}"
            own = deep_merge(settings["train"], {"output_dir": folder, "max_epochs": tuning.get("trial_epochs", settings["train"].get("max_epochs", 1)), "seed": tuning.get("seed", 0), "eval_strategy": {"enabled": False}, "early_stopping": {"enabled": False}})
            hparams = settings["train"]["hparams"]
            held[n] = {"resolved_train_config": own}

            def work(log) -> float:
                log.start_trial(n, hparams)
                try:
                    artifact = self.adapter.train(train, val, own, None, log)
                    if artifact.get("checkpoint_path"):
                        log.artifact(artifact["checkpoint_path"], "checkpoint")
                    value = required(self.adapter.evaluate(val, artifact, e["eval"], log, "val")["metrics"], metric)
                except Exception as error:
                    log.finish_trial("failed", repr(error))
                    raise
                held[n] |= {"artifact_path": artifact.get("artifact_path"), "checkpoint_path": artifact.get("checkpoint_path")}
                log.log({f"objective/{metric}": value})
                log.finish_trial("complete")
                return value

            return self._logged(make(name, f"{folder}/logs/events.jsonl"), name, work, {**self.config(), "trial": {"number": n, "hparams": hparams, "resolved_train_config": own}})

        out = optimise(e, objective, int(tuning.get("n_trials", 8)), int(tuning.get("seed", 0)), bool(tuning.get("catch_trial_errors")), tuning.get("direction", "maximize") == "maximize", tuning.get("sampler", "random"))
        for t in out["trials"]:
            t |= {"metric": metric, **held.get(t["trial"], {})}
        return {"study_name": tuning.get("study_name"), **out}

    def final(self, best: dict, output: str | None = None) -> list[dict]:
        """The best settings once per seed, scored on val and test; no seed is chosen."""
        require_single_process("final runs")
        e = self.experiment
        section, make = e.get("final") or {}, child_logs(e.get("logging"))
        base = output or section.get("output_dir") or f"{e['train']['output_dir']}/final"

        def run(settings: dict, seed: int) -> dict:
            folder, name, done = f"{base}/final_seed{seed}", f"{e['train']['run_key']}_final_seed{seed}", {}
            own = deep_merge(settings["train"], {"run_key": f"{e['train']['run_key']}_seed{seed}", "output_dir": folder})

            def work(log) -> dict:
                done["artifact"] = self.adapter.train(self.split("train"), self.split("val"), own, e["eval"], log)
                if section.get("evaluate_val", True):
                    done["val"] = self.adapter.evaluate(self.split("val"), done["artifact"], e["eval"], log, "val")
                done["test"] = self.adapter.evaluate(self.split("test"), done["artifact"], e["eval"], log, "test")
                if done["artifact"].get("checkpoint_path"):
                    log.artifact(done["artifact"]["checkpoint_path"], "checkpoint")
                return done

            try:
                return self._logged(make(name, f"{folder}/logs/events.jsonl"), name, work, {**self.config(), "final": {"seed": seed, "hparams": own.get("hparams"), "resolved_train_config": own}})
            except Exception as error:
                error.partial = done
                write_json(f"{folder}/partial.json", done)
                raise

        return final_seeds(e, best, run)


def final_results(runs: list[dict]) -> dict:
    """What a final stage leaves: aggregates over the seeds that finished, and every run."""
    ok = [r for r in runs if r["state"] == "complete"]
    return {"aggregate": {"successful_seeds": len(ok), "failed_seeds": len(runs) - len(ok), "val": aggregate_seeds(runs, "val"), "test": aggregate_seeds(runs, "test")}, "runs": runs}


class CommandError(Exception):
    """What a command cannot do, said in one line."""


def best_trial_path(experiment: dict) -> str:
    if not experiment.get("tuning"):
        raise CommandError(f"experiment {experiment['train'].get('run_key')!r} has no tuning section")
    return f"{experiment['tuning']['output_dir']}/best_trial.json"


def run_optimise(spark: SparkSession, experiment: dict) -> list[str]:
    """A search and its files: tuning_result.json, and best_trial.json if a trial finished."""
    try:
        result = Runner(spark, experiment).optimise()
    except (ValueError, NotImplementedError) as e:
        raise CommandError(str(e)) from e
    folder = experiment["tuning"]["output_dir"]
    out = [write_json(f"{folder}/tuning_result.json", result)]
    if result["best"] is not None:
        out.append(write_json(f"{folder}/best_trial.json", {**result["best"], "study_name": result["study_name"], "warning": result["warning"]}))
    return out


def run_final(spark: SparkSession, experiment: dict, best: str | None = None, out: str | None = None) -> str:
    """Final runs of the best trial in a file, and their results in another."""
    best = best or best_trial_path(experiment)
    if not os.path.exists(best):
        raise CommandError(f"missing best trial file: {best}")
    with open(best, encoding="utf-8") as f:
        trial = json.load(f)
    folder = (experiment.get("final") or {}).get("output_dir") or f"{experiment['train']['output_dir']}/final"
    return write_json(out or f"{folder}/final_results.json", final_results(Runner(spark, experiment).final(trial, folder)))


def final_all(spark: SparkSession, plan: Plan, best: dict[str, dict], models: list[str] | None = None) -> dict[str, list[dict]]:
    """Final runs of every model of a plan; a model without a best trial raises before any runs."""
    experiments = expand(plan, models)
    if missing := [e["model"]["key"] for e in experiments if e["model"]["key"] not in best]:
        raise KeyError(f"no best trial for {', '.join(missing)}")
    return {e["model"]["key"]: Runner(spark, e).final(best[e["model"]["key"]]) for e in experiments}


def run_plan(spark: SparkSession, plan: Plan, folder: str, models: list[str] | None = None, every: bool = False) -> list[str]:
    """Resolves, searches and runs the final stage of the named models of a plan, or of all."""
    if not models and not every:
        raise CommandError("plan run needs at least one --model, or --all")
    out = write_resolved(plan, folder, models or None)
    for e in expand(plan, models or None):
        out += run_optimise(spark, e)
        out.append(run_final(spark, e))
    return out
