"""Experiments driven from the command line with the reference adapter, and the loops' rules."""

import json
import math

import pytest
import yaml

from boxlake.__main__ import main
from boxlake.plans import runner as R
from boxlake.plans import tuning as U
from boxlake.plans.adapters import ADAPTERS, ModelAdapter, adapter_of, register
from boxlake.plans.experiments import PlanError, checked
from boxlake.schema import CANONICAL
from tests.pictures import png

SPACE = {"learning_rate": {"type": "float", "low": 3e-6, "high": 3e-3, "log": True}}


@pytest.fixture
def experiment(spark, tmp_path):
    o = lambda x, m: ([x, 4.0, 8.0, 10.0], m, "1", m, False, False, "{}")
    for split in ("train", "val", "test"):
        rows = [((bytearray(png(32, 24)), "p"), f"a:{split}:{i}", "a", split, "p", 32, 24, "clear", "general", False, [o(4.0, "car")] + [o(12.0, "bus")] * (i % 2), "{}") for i in range(4)]
        spark.createDataFrame(rows, CANONICAL).write.parquet(str(tmp_path / "data" / split))
    e = {
        "dataset": {"path": str(tmp_path / "data"), "train_split": "train", "val_split": "val", "test_split": "test"}, "classes": ["car", "bus"],
        "model": {"key": "m", "backend": "reference", "preprocess": {"resize_mode": "letterbox", "height": 64, "width": 64}},
        "train": {"run_key": "m_a", "output_dir": str(tmp_path / "runs"), "batch_size": 4, "max_epochs": 2}, "eval": {"max_detections_per_image": 10}, "search_space": SPACE,
        "tuning": {"study_name": "s", "output_dir": str(tmp_path / "hpo"), "n_trials": 3, "sampler": "tpe"}, "final": {"seeds": [0, 1]}, "logging": {"backend": "local"},
    }
    (tmp_path / "e.yaml").write_text(yaml.safe_dump(e))
    return tmp_path, e


def events(path):
    return [json.loads(x) for x in path.read_text().splitlines()]


def test_commands(experiment, capsys):
    tmp, e = experiment
    config = str(tmp / "e.yaml")
    assert main(["models", "train", config]) == 0
    artifact = json.loads((tmp / "runs/artifact.json").read_text())
    assert set(artifact["boxes"]) == {"car", "bus"} and [x["event"] for x in events(tmp / "runs/logs/events.jsonl")] == ["start_run", "metrics", "finish_run"]
    assert main(["models", "evaluate", config, "--artifact", str(tmp / "runs/artifact.json"), "--out", str(tmp / "x/eval.json")]) == 0
    result = json.loads((tmp / "x/eval.json").read_text())
    assert result["counts"] == {"num_images": 4, "num_ground_truth": 6, "num_predictions": 8, "num_dropped_boxes": 0} and 0 <= result["metrics"]["map_50_95"] <= 1 and "car" in result["per_class"]
    logged = events(tmp / "x/events.jsonl")
    assert [x["event"] for x in logged] == ["start_run", "metrics", "eval_result", "artifact", "finish_run"] and "eval/test/map_50_95" in logged[2]["metrics"] and "eval/test/per_condition/clear/map_50" in logged[2]["metrics"]
    assert main(["models", "optimize", config]) == 0
    best = json.loads((tmp / "hpo/best_trial.json").read_text())
    tuned = json.loads((tmp / "hpo/tuning_result.json").read_text())
    assert len(tuned["trials"]) == 3 and best["value"] == max(t["value"] for t in tuned["trials"]) and best["metric"] == "map_50_95" and best["resolved_train_config"]["eval_strategy"] == {"enabled": False}
    assert [x["event"] for x in events(tmp / "hpo/trial_0000/logs/events.jsonl")] == ["start_run", "metrics", "start_trial", "eval_result", "metrics", "finish_trial", "finish_run"]
    assert main(["models", "final", config, "--best-trial", str(tmp / "hpo/best_trial.json"), "--out", str(tmp / "final.json")]) == 0
    final = json.loads((tmp / "final.json").read_text())
    assert final["aggregate"]["successful_seeds"] == 2 and final["aggregate"]["test"]["map_50_95"]["std"] == 0.0 and [r["seed"] for r in final["runs"]] == [0, 1]
    assert main(["models", "final", config, "--best-trial", str(tmp / "none.json")]) == 1 and "missing best trial" in capsys.readouterr().err


def test_plan_commands(experiment, capsys):
    tmp, e = experiment
    write = lambda n, d: (tmp / n).write_text(yaml.safe_dump(d))
    write("d.yaml", {"key": "a", **e["dataset"]})
    write("c.yaml", {"classes": e["classes"]})
    write("r.yaml", {"train": {"batch_size": 4, "max_epochs": 1}, "eval": {"max_detections_per_image": 10}, "tuning": {"n_trials": 2}, "final": {"seeds": [0]}, "logging": {"backend": "local"}, "search_space_file": "s.yaml"})
    write("s.yaml", SPACE)
    write("m.yaml", e["model"])
    out = {k: str(tmp / "p") + "/{model_key}" + x for k, x in (("output_dir", ""), ("tuning_output_dir", "/hpo"), ("final_output_dir", "/final"))}
    write("plan.yaml", {"key": "p", "dataset_file": "d.yaml", "class_space_file": "c.yaml", "recipe_file": "r.yaml", "model_files": ["m.yaml"], "backend_defaults": {"reference": {}}, "run_template": out})
    plan = str(tmp / "plan.yaml")
    assert main(["models", "plan", "list", plan]) == 0 and capsys.readouterr().out.strip() == "m\treference"
    assert main(["models", "plan", "run", plan]) == 1 and "--all" in capsys.readouterr().err
    assert main(["models", "plan", "final", plan]) == 1 and "missing best trial" in capsys.readouterr().err
    assert main(["models", "plan", "resolve", plan, "--out", str(tmp / "resolved")]) == 0 and (tmp / "resolved/m.yaml").exists()
    assert main(["models", "plan", "run", plan, "--all", "--out", str(tmp / "resolved")]) == 0
    assert json.loads((tmp / "p/m/final/final_results.json").read_text())["aggregate"]["successful_seeds"] == 1
    assert main(["models", "plan", "optimize", plan, "--model", "m"]) == 0
    with pytest.raises(KeyError, match="no best trial"):
        R.final_all(None, R.Plan.load(plan), {})


def test_controlled_rules(experiment, monkeypatch):
    tmp, e = experiment
    for change, match in (({"tuning": {**e["tuning"], "early_stopping": True}}, "early_stopping"), ({"search_space": {**SPACE, "x": {"type": "int", "low": 1, "high": 2}}}, "learning_rate"), ({"tuning": None}, "no tuning"), ({"search_space": None}, "no search_space")):
        with pytest.raises(ValueError, match=match):
            R.Runner(None, {**e, **change}).optimise()
    monkeypatch.setenv("WORLD_SIZE", "2")
    with pytest.raises(RuntimeError, match="single process"):
        R.Runner(None, e).optimise()
    assert R.effective_batch(e)["effective_batch_size"] == 8
    with pytest.raises(NotImplementedError, match="hf_trainer"):
        adapter_of({"backend": "hf_trainer"})
    with pytest.raises(KeyError, match="available: test, train, val"):
        from pyspark.sql import SparkSession

        R.Runner(SparkSession.getActiveSession(), e).rows("dev")


def test_failed_seed_keeps_its_parts(experiment, spark):
    tmp, e = experiment

    @register("failing")
    class Failing(ModelAdapter):
        def train(self, train, val, settings, evaluation=None, log=None):
            return {"run_key": "x", "artifact_path": None, "checkpoint_path": str(tmp / "c"), "seed": settings["seed"]}

        def predict(self, rows, artifact, settings):
            raise RuntimeError("no predictions")

    try:
        runs = R.Runner(spark, {**e, "model": {**e["model"], "backend": "failing"}}).final({"hparams": {"learning_rate": 1e-4}}, str(tmp / "f"))
    finally:
        ADAPTERS.pop("failing")
    assert [r["state"] for r in runs] == ["failed", "failed"] and runs[0]["result"]["artifact"]["seed"] == 0 and "no predictions" in runs[1]["error"]
    assert json.loads((tmp / "f/final_seed0/partial.json").read_text())["artifact"]["seed"] == 0 and R.final_results(runs)["aggregate"]["failed_seeds"] == 2


def test_boundary_and_sampler():
    s = SPACE
    assert "lower" in U.boundary_warning({"learning_rate": 3e-6}, s) and "upper" in U.boundary_warning({"learning_rate": 3e-3}, s) and U.boundary_warning({"learning_rate": math.sqrt(9e-9)}, s) is None
    assert U.boundary_warning({}, s) is None and U.boundary_warning({"learning_rate": 1.0}, {"learning_rate": {"type": "int", "low": 1, "high": 2}}) is None
    score = lambda e, n: -abs(math.log10(e["train"]["hparams"]["learning_rate"]) + 4)
    tree = [U.optimise({"search_space": s}, score, 20, seed, sampler="tpe")["best"]["value"] for seed in range(5)]
    assert sum(tree) / 5 > -0.1 and U.optimise({"search_space": s}, score, 4, 1, sampler="tpe") == U.optimise({"search_space": s}, score, 4, 1, sampler="tpe")
    r = U.optimise({"search_space": s}, lambda e, n: math.nan, 2, catch=True)
    assert r["best"] is None and r["warning"] is None and all(t["state"] == "failed" for t in r["trials"])


def test_settings():
    base = {"model": {"key": "m", "backend": "reference"}, "classes": ["a"], "train": {}}
    for section, bad in (("train", {"optimizer": {"beta1": 1.0}}), ("train", {"augmentation": {"policy": "x"}}), ("train", {"loader": {"prefetch_factor": 0}}), ("train", {"run_key": " "}), ("eval", {"conf_threshold": 2}), ("tuning", {"sampler": "grid"}), ("train", {"optimizer": {"epsilon": 0}}), ("train", {"batch_size": "x"})):
        with pytest.raises(PlanError):
            checked({**base, section: {**base.get(section, {}), **bad}})
    assert checked({**base, "train": {"optimizer": {"beta1": 0.9}, "scheduler": {"min_lr_ratio": 0.01}}})
    assert R.worker_options({"num_workers": 0, "prefetch_factor": 4}) == {"num_workers": 0, "pin_memory": False} and R.worker_options({"num_workers": 2, "prefetch_factor": 4})["prefetch_factor"] == 4
    m = R.checkpoint_manifest([{"epoch": 1, "metrics": {"m": 0.3}}, {"epoch": 2, "metrics": {"m": 0.3005}}, {"epoch": 3, "metrics": {"m": 0.3005}}], "m")
    assert (m["best_epoch"], m["last_epoch"]) == (2, 3) and R.steps_per_epoch(3) == 3
    with pytest.raises(ValueError):
        R.steps_per_epoch(0)
