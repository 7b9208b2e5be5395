import pytest
import yaml

from boxlake.plans import experiments as P
from boxlake.plans.tuning import CompositeLog, NullLog, final_seeds, logs, optimise


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(yaml.safe_dump(data))


@pytest.fixture
def plan(tmp_path):
    write(tmp_path / "d/data.yaml", {"key": "hazy", "path": "data/hazy", "train_split": "train"})
    write(tmp_path / "c.yaml", {"classes": ["car", " bus "]})
    write(tmp_path / "r/recipe.yaml", {"protocol": "controlled", "search_space_file": "../s.yaml", "train": {"batch_size": 16}, "eval": {}, "logging": {"wandb": {"tags": ["a"]}}})
    write(tmp_path / "s.yaml", {"learning_rate": {"type": "float", "low": 3e-6, "high": 3e-3, "log": True}})
    for k in ("m1", "m2"):
        write(tmp_path / f"m/{k}.yaml", {"key": k, "backend": "ultralytics", "preprocess": {"resize_mode": "letterbox", "height": 640, "width": 640}})
    write(tmp_path / "m/group.yaml", {"models": ["m1.yaml", "m2.yaml"]})
    body = {"key": "P", "dataset_file": "d/data.yaml", "class_space_file": "c.yaml", "recipe_file": "r/recipe.yaml", "model_group_file": "m/group.yaml", "backend_defaults": {"ultralytics": {"train": {"loader": {"num_workers": 16}}}}, "model_overrides": {"m2": {"train": {"loader": {"num_workers": 2}}}}, "tags": ["a", "b"]}
    write(tmp_path / "plan.yaml", body)
    return tmp_path / "plan.yaml", body


def test_expand(plan, spark):
    p = P.Plan.load(str(plan[0]))
    a, b = P.expand(p)
    assert a["train"]["run_key"] == "m1_hazy_controlled" and a["train"]["loader"]["num_workers"] == 16 and b["train"]["loader"]["num_workers"] == 2
    assert a["classes"] == ["car", "bus"] and a["eval"]["classes"] == ["car", "bus"] and a["eval"]["preprocess"]["height"] == 640 and a["logging"]["wandb"]["tags"] == ["a", "b"]
    assert [e["model"]["key"] for e in P.expand(p, ["m2"])] == ["m2"]
    with pytest.raises(P.PlanError, match="no models"):
        P.expand(p, ["m9"])
    assert P.plan_table(spark, [p]).count() == 2
    assert len(P.write_resolved(p, str(plan[0].parent / "out"))) == 2


def test_rejections(plan):
    path, body = plan
    for change, match in (({"model_overrides": {"m1": {"search_space": {}, "search_space_file": "x"}}}, "search space"), ({"backend_defaults": {}}, "no defaults"), ({"run_template": {"run_key": "{nothing}"}}, "unknown variable")):
        write(path, {**body, **change})
        with pytest.raises(P.PlanError, match=match):
            P.expand(P.Plan.load(str(path)))
    for bad in ({"resize_mode": "letterbox", "height": 2, "width": 3}, {"resize_mode": "exact", "height": 2}, {"resize_mode": "shortest_edge", "shortest_edge": 5, "longest_edge": 3}):
        with pytest.raises(P.PlanError):
            P.check_preprocess(bad)
    with pytest.raises(P.PlanError):
        P.check_search_space({"a": {"type": "float", "low": 0, "high": 1, "log": True}})


def test_deep_merge():
    base = {"a": {"b": 1, "c": [1, 2]}, "d": 1}
    assert P.deep_merge(base, {"a": {"c": [3]}, "e": 2}) == {"a": {"b": 1, "c": [3]}, "d": 1, "e": 2} and base["a"]["c"] == [1, 2]


def test_loops():
    e = {"search_space": {"learning_rate": {"type": "float", "low": 1e-5, "high": 1e-2, "log": True}}, "final": {"seeds": [0, 1]}}

    def objective(settings, n):
        if n == 0:
            raise RuntimeError("no")
        return {1: 0.3, 2: 0.2, 3: 0.3}[n]

    r = optimise(e, objective, 4, catch=True)
    assert (r["best"]["trial"], r["best"]["value"]) == (1, 0.3) and r["trials"][0]["error"]
    with pytest.raises(RuntimeError):
        optimise(e, objective, 1)

    def run(settings, seed):
        if seed:
            raise ValueError("x")
        return {"m": 1}

    f = final_seeds(e, r["best"], run)
    assert f[0]["result"] == {"m": 1} and f[1]["error"] and len(P.grid(e["search_space"], 3)) == 3
    with pytest.raises(ValueError):
        final_seeds(e, {"hparams": {}}, run)


def test_logs(tmp_path):
    done = []

    class Log(NullLog):
        def __init__(self, n):
            self.n = n

        def finish(self, status="finished"):
            done.append(self.n)

    CompositeLog([Log(1), Log(2)]).finish()
    assert done == [2, 1]
    x = logs(["local", "local"], str(tmp_path / "l.jsonl"))
    x.log({"a": 1}, 2)
    x.finish()
    assert len((tmp_path / "l.jsonl").read_text().splitlines()) == 2
    with pytest.raises(ValueError):
        logs(["none", "local"], "x")
