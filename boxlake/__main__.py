"""Command line: convert raw sources, merge converted ones, list and resolve plans, evaluate predictions."""

from __future__ import annotations

import argparse
import json
import os
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="boxlake")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert", help="raw source to canonical tables")
    c.add_argument("config")
    c.add_argument("output")
    c.add_argument("-s", "--split", action="append")
    c.add_argument("--rows-per-file", type=int, default=0)
    c.add_argument("--force", action="store_true")
    m = sub.add_parser("merge", help="merge converted sources")
    m.add_argument("--input-root", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--force", action="store_true")
    m.add_argument("--hashing", choices=("sha2", "blake2b"), default="sha2")
    e = sub.add_parser("evaluate", help="score predictions against a converted table")
    e.add_argument("rows")
    e.add_argument("predictions", help="Parquet of image_id, predictions")
    e.add_argument("--classes", required=True)
    e.add_argument("--max-detections", type=int, default=300)
    e.add_argument("--primary-metric", default="map_50_95")
    for name in ("list", "resolve"):
        x = sub.add_parser(f"plan-{name}")
        x.add_argument("plan")
        x.add_argument("--model", action="append")
        if name == "resolve":
            x.add_argument("output")
    d = sub.add_parser("split-pool", help="splits a pool of files by the digests of their contents and prints the counts")
    d.add_argument("files", help="folder of the files")
    d.add_argument("output")
    v = sub.add_parser("driving-export", help="prepares a CSV export of boxes and prints the counts")
    v.add_argument("csv")
    v.add_argument("sizes", help="CSV or Parquet of filename, width, height")
    v.add_argument("output")
    models = sub.add_parser("models", help="train, evaluate, search and final runs").add_subparsers(dest="action", required=True)
    for name in ("train", "optimize"):
        models.add_parser(name).add_argument("config")
    x = models.add_parser("evaluate")
    x.add_argument("config")
    x.add_argument("--artifact", required=True)
    x.add_argument("--split", default="test")
    x.add_argument("--out")
    x = models.add_parser("final")
    x.add_argument("config")
    x.add_argument("--best-trial", required=True)
    x.add_argument("--out")
    plans = models.add_parser("plan").add_subparsers(dest="stage", required=True)
    for name in ("list", "resolve", "optimize", "final", "run"):
        x = plans.add_parser(name)
        x.add_argument("plan")
        if name != "list":
            x.add_argument("--model", action="append")
        if name in ("resolve", "run"):
            x.add_argument("--out")
        if name == "run":
            x.add_argument("--all", action="store_true")
    return p


def models(a) -> list[str]:
    """The models commands; returns the lines to print."""
    from boxlake.plans import runner as R
    from boxlake.plans.experiments import Plan, expand, load_experiment, write_resolved
    from boxlake.plans.tuning import write_json

    if a.action == "plan":
        plan = Plan.load(a.plan)
        if a.stage == "list":
            return [f"{e['model']['key']}\t{e['model']['backend']}" for e in expand(plan)]
        folder = getattr(a, "out", None) or f"runs/resolved_configs/{plan.key}"
        if a.stage == "resolve":
            return write_resolved(plan, folder, a.model)
        if a.stage == "run":
            if not a.model and not a.all:
                raise R.CommandError("plan run needs at least one --model, or --all")
            return R.run_plan(_session(), plan, folder, a.model, a.all)
        out = []
        for e in expand(plan, a.model):
            out += R.run_optimise(_session(), e) if a.stage == "optimize" else [R.run_final(_session(), e)]
        return out
    e = load_experiment(a.config)
    if a.action == "optimize":
        return R.run_optimise(_session(), e)
    if a.action == "final":
        return [R.run_final(_session(), e, a.best_trial, a.out)]
    run = R.Runner(_session(), e)
    if a.action == "train":
        return [write_json(f"{e['train']['output_dir']}/artifact.json", run.train())]
    with open(a.artifact, encoding="utf-8") as f:
        artifact = json.load(f)
    out = a.out or f"{artifact.get('artifact_path') or os.path.dirname(a.artifact) or '.'}/eval_{a.split}.json"
    return [write_json(out, run.evaluate(artifact, a.split, out))]


def split_pool(spark, files: str, output: str) -> dict[str, int]:
    """Writes (path, split) of a pool of files, whose equal contents share a split; returns the counts."""
    from pyspark.sql import functions as F

    from boxlake.operators.splits import digest_split

    pool = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files).select("path", F.sha2("content", 256).cast("binary").alias("digest"))
    digest_split(pool, "digest").select("path", "split").write.mode("overwrite").parquet(output)
    return {r["split"]: r["n"] for r in spark.read.parquet(output).groupBy("split").agg(F.count("*").alias("n")).orderBy("split").collect()}


def driving(spark, csv: str, sizes: str, output: str) -> dict[str, int]:
    """Writes the images and annotations of a driving export; returns the counts per split and of annotations."""
    from pyspark.sql import functions as F

    from boxlake.sources.readers import driving_export

    read = lambda p: spark.read.parquet(p) if p.rstrip("/").endswith(".parquet") else spark.read.option("header", True).csv(p)
    images, notes = driving_export(read(csv), read(sizes).withColumns({c: F.col(c).cast("int") for c in ("width", "height")}))
    images.write.mode("overwrite").parquet(f"{output}/images")
    notes.write.mode("overwrite").parquet(f"{output}/annotations")
    counts = {r["split"]: r["n"] for r in spark.read.parquet(f"{output}/images").groupBy("split").agg(F.count("*").alias("n")).orderBy("split").collect()}
    return {**counts, "annotations": spark.read.parquet(f"{output}/annotations").count()}


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("boxlake").getOrCreate()


def merge(spark, root: str, output: str, force: bool, hashing: str = "sha2") -> dict:
    """Merges root/<source>/<split> of all sources, checks the result and writes it with its manifest."""
    from pyspark.sql import functions as F

    from boxlake.operators import merge as M
    from boxlake.operators.splits import dense_number
    from boxlake.runtime import cleanup, written
    from boxlake.schema import SOURCES
    from boxlake.sources.readers import load_canonical

    folders = {s: f"{root.rstrip('/')}/{s}" for s in SOURCES}
    rows = None
    for source, folder in folders.items():
        part = load_canonical(spark, folder, dataset=source, position="position")
        rows = part if rows is None else rows.unionByName(part)
    try:
        order = M.stable_order(F.col("dataset"), F.col("split"), F.col("position"), F.col("image_id"))
        keyed = dense_number(rows.withColumn("__o", order), "__o", "ref_id").drop("__o", "position")
        keyed = written(keyed.withColumn("index", F.col("ref_id")), "merge-rows")
        linked = written(M.lineage(written(M.row_refs(keyed, hashing=hashing), "merge-refs")), "merge-linked")
        plan = written(M.plan_merge(linked), "merge-plan")
        merged = written(M.build_output(keyed.drop("index"), linked, plan, hashing=hashing), "merged")
        text = M.manifest(keyed, linked, plan, merged)

        def check(df) -> None:
            if bad := M.violations(df).limit(20).collect():
                raise ValueError("; ".join(f"{r['check']}: {r['key']}" for r in bad))
            if (n := df.count()) != json.loads(text)["output"]["rows"]:
                raise ValueError(f"{n} rows were written, the manifest has {json.loads(text)['output']['rows']}")

        M.publish(merged.drop("donor_annotation_hash"), output, tuple(folders.values()), force, check, {"_manifest.json": text})
    finally:
        cleanup(spark)
    return json.loads(text)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "models":
        from boxlake.plans.experiments import PlanError
        from boxlake.plans.runner import CommandError

        try:
            print("\n".join(models(a)))
        except (CommandError, PlanError) as e:
            print(f"error: {e}", file=sys.stderr)
            return 1
        return 0
    from boxlake.runtime import cleanup

    if a.command.startswith("plan-"):
        from boxlake.plans.experiments import Plan, expand, write_resolved

        plan = Plan.load(a.plan)
        if a.command == "plan-list":
            print("\n".join(f"{e['model']['key']}\t{e['model']['backend']}\t{e['train']['run_key']}" for e in expand(plan, a.model)))
        else:
            print("\n".join(write_resolved(plan, a.output, a.model)))
        return 0
    spark = _session()
    try:
        return _run(spark, a)
    finally:
        cleanup(spark)


def _run(spark, a) -> int:
    """The commands that need nothing but a session."""
    if a.command == "split-pool":
        print(json.dumps(split_pool(spark, a.files, a.output), indent=2))
    elif a.command == "driving-export":
        print(json.dumps(driving(spark, a.csv, a.sizes, a.output), indent=2))
    elif a.command == "convert":
        from boxlake.sources.config import load
        from boxlake.sources.readers import convert

        print(json.dumps(convert(spark, load(a.config), a.output, a.split, a.force, a.rows_per_file), indent=2))
    elif a.command == "merge":
        print(json.dumps(merge(spark, a.input_root, a.output, a.force, a.hashing)["output"], indent=2))
    else:
        from pyspark.sql import functions as F

        from boxlake.operators import evaluate as E
        from boxlake.operators import splits as S
        from boxlake.operators import targets as T

        classes = [c.strip() for c in a.classes.split(",")]
        rows = spark.read.parquet(a.rows).drop("image")
        parsed = T.parse_targets(rows, classes).select("image_id", F.posexplode("targets").alias("pos", "t")).select("image_id", "pos", "t.label", "t.x", "t.y", "t.w", "t.h", "t.iscrowd")
        p = spark.read.parquet(a.predictions).select("image_id", F.posexplode("predictions").alias("pos", "p")).select("image_id", "pos", "p.*")
        images = S.dense_number(T.sample_groups(rows), "image_id", "ord")
        result = E.evaluate(parsed, p, images, classes, a.max_detections)
        E.require_metric(result, a.primary_metric)
        print(json.dumps([r.asDict() for r in result.orderBy("scope", "grp", "metric").collect()], indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
