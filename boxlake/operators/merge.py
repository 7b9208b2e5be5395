"""Merging sources: object filtering, lineage, representatives and donors, output rows, manifest and checks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions.digests import annotations_blake2b, blake2b
from boxlake.functions.objects import json_object, object_text, updated
from boxlake.operators.components import min_label_components
from boxlake.operators.splits import dense_number
from boxlake.runtime import written
from boxlake.schema import FINAL_CLASSES, HAZY_PAIR, SOURCES, SPLIT_PRIORITY, SPLITS

#: Metadata of rows that the manifest lists.
LISTED_META = ("homepage", "license", "source_annotation_format")


def rank_of(c: Column, names) -> Column:
    """The position of a name in a list; one past its end for any other."""
    out = F.lit(len(names))
    for i, name in enumerate(names):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


def stable_order(dataset: Column, split: Column, index: Column, image_id: Column, *more: Column) -> Column:
    """The fixed order of records: source, split, position in the source, image."""
    return F.struct(rank_of(dataset, SOURCES).alias("a"), rank_of(split, SPLITS).alias("b"), index.alias("c"), image_id.alias("d"), *more)


def object_status(o: Column) -> Column:
    """ignored, excluded (not one of the final classes) or retained."""
    return F.when(F.coalesce(o["ignore"], F.lit(False)), "ignored").when(F.coalesce(o["meta_label"].isin(*FINAL_CLASSES), F.lit(False)), "retained").otherwise("excluded")


def retained_objects(df: DataFrame, strict: bool = True) -> DataFrame:
    """df with total, ignored, excluded and `objects` as the merge keeps them: final classes, float32 boxes.

    A retained object whose box the merge cannot store raises (strict) or is left out. Null objects count as excluded.
    """
    objects = F.coalesce(F.col("objects"), F.array())
    status = F.transform(objects, lambda o: F.coalesce(object_status(o), F.lit("excluded")))
    df = df.withColumn("__s", status)
    count = lambda what: F.size(F.filter("__s", lambda s: s == what))

    def kept(o: Column) -> Column:
        b = G.from_array(o["bbox"])
        box = G.checked(b, F.col("width"), F.col("height"))
        if strict:
            box = F.when(box.isNull(), F.raise_error(F.concat(F.lit("invalid box in "), F.col("image_id"))).cast(G.BOX)).otherwise(box)
        return F.struct(box.alias("box"), o.alias("o"))

    found = F.transform(F.filter(objects, lambda o: F.coalesce(object_status(o) == "retained", F.lit(False))), kept)
    found = F.filter(found, lambda k: k["box"].isNotNull())
    plain = F.transform(found, lambda k: F.struct(
        F.transform(G.xywh(k["box"]), lambda v: v.cast("float")).alias("bbox"), F.coalesce(k["o"]["native_label"], F.lit("")).alias("native_label"), k["o"]["native_label_id"].alias("native_label_id"),
        k["o"]["meta_label"].alias("meta_label"), F.lit(False).alias("ignore"), F.coalesce(k["o"]["iscrowd"], F.lit(False)).alias("iscrowd"), k["o"]["meta_json"].alias("meta_json")))
    df = df.withColumn("total", F.size("__s")).withColumn("ignored", count("ignored")).withColumn("excluded", count("excluded"))
    return df.withColumn("objects", plain).drop("__s")


def class_counts(objects: Column) -> Column:
    """Sorted array<struct<class_name, n>> of retained objects."""
    names = F.transform(objects, lambda o: o["meta_label"])
    return F.transform(F.array_sort(F.array_distinct(names)), lambda c: F.struct(c.alias("class_name"), F.size(F.filter(names, lambda x: x == c)).alias("n")))


def annotation_hash(objects: Column) -> Column:
    """A hash of the boxes, labels and crowd flags in their order; equal for equal annotations only."""
    parts = F.transform(objects, lambda o: F.struct(o["bbox"].alias("bbox"), o["iscrowd"].alias("iscrowd"), o["meta_label"].alias("meta_label")))
    return F.sha2(F.to_json(parts).cast("binary"), 256)


def row_refs(rows: DataFrame, strict: bool = True, hashing: str = "sha2") -> DataFrame:
    """Slim descriptors of canonical rows (with a position `index`), one per row; the pixels are read for their hash only.

    A ref_id of the rows is kept. hashing: 'sha2', computed inside the JVM, or 'blake2b' where hashes must equal those
    of tables made elsewhere.
    """
    if hashing not in ("sha2", "blake2b"):
        raise ValueError(f"unknown hashing {hashing!r}")
    kept = retained_objects(rows, strict)
    meta = F.get_json_object("meta_json", "$.source_image_id")
    content = F.sha2("image.bytes", 256) if hashing == "sha2" else blake2b(F.col("image.bytes"), 32)
    annotations = annotation_hash(F.col("objects")) if hashing == "sha2" else annotations_blake2b(F.col("objects"))
    return kept.select(
        *[c for c in ("ref_id",) if c in rows.columns], "dataset", "split", "index", "image_id", "width", "height", content.alias("content_hash"), meta.alias("source_image_id"),
        F.size("objects").alias("object_count"), class_counts(F.col("objects")).alias("class_counts"), annotations.alias("annotation_hash"), "total", "ignored", "excluded",
    )


def lineage(refs: DataFrame, node: str = "ref_id") -> DataFrame:
    """refs with component: the smallest node of the records tied by equal content or, for the hazy pair, source image.

    Each shared key ties its records to the smallest of them, so a key that very many records share costs one edge each.
    A record whose hash is missing ties through its source image only.
    """
    keys = F.array(
        F.struct(F.lit("h").alias("k"), F.col("content_hash").alias("v")),
        F.struct(F.lit("s").alias("k"), F.when(F.col("dataset").isin(*HAZY_PAIR), F.col("source_image_id")).alias("v")),
    )
    held = refs.select(F.col(node).alias("a"), F.explode(keys).alias("x")).select("a", "x.k", "x.v").filter("v is not null")
    least = held.groupBy("k", "v").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = held.join(least, ["k", "v"]).select("a", "b")
    parts = min_label_components(edges, "a", "b").withColumnRenamed("node", node)
    return refs.join(parts, node, "left").withColumn("component", F.coalesce("component", F.col(node)))


def components_summary(refs: DataFrame, node: str = "ref_id") -> DataFrame:
    """Per component: donor, protected split, sizes. refs: output of lineage().

    The donor has the most classes, then the most objects, then comes first in the stable order, over all splits; the
    protected split is the best protected one present. Aggregates only, so a component of any size is one row per task.
    """
    order = stable_order(F.col("dataset"), F.col("split"), F.col("index"), F.col("image_id"), F.col(node).alias("e"))
    classes = F.coalesce(F.size("class_counts"), F.lit(0))
    donor = F.min(F.struct((-classes).alias("c"), (-F.coalesce("object_count", F.lit(0))).alias("n"), order.alias("o")))
    priority = F.max(F.coalesce(*[F.when(F.col("split") == s, F.lit(p)) for s, p in SPLIT_PRIORITY.items()], F.lit(-1)))
    size = F.struct("width", "height")
    g = refs.groupBy("component").agg(
        F.count("*").alias("n_members"), donor.alias("d"), priority.alias("protection"), F.min(size).alias("lo"), F.max(size).alias("hi"), F.min(order).alias("first"),
        F.count_if(F.coalesce("object_count", F.lit(0)) > 0).alias("n_annotated"),
    )
    split = F.lit(None).cast("string")
    for s, p in SPLIT_PRIORITY.items():
        split = F.when(F.col("protection") == p, F.lit(s)).otherwise(split)
    return g.select("component", "n_members", F.col("d.o.e").alias("donor_id"), (-F.col("d.n")).alias("donor_objects"), split.alias("protected_split"), (F.col("lo") != F.col("hi")).alias("mismatched"), F.col("first.e").alias("first_member"))


def plan_merge(refs: DataFrame, node: str = "ref_id", strict: bool = True) -> DataFrame:
    """(representative_id, donor_id, component, n_members, n_same, n_protected) of the rows the merge puts out.

    One representative per component and content among the members in the protected split; components whose donor has
    no objects give none. Members of different sizes raise (strict) before anything is dropped, else their whole
    component is left out, and left_out() counts it.
    """
    summary = components_summary(refs, node)
    if strict:
        bad = F.raise_error(F.concat(F.lit("cannot transfer annotations across mismatched dimensions: component of "), F.col("first_member").cast("string")))
        summary = summary.withColumn("donor_id", F.when(F.col("mismatched"), bad.cast(refs.schema[node].dataType)).otherwise(F.col("donor_id")))
    else:
        summary = summary.filter(~F.col("mismatched"))
    summary = summary.filter("donor_objects > 0")
    order = stable_order(F.col("dataset"), F.col("split"), F.col("index"), F.col("image_id"), F.col(node).alias("e"))
    held = refs.join(summary, "component").filter("split = protected_split")
    # Records without a hash are each a content of their own.
    content = F.coalesce("content_hash", F.concat(F.lit("ref:"), F.col(node).cast("string"))).alias("content")
    same = held.groupBy("component", content).agg(F.min(order).alias("r"), F.count("*").alias("n_same"))
    return same.join(summary, "component").select(F.col("r.e").alias("representative_id"), "donor_id", "component", "n_members", "n_same")


def merge_stats(refs: DataFrame, plan: DataFrame, node: str = "ref_id") -> DataFrame:
    """One row of the merge's counters."""
    summary = components_summary(refs, node)
    inside = refs.join(summary, "component").groupBy("component").agg(
        F.first("n_members").alias("n"), F.first("donor_objects").alias("objects"), F.count_if(F.col("split") == F.col("protected_split")).alias("protected")
    )
    per = inside.agg(
        F.count("*").alias("lineage_components"), F.count_if(F.col("n") > 1).alias("multi_record_components"), F.count_if(F.col("objects") == 0).alias("components_without_final_annotations"),
        F.coalesce(F.sum(F.when(F.col("objects") == 0, F.col("n"))), F.lit(0)).alias("rows_dropped_without_final_annotations"),
        F.count_if((F.col("objects") > 0) & (F.col("protected") < F.col("n"))).alias("split_conflict_components"),
        F.coalesce(F.sum(F.when(F.col("objects") > 0, F.col("n") - F.col("protected"))), F.lit(0)).alias("rows_dropped_for_split_conflict"),
    )
    hashes = refs.filter("content_hash is not null").groupBy("content_hash").agg(F.count("*").alias("n"), F.min("dataset").alias("d1"), F.max("dataset").alias("d2"), F.min("split").alias("s1"), F.max("split").alias("s2")).filter("n > 1")
    dup = hashes.agg(F.count("*").alias("exact_duplicate_groups"), F.count_if(F.col("d1") != F.col("d2")).alias("cross_dataset_exact_duplicate_groups"), F.count_if(F.col("s1") != F.col("s2")).alias("cross_split_exact_duplicate_groups"))
    notes = refs.select(F.col(node).alias("representative_id"), F.col("annotation_hash").alias("ra")), refs.select(F.col(node).alias("donor_id"), F.col("annotation_hash").alias("da"))
    out = plan.join(notes[0], "representative_id").join(notes[1], "donor_id").agg(
        F.count("*").alias("output_rows"), F.coalesce(F.sum(F.col("n_same") - 1), F.lit(0)).alias("rows_dropped_as_same_split_exact_duplicates"), F.count_if(~F.col("ra").eqNullSafe(F.col("da"))).alias("annotation_enriched_rows")
    )
    return per.crossJoin(dup).crossJoin(out)  # one row each


def left_out(refs: DataFrame, node: str = "ref_id") -> DataFrame:
    """(component, n_members, n_left_out) of components whose members differ in size, which plan_merge leaves out.

    n_left_out counts their records that no counter of merge_stats has: the donor has objects and the split is the
    protected one.
    """
    held = refs.join(components_summary(refs, node).filter("mismatched"), "component")
    n = F.count_if((F.col("donor_objects") > 0) & (F.col("split") == F.col("protected_split")))
    return held.groupBy("component").agg(F.count("*").alias("n_members"), n.alias("n_left_out"))


def _records(refs: DataFrame) -> DataFrame:
    """(component, records): a component's records in stable order; the list is part of the output rows' provenance."""
    order = stable_order(F.col("dataset"), F.col("split"), F.col("index"), F.col("image_id"))
    record = F.struct("dataset", "split", "image_id", "content_hash")
    return refs.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), record.alias("r")))), lambda m: m["r"]).alias("records"))


def lineage_ids(refs: DataFrame, hashing: str = "sha2") -> DataFrame:
    """(component, lineage_id): a hash over a component's records in stable order."""
    return _records(refs).select("component", _lineage_id(hashing).alias("lineage_id"))


def _lineage_id(hashing: str) -> Column:
    names = F.transform("records", lambda r: F.concat_ws("|", r["dataset"], r["split"], r["image_id"], F.coalesce(r["content_hash"], F.lit(""))))
    text = F.array_join(names, "\n")
    return F.sha2(text.cast("binary"), 256) if hashing == "sha2" else blake2b(text, 16)


def build_output(rows: DataFrame, refs: DataFrame, plan: DataFrame, strict: bool = True, hashing: str = "sha2") -> DataFrame:
    """The merged canonical rows: the representative's picture and fields, the donor's objects, provenance in meta_json.

    rows: canonical rows with ref_id; refs: output of lineage(). Pixels are joined once, at the end. Besides the canonical
    columns there are lineage_id, content_hash, donor_annotation_hash and output_order, the representative's place in
    the stable order. JSON that is no object raises (strict) or counts as an empty one; existing keys are replaced, keys
    are sorted.
    """
    donors = retained_objects(rows, strict).select(F.col("ref_id").alias("donor_id"), "objects", F.struct("dataset", "image_id", "split").alias("source"))
    notes = refs.select(F.col("ref_id").alias("donor_id"), F.col("annotation_hash").alias("donor_annotation_hash"), F.col("object_count").alias("donor_count"))
    planned = plan.join(_records(refs).withColumn("lineage_id", _lineage_id(hashing)), "component").join(donors, "donor_id").join(notes, "donor_id")
    if strict:
        drift = F.raise_error(F.concat(F.lit("annotation count changed while reading "), F.col("source.image_id"))).cast("bigint")
        planned = planned.withColumn("donor_id", F.when(F.size("objects") != F.col("donor_count"), drift).otherwise(F.col("donor_id")))
    own = refs.select(F.col("ref_id").alias("representative_id"), "content_hash", stable_order(F.col("dataset"), F.col("split"), F.col("index"), F.col("image_id")).alias("output_order"))
    out = rows.drop("objects").withColumnRenamed("ref_id", "representative_id").join(planned, "representative_id").join(own, "representative_id")
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    quoted = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    datasets = F.transform(F.array_sort(F.transform(F.array_distinct(F.transform("records", lambda r: r["dataset"])), lambda d: F.struct(rank_of(d, SOURCES).alias("k"), d.alias("d")))), lambda x: x["d"])
    added = {
        "merge_annotation_source": text(F.col("source")), "merge_content_hash": quoted(F.col("content_hash")), "merge_lineage_id": quoted(F.col("lineage_id")), "merge_original_split": quoted(F.col("split")),
        "merge_source_datasets": F.to_json(datasets), "merge_source_records": text(F.col("records")),
    }
    meta = object_text(updated(json_object(F.col("meta_json"), strict, F.col("image_id")), added))
    objects = F.transform("objects", lambda o: o.withField("meta_json", object_text(updated(json_object(o["meta_json"], strict, F.col("image_id")), {"merge_annotation_source": text(F.col("source"))}))))
    return out.select("image", "image_id", "dataset", "split", "image_path", "width", "height", "condition", "domain", "is_synthetic", objects.alias("objects"), meta.alias("meta_json"), "lineage_id", "content_hash", "donor_annotation_hash", "output_order")


def record_order_hashes(merged: DataFrame) -> DataFrame:
    """(split, n_rows, fingerprint) of build_output()'s rows in their order: what is in the output, and in which order."""
    numbered = dense_number(merged.select("split", "image_id", "content_hash", "lineage_id", "donor_annotation_hash", F.struct("split", "output_order").alias("o")), "o", "n")
    first = numbered.groupBy("split").agg(F.min("n").alias("first"))  # one row per split
    text = F.concat_ws("|", (F.col("n") - F.col("first")).cast("string"), F.coalesce("content_hash", F.lit("")), "image_id", "lineage_id", F.coalesce("donor_annotation_hash", F.lit("")))
    rows = numbered.join(first, "split").select("split", "n", text.alias("text"))
    return order_fingerprint(rows, "n", F.col("text"), ("split",))


def order_fingerprint(rows: DataFrame, number: str, text: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n_rows, fingerprint): changes with any row and with the order, which `number` (part of `text`) tells.

    A sum of hashes of numbered rows, so that no task needs to see all rows in order.
    """
    value = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(*by).agg(F.count(number).alias("n_rows"), F.sum(value).alias("fingerprint"))


def scan_stats(rows: DataFrame) -> DataFrame:
    """Per dataset: rows, objects, retained, ignored, excluded, rows without final objects, rows per split."""
    s = F.transform(F.coalesce("objects", F.array()), lambda o: F.coalesce(object_status(o), F.lit("excluded")))
    n = lambda what: F.size(F.filter("s", lambda x: x == what))
    r = rows.select("dataset", "split", s.alias("s")).select("dataset", "split", F.size("s").alias("total"), n("retained").alias("retained"), n("ignored").alias("ignored"), n("excluded").alias("excluded"))
    return r.groupBy("dataset").agg(
        F.count("*").alias("rows"), F.sum("total").alias("objects"), F.sum("retained").alias("retained_class_objects"), F.sum("ignored").alias("ignored_objects_dropped"), F.sum("excluded").alias("excluded_class_objects_dropped"),
        F.count_if(F.col("retained") == 0).alias("rows_without_final_objects_before_enrichment"), *[F.count_if(F.col("split") == x).alias(f"rows_{x}") for x in SPLITS],
    )


def label_histogram(rows: DataFrame) -> DataFrame:
    """(dataset, native_label, meta_label, status, n) of all objects; an empty meta label counts as none."""
    o = rows.select("dataset", F.explode("objects").alias("o"))
    return o.groupBy("dataset", F.coalesce(F.col("o.native_label"), F.lit("")).alias("native_label"), F.nullif(F.col("o.meta_label"), F.lit("")).alias("meta_label"), F.coalesce(object_status(F.col("o")), F.lit("excluded")).alias("status")).agg(F.count("*").alias("n"))


def source_metadata(rows: DataFrame) -> DataFrame:
    """(dataset, key, values): the distinct non-empty values of the listed metadata, sorted."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.get_json_object("meta_json", f"$.{k}").alias("value")) for k in LISTED_META])
    m = rows.select("dataset", F.explode(pairs).alias("p")).select("dataset", "p.key", "p.value").filter("value is not null and value <> ''").distinct()
    return m.groupBy("dataset", "key").agg(F.array_sort(F.collect_list("value")).alias("values"))


def manifest(rows: DataFrame, refs: DataFrame, plan: DataFrame, merged: DataFrame | None = None) -> str:
    """The merge's manifest as JSON text. Everything collected is one row per source, label or split.

    merged: build_output()'s rows, whose order the manifest then holds as record_order_hashes.
    """
    stats = {r["dataset"]: r.asDict() for r in scan_stats(rows).collect()}
    labels = [r.asDict() for r in label_histogram(rows).collect()]
    meta = source_metadata(rows).collect()
    sizes = left_out(refs).agg(
        F.count("*").alias("components_of_several_sizes"), F.coalesce(F.sum("n_members"), F.lit(0)).alias("rows_of_several_sizes"), F.coalesce(F.sum("n_left_out"), F.lit(0)).alias("rows_dropped_for_several_sizes"),
    )
    counters = merge_stats(refs, plan).first().asDict() | sizes.first().asDict()
    chosen = plan.join(refs.select(F.col("ref_id").alias("representative_id"), "dataset", "split"), "representative_id")
    splits = {r["split"]: r["n"] for r in chosen.groupBy("split").agg(F.count("*").alias("n")).collect()}
    datasets = {r["dataset"]: r["n"] for r in chosen.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    held = plan.join(refs.select(F.col("ref_id").alias("donor_id"), F.explode("class_counts").alias("c")), "donor_id")
    classes = {r["c"]: r["n"] for r in held.groupBy(F.col("c.class_name").alias("c")).agg(F.sum("c.n").alias("n")).collect()}
    sources = {}
    for name in SOURCES:
        s, own = stats.get(name, {}), [x for x in labels if x["dataset"] == name]
        total = lambda keep: dict(sorted(_summed((x["native_label"], x["n"]) for x in own if keep(x)).items()))  # noqa: B023, E731
        sources[name] = {
            "rows": s.get("rows", 0), "splits": {k: s[f"rows_{k}"] for k in SPLITS if s.get(f"rows_{k}")}, "objects": s.get("objects", 0) or 0,
            **{k: s.get(k, 0) or 0 for k in ("retained_class_objects", "ignored_objects_dropped", "excluded_class_objects_dropped", "rows_without_final_objects_before_enrichment")},
            "native_label_counts": total(lambda x: True),
            "observed_mappings": [{"native_label": a, "meta_label": b, "objects": n} for (a, b), n in sorted(_summed(((x["native_label"], x["meta_label"]), x["n"]) for x in own).items(), key=lambda i: (i[0][0], i[0][1] or ""))],
            "retained_class_counts": {c: sum(x["n"] for x in own if x["status"] == "retained" and x["meta_label"] == c) for c in FINAL_CLASSES},
            "excluded_native_label_counts": total(lambda x: x["status"] == "excluded"), "ignored_native_label_counts": total(lambda x: x["status"] == "ignored"),
            "metadata": {r["key"]: list(r["values"]) for r in meta if r["dataset"] == name},
        }
    over = lambda k: sum((s.get(k) or 0) for s in stats.values())
    out = {
        "schema_version": 2, "included_datasets": list(SOURCES), "class_selection": {"final_classes": list(FINAL_CLASSES), "mapping_source": "converted_meta_label"},
        "split_policy": {"preserved_splits": list(SPLITS), "conflict_priority": ["test", "val", "train"], "rows_are_never_reassigned": True},
        "input": {k: over(k) for k in ("rows", "objects", "retained_class_objects", "ignored_objects_dropped", "excluded_class_objects_dropped", "rows_without_final_objects_before_enrichment")} | {"datasets": sources},
        "deduplication": {k: v for k, v in counters.items() if v or k in ("output_rows", "lineage_components", "multi_record_components", "exact_duplicate_groups", "cross_dataset_exact_duplicate_groups", "cross_split_exact_duplicate_groups")},
        "output": {"rows": counters["output_rows"], "objects": sum(classes.values()), "splits": {s: splits.get(s, 0) for s in SPLITS}, "representative_datasets": {n: datasets.get(n, 0) for n in SOURCES}, "class_counts": {c: classes.get(c, 0) for c in FINAL_CLASSES}},
    }
    if merged is not None:
        held = {r["split"]: format(int(r["fingerprint"]), "x") for r in record_order_hashes(merged).collect()}
        out["output"]["record_order_hashes"] = {x: held.get(x, "0") for x in SPLITS}
    return json.dumps(out, indent=2) + "\n"


def _summed(pairs) -> dict:
    out: dict = {}
    for k, n in pairs:
        out[k] = out.get(k, 0) + n
    return out


def violations(merged: DataFrame) -> DataFrame:
    """(check, key, n) of everything that a saved merge must not have; empty for a sound one.

    merged: rows with image_id, split, content_hash, lineage_id, objects.
    """
    def named(check: str, df: DataFrame, key: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), F.col("n"))

    ids = merged.groupBy("image_id").agg(F.count("*").alias("n")).filter("n > 1")
    splits = lambda c: merged.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min("split").alias("a"), F.max("split").alias("b"), F.count("*").alias("n")).filter("a <> b")
    empty = merged.filter(F.coalesce(F.size("objects"), F.lit(0)) <= 0).groupBy("image_id").agg(F.count("*").alias("n"))
    classes = merged.select("image_id", F.explode("objects").alias("o")).filter(F.col("o.ignore") | F.coalesce(~F.col("o.meta_label").isin(*FINAL_CLASSES), F.lit(True))).groupBy("image_id").agg(F.count("*").alias("n"))
    other = merged.filter(~F.col("split").isin(*SPLITS) | F.col("split").isNull()).groupBy("split").agg(F.count("*").alias("n"))
    out = named("repeated image_id", ids, F.col("image_id"))
    for d in (named("hash in several splits", splits("content_hash"), F.col("content_hash")), named("lineage in several splits", splits("lineage_id"), F.col("lineage_id")), named("no objects", empty, F.col("image_id")), named("illegal object", classes, F.col("image_id")), named("unknown split", other, F.col("split"))):
        out = out.unionByName(d)
    return out


def publish(df: DataFrame, output: str, sources: tuple[str, ...] = (), force: bool = False, check=None, files: dict[str, str] | None = None) -> None:
    """Writes df (partitioned by split, in its output_order) beside `output`, re-reads and checks it, then swaps it in.

    files: further small files by name, such as the manifest; they are in the folder before the swap. The output may not
    be, hold or lie in a source. It is only replaced with force; the old output stays until the new one is in place and
    comes back if that fails, and a failed check leaves it untouched.
    """
    spark = df.sparkSession
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = path(output).getFileSystem(spark._jsc.hadoopConfiguration())
    full = lambda p: fs.makeQualified(path(p)).toString().rstrip("/") + "/"
    for s in sources:
        if full(s).startswith(full(output)) or full(output).startswith(full(s)):
            raise ValueError(f"output {output} overlaps source dataset {s}")
    if fs.exists(path(output)) and not force:
        raise FileExistsError(f"{output} exists; use force to replace it")
    parent, _, name = output.rstrip("/").rpartition("/")
    build, old = f"{parent}/.{name}.build-{uuid.uuid4().hex}", f"{parent}/.{name}.old-{uuid.uuid4().hex}"
    try:
        if "output_order" in df.columns:
            df = df.repartitionByRange("split", "output_order").sortWithinPartitions("split", "output_order").drop("output_order")
        df.write.partitionBy("split").parquet(build)
        if check is not None:
            check(spark.read.parquet(build))
        for file, text in (files or {}).items():
            out = fs.create(path(f"{build}/{file}"), True)
            out.write(bytearray(text.encode()))
            out.close()
        replaced = fs.exists(path(output))
        if replaced and not fs.rename(path(output), path(old)):
            raise OSError(f"cannot move {output} aside")
        if not fs.rename(path(build), path(output)):
            if replaced:
                fs.rename(path(old), path(output))
            raise OSError(f"cannot move {build} to {output}")
        if replaced:
            fs.delete(path(old), True)
    finally:
        if fs.exists(path(build)):
            fs.delete(path(build), True)
