"""From raw objects to canonical rows, with import statistics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions.objects import json_object, object_text, updated
from boxlake.functions.labels import first_filled, is_valid, mapped
from boxlake.schema import CANONICAL
from boxlake.sources.config import SourceConfig
from boxlake.sources.formats import RAW

# The names of the import statistics.
STATISTICS = (
    "source_images_seen", "source_images_kept", "dropped_empty_or_ambiguous_images", "source_objects_seen", "source_objects_kept",
    "dropped_invalid_boxes", "dropped_unknown_labels", "dropped_ignored_labels", "unmapped_meta_labels",
)


def judged(objects: Column, cfg: SourceConfig, width: Column, height: Column) -> Column:
    """array<struct<status, unmapped, o>> of raw objects: unknown, ignored, invalid or kept, tested in this order."""
    ignored = lambda r: F.trim(r["label"]).isin(*cfg.ignore_labels) if cfg.ignore_labels else F.lit(False)
    # The policy may raise, so it is only reached where the tests before let the object through.
    first = lambda r: F.when(~r["known"], "unknown").when(ignored(r), "ignored")
    boxed = F.transform(objects, lambda r: F.struct(first(r).alias("s"), F.when(first(r).isNull(), G.apply_policy(r["b"], width, height, cfg.bbox_policy)).alias("box"), mapped(r["label"], cfg.class_map).alias("meta"), r.alias("r")))

    def last(x: Column) -> Column:
        r, status = x["r"], F.coalesce(x["s"], F.when(x["box"].isNull(), "invalid").otherwise("kept"))
        o = F.struct(
            F.transform(G.xywh(x["box"]), lambda v: v.cast("float")).alias("bbox"), F.trim(r["label"]).alias("native_label"), r["label_id"].alias("native_label_id"), x["meta"].alias("meta_label"),
            r["ignore"].alias("ignore"), r["iscrowd"].alias("iscrowd"), r["meta_json"].alias("meta_json"),
        )
        kept = x["s"].isNull() & x["box"].isNotNull()
        return F.struct(status.alias("status"), (x["meta"].isNull() & kept).alias("unmapped"), F.when(kept, o).alias("o"))

    return F.transform(boxed, last)


def judge(raw: DataFrame, cfg: SourceConfig) -> DataFrame:
    """raw with the outcome of every object (`j`), the objects kept, and whether the picture keeps a valid native one."""
    sized = F.coalesce("width", F.raise_error(F.concat(F.lit("no size of "), F.col("image_path"))).cast("int"))
    df = raw.withColumn("width", sized).withColumn("j", judged(F.coalesce("raw", F.array().cast(f"array<{RAW}>")), cfg, F.col("width"), F.col("height"))).drop("raw")
    df = df.withColumn("objects", F.transform(F.filter("j", lambda x: x["status"] == "kept"), lambda x: x["o"]))
    return df.withColumn("keep", F.exists("objects", lambda o: is_valid(o, "native")))


def statistics(judged_rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The import statistics of judge()'s rows; objects of dropped pictures count too."""
    n = lambda what: F.coalesce(F.sum(F.size(F.filter("j", lambda x: x["status"] == what))), F.lit(0))
    counters = (
        F.count("*"), F.count_if("keep"), F.count_if(~F.col("keep")), F.coalesce(F.sum(F.size("j")), F.lit(0)), n("kept"),
        n("invalid"), n("unknown"), n("ignored"), F.coalesce(F.sum(F.size(F.filter("j", lambda x: x["unmapped"]))), F.lit(0)),
    )
    return judged_rows.groupBy(*by).agg(*[c.alias(name) for c, name in zip(counters, STATISTICS, strict=True)])


def ingest(raw: DataFrame, cfg: SourceConfig, split: str, ordered: bool = False) -> tuple[DataFrame, DataFrame]:
    """(canonical rows, one row of statistics) of raw pictures.

    raw: source_id, image_path, width, height, raw (array of raw objects), and, if the format has them, content,
    condition, domain, is_synthetic, meta_json, pos (its place in the source, else the path tells it). With `ordered` the
    rows are sorted by that place. Pictures without any valid native object are dropped; their objects
    still count in the statistics. A picture without a size raises.
    """
    s = cfg.split(split)
    has = lambda c: c in raw.columns
    col = lambda c, kind="string": F.col(c) if has(c) else F.lit(None).cast(kind)
    df = judge(raw, cfg)
    synthetic = s.is_synthetic if s.is_synthetic is not None else cfg.default_is_synthetic
    known = lambda c, own, default: F.lower(F.trim(first_filled(col(c), F.lit(own), F.lit(default or "unknown"))))
    base = json.dumps(cfg.merged_meta(split), sort_keys=True, default=str)
    meta = F.lit(base) if not has("meta_json") else F.col("meta_json") if base == "{}" else _joined(F.lit(base), F.col("meta_json"))
    kept = df.filter("keep")
    if ordered:
        kept = kept.orderBy("pos" if has("pos") else "image_path")
    rows = kept.select(
        F.struct(col("content", "binary").alias("bytes"), F.col("image_path").alias("path")).alias("image"), F.concat_ws(":", F.lit(cfg.key), F.lit(split), F.trim("source_id")).alias("image_id"),
        F.lit(cfg.key).alias("dataset"), F.lit(split).alias("split"), "image_path", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"),
        known("condition", s.condition, cfg.default_condition).alias("condition"), known("domain", s.domain, cfg.default_domain).alias("domain"),
        F.coalesce(col("is_synthetic", "boolean"), F.lit(synthetic).cast("boolean")).alias("is_synthetic"), F.col("objects").cast(CANONICAL["objects"].dataType).alias("objects"), meta.alias("meta_json"),
    )
    return rows, statistics(df)


def _joined(base: Column, own: Column) -> Column:
    """Two JSON objects as one with sorted keys; the second's entries win."""
    return object_text(updated(json_object(base), json_object(own, strict=False)), (", ", ": "))
