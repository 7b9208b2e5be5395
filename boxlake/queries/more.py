"""Further queries: fingerprints, geometry reports, name matching, orders, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions import labels as L
from boxlake.functions.clean import split_name
from boxlake.operators import merge as M
from boxlake.operators import splits as S
from boxlake.queries.boxes import BRIDGE, bridge
from boxlake.queries.merging import _SPLIT
from boxlake.queries.registry import registry
from boxlake.runtime import table
from boxlake.schema import SOURCES

QUERIES, ORACLES, query = registry()


@query("proj12_fingerprints", f"""with r as (select {_SPLIT} split, image_id, coalesce(content_hash,'') h, row_number() over (partition by {_SPLIT} order by image_id, ref_id, scanned_at) - 1 n from (select distinct split, image_id, content_hash, ref_id, scanned_at from row_refs))
select coalesce(split, 'none') split, count(*) n_rows, sum(('0x'||sha256(n||'|'||image_id||'|'||h)[1:12])::bigint)::double fingerprint from r group by 1""")
def fingerprints(spark, folder):
    """P-12: an order-sensitive fingerprint of each split's rows."""
    r = table(spark, folder, "row_refs").select(split_name(F.col("split")).alias("split"), "image_id", F.coalesce("content_hash", F.lit("")).alias("h"), "ref_id", "scanned_at").distinct()
    named = r.withColumn("split", F.coalesce("split", F.lit("none")))
    numbered = S.dense_number(named.withColumn("o", F.struct("split", "image_id", "ref_id", "scanned_at", "h")), "o", "n")
    first = numbered.groupBy("split").agg(F.min("n").alias("first"))  # one row per split
    text = F.concat_ws("|", F.col("n") - F.col("first"), "image_id", "h")
    out = M.order_fingerprint(numbered.join(first, "split"), "n", text, ("split",))
    return out.select("split", "n_rows", F.col("fingerprint").cast("double").alias("fingerprint"))


@query("f4_geometry", f"with {BRIDGE} select k, count(*) n_outside, min(ln) first_line from i join o using (k) where w > 0 and h > 0 and (x < -1e-6 or y < -1e-6 or x + w > iw + 1e-6 or y + h > ih + 1e-6) group by k")
def geometry(spark, folder):
    """F-4: all boxes outside their picture, gathered per picture."""
    b = bridge(spark, folder).filter(~G.no_area(F.col("b"))).filter(~G.within(F.col("b"), F.col("iw"), F.col("ih")))
    return b.groupBy("k").agg(F.count("*").alias("n_outside"), F.min("ln").alias("first_line"))


@query("proj5_statuses", f"""with {BRIDGE} select lab, case when lab = 'RF' then 'ignored' when w <= 0 or h <= 0 then 'invalid' when x < 0 or y < 0 or x+w > iw or y+h > ih then
 case when least(greatest(x+w,0),iw) > least(greatest(x,0),iw) and least(greatest(y+h,0),ih) > least(greatest(y,0),ih) then 'kept' else 'invalid' end else 'kept' end status, count(*) n from i join o using (k) group by 1, 2""")
def statuses(spark, folder):
    """P-5: what becomes of each object, by label."""
    from boxlake.sources import formats as X
    from boxlake.sources.config import SourceConfig
    from boxlake.sources.ingest import judged

    cfg = SourceConfig.of({"key": "b", "source_format": "coco", "splits": {"train": {"root": "/"}}, "ignore_labels": ["RF"]})
    b = bridge(spark, folder).select("lab", "iw", "ih", F.array(X.raw(F.col("lab"), F.lit(1), F.col("b"))).alias("raw"))
    j = b.select("lab", F.get(judged(F.col("raw"), cfg, F.col("iw"), F.col("ih")), F.lit(0)).alias("j"))
    return j.groupBy("lab", F.col("j.status").alias("status")).agg(F.count("*").alias("n"))


@query("proj7_label_mode", "with obj as (select unnest(objects) o from image_rows where objects is not null) select coalesce(o.meta_label, '-') || '/' || o.native_label pair, count(*) n from obj group by 1")
def label_mode(spark, folder):
    """P-7: labels of both modes."""
    o = table(spark, folder, "image_rows").select(F.explode("objects").alias("o"))
    pair = F.concat(F.coalesce(L.label(F.col("o"), "meta"), F.lit("-")), F.lit("/"), L.label(F.col("o"), "native"))
    return o.groupBy(pair.alias("pair")).agg(F.count("*").alias("n"))


@query("j3_stems", r"select regexp_replace(parse_filename(image_path), '\.[^.]*$', '') stem, count(*) n, count(distinct d.image_id) n_samples from image_rows i left join (select distinct image_id from detection_samples) d on d.image_id = i.image_id where image_path is not null group by 1")
def stems(spark, folder):
    """J-3: files matched by stem."""
    stem = F.regexp_replace(F.element_at(F.split("image_path", "/"), -1), r"\.[^.]*$", "")
    d = table(spark, folder, "detection_samples").select(F.col("image_id").alias("d")).distinct()
    i = table(spark, folder, "image_rows").filter("image_path is not null").select("image_id", stem.alias("stem"))
    return i.join(d, F.col("image_id") == F.col("d"), "left").groupBy("stem").agg(F.count("*").alias("n"), F.count_distinct("d").alias("n_samples"))


@query("j7_case_fallback", "with n as (select distinct source from documents where source is not null), r as (select a.source, b.source other, a.source = b.source exact, row_number() over (partition by a.source order by a.source <> b.source, b.source) rn from n a join n b on lower(a.source) = lower(b.source)) select source, other, exact from r where rn = 1")
def case_fallback(spark, folder):
    """J-7: names matched in any case, an exact match preferred."""
    from boxlake.sources.readers import nearest_names

    n = table(spark, folder, "documents").filter("source is not null").select("source").distinct()
    found = nearest_names(n, n.select("source", F.col("source").alias("other")), ["other"], "source")
    return found.select("source", "other", (F.col("source") == F.col("other")).alias("exact"))


@query("j13_matrix", "select r_name, s_name from (select r_name from region) a cross join (select distinct n_name s_name from nation) b")
def matrix(spark, folder):
    """J-13: the product of two fixed lists (datasets and models of a plan)."""
    return table(spark, folder, "region").select("r_name").crossJoin(table(spark, folder, "nation").select(F.col("n_name").alias("s_name")).distinct())


_RANKS = " ".join(f"when '{s}' then {i}" for i, s in enumerate(SOURCES))


@query("w1_stable_order", f"select dataset, arg_min(image_id, struct_pack(a := case {_SPLIT} when 'train' then 0 when 'val' then 1 when 'test' then 2 else 3 end, b := row_index, c := image_id)) first_image, min(case dataset {_RANKS} else 12 end)::int source_rank from row_refs group by dataset")
def stable_order(spark, folder):
    """W-1: the first record of every source in the stable order."""
    r = table(spark, folder, "row_refs").withColumn("split", split_name(F.col("split")))
    order = M.stable_order(F.col("dataset"), F.col("split"), F.col("row_index"), F.col("image_id"))
    g = r.groupBy("dataset").agg(F.min(order).alias("o"))
    return g.select("dataset", F.col("o.d").alias("first_image"), F.col("o.a").alias("source_rank"))


@query("a10_split_counts", f"select dataset, {_SPLIT} split, count(*) n from row_refs group by 1, 2")
def split_counts(spark, folder):
    """A-10: rows per source and split."""
    return table(spark, folder, "row_refs").groupBy("dataset", split_name(F.col("split")).alias("split")).agg(F.count("*").alias("n"))


@query("u4_distinct_ids", "with m as (select row_number() over () rid, representative_id, merge_run, list_filter(component_ids, lambda x: x is not null) ids from merged_rows where component_ids is not null), f as (select rid, id, min(i) i from (select rid, unnest(ids) id, unnest(generate_series(1, len(ids))) i from m) group by 1, 2) select m.representative_id, m.merge_run, coalesce(string_agg(f.id, ',' order by f.i), '') ids from m left join f using (rid) group by m.rid, 1, 2")
def distinct_ids(spark, folder):
    """U-4: repeated list entries dropped, the first kept."""
    ids = F.array_distinct(F.filter("component_ids", lambda x: x.isNotNull()))
    return table(spark, folder, "merged_rows").filter("component_ids is not null").select("representative_id", "merge_run", F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@query("a5_class_counts", "with o as (select image_id, unnest(objects) o from (select image_id, arg_max(objects, delivered_at) objects from image_rows group by image_id)) select image_id, o.meta_label class_name, count(*) n from o where coalesce(o.meta_label,'') <> '' group by 1, 2")
def class_counts(spark, folder):
    """A-5: objects per picture and class."""
    r = table(spark, folder, "image_rows").groupBy("image_id").agg(F.max_by("objects", "delivered_at").alias("objects"))
    c = r.select("image_id", F.explode(M.class_counts(F.filter("objects", lambda o: F.coalesce(o["meta_label"], F.lit("")) != ""))).alias("c"))
    return c.select("image_id", "c.class_name", F.col("c.n").cast("bigint").alias("n"))


@query("f15_log_positions", "select o_orderkey, case when o_totalprice > 0 then case when (ln(o_totalprice)-ln(1000))/(ln(500000)-ln(1000)) <= 0.05 then 'lower' when (ln(o_totalprice)-ln(1000))/(ln(500000)-ln(1000)) >= 0.95 then 'upper' end end edge from orders")
def log_positions(spark, folder):
    """O-4: values near the ends of a logarithmic range."""
    from boxlake.operators.runs import boundary

    return table(spark, folder, "orders").select("o_orderkey", boundary(F.col("o_totalprice"), 1000, 500000).alias("edge"))
