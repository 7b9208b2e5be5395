"""Queries of the merge: filtering, lineage, donors and representatives, statistics, output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import labels as L
from boxlake.functions.clean import split_name, squeezed, whole_number
from boxlake.functions.pictures import valid_refs
from boxlake.operators import merge as M
from boxlake.operators.latest import latest_by
from boxlake.queries.registry import registry
from boxlake.runtime import table, written
from boxlake.schema import FINAL_CLASSES

QUERIES, ORACLES, query = registry()

_WS = "chr(32)||chr(9)||chr(10)||chr(13)"
_SPLIT = f"case when lower(trim(split,{_WS})) in ('train','training') then 'train' when lower(trim(split,{_WS})) in ('val','valid','validation') then 'val' when lower(trim(split,{_WS})) in ('test','testing') then 'test' end"
_CLASSES = "('" + "','".join(FINAL_CLASSES) + "')"
_RANK = "case dataset when 'acdc' then 0 when 'bdd100k' then 1 when 'carpk' then 2 when 'dawn' then 3 when 'exdark' then 4 when 'hazydet' then 5 when 'hazydet_clear' then 6 when 'hazydet_real' then 7 when 'udacity' then 8 when 'visdrone' then 9 when 'voc2007' then 10 when 'xwod' then 11 else 12 end"

REFS_SQL = f"""
scans as (select *, row_number() over (partition by ref_id order by scanned_at desc, image_id desc nulls last, content_hash desc nulls last, object_count desc nulls last) rn from row_refs where ref_id is not null),
refs as (select ref_id, dataset, {_SPLIT} split, row_index, image_id, width, height, nullif(regexp_extract(lower(content_hash), '([0-9a-f]{{64}})', 1), '') h,
  nullif(regexp_extract(trim(source_image_id,{_WS}), '^\\+?0*(\\d+?)(?:\\.0*)?$', 1), '') src, object_count, len(class_counts) nc, annotation_hash,
  struct_pack(a := {_RANK}, b := case {_SPLIT} when 'train' then 0 when 'val' then 1 when 'test' then 2 else 3 end, c := row_index, d := image_id, e := ref_id) o from scans where rn = 1)"""
COMP_SQL = f"""{REFS_SQL},
keys as (select ref_id, 'h' k, h v from refs where h is not null union all select ref_id, 's', src from refs where src is not null and dataset in ('hazydet', 'hazydet_clear')),
edges as (select distinct x.ref_id a, y.ref_id b from keys x join keys y using (k, v)),
reach(n, m) as (select ref_id, ref_id from refs union select e.b, r.m from reach r join edges e on e.a = r.n),
comp as (select r.*, c.component from refs r join (select n ref_id, min(m) component from reach group by n) c using (ref_id)),
summ as (select component, count(*) n, arg_min(ref_id, struct_pack(x := -coalesce(nc,0), y := -coalesce(object_count,0), z := o)) donor, max(case split when 'test' then 2 when 'val' then 1 when 'train' then 0 else -1 end) p,
  count(distinct (width, height)) > 1 mismatched from comp group by component),
full_ as (select c.*, s.n, s.donor, s.mismatched, d.object_count dn, d.annotation_hash da, case p when 2 then 'test' when 1 then 'val' when 0 then 'train' end ps from comp c join summ s using (component) join refs d on d.ref_id = s.donor)"""


def refs(spark: SparkSession, folder: str) -> DataFrame:
    """Valid row descriptors with hashes and source ids cleaned, as the merge's scan gives them."""
    r = valid_refs(table(spark, folder, "row_refs"), "dataset", "row_index", "width", "height", "source_image_id", "object_count", "class_counts", "annotation_hash")
    return r.withColumn("source_image_id", whole_number(F.col("source_image_id"))).withColumn("content_hash", F.lower(F.hex("content_hash"))).withColumnRenamed("row_index", "index")


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return written(M.lineage(written(refs(spark, folder), "refs")), "lineage")


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical rows: the latest delivery of every image, its split cleaned."""
    rows = table(spark, folder, "image_rows").withColumn("split", split_name(F.col("split")))
    return latest_by(rows, "image_id", "delivered_at")


ROWS_SQL = f"rows_ as (select * exclude (rn, split), {_SPLIT} split from (select *, row_number() over (partition by image_id order by delivered_at desc) rn from image_rows where image_id is not null) where rn = 1), obj as (select image_id, dataset, split, width, height, unnest(objects) o from rows_ where objects is not null)"
_STATUS = f"case when coalesce(o.ignore, false) then 'ignored' when o.meta_label in {_CLASSES} then 'retained' else 'excluded' end"


@query("u1_lineage", f"with recursive {COMP_SQL} select ref_id, component from comp")
def lineage(spark, folder):
    """U-1: records tied by equal content or source image."""
    return _linked(spark, folder).select("ref_id", "component")


@query("w3_donor", f"with recursive {COMP_SQL} select component, donor donor_id, n n_members, p >= 0 as known_split, mismatched from summ")
def donor(spark, folder):
    """W-3, W-4, W-7: donor, members, and whether sizes differ, per component."""
    return M.components_summary(_linked(spark, folder)).select("component", "donor_id", "n_members", F.col("protected_split").isNotNull().alias("known_split"), "mismatched")


_PLAN_SQL = "plan as (select arg_min(ref_id, o) representative_id, donor donor_id, component, n n_members, count(*) n_same from full_ where not mismatched and coalesce(dn,0) > 0 and split = ps group by component, coalesce(h, 'ref:' || ref_id), donor, n)"


@query("w5_merge_plan", f"with recursive {COMP_SQL}, {_PLAN_SQL} select * from plan")
def merge_plan(spark, folder):
    """W-5: representative and donor of every output row."""
    return M.plan_merge(_linked(spark, folder), strict=False)


@query("a8_merge_stats", f"""with recursive {COMP_SQL}, {_PLAN_SQL},
per as (select component, any_value(n) n, any_value(coalesce(dn,0)) dn, count(*) filter (split = ps) prot from full_ group by component),
hg as (select h, count(distinct dataset) d, count(distinct split) s from refs where h is not null group by h having count(*) > 1)
select (select count(*) from per) lineage_components, (select count(*) from per where n > 1) multi_record_components, (select count(*) from per where dn = 0) components_without_final_annotations,
 (select coalesce(sum(n),0)::bigint from per where dn = 0) rows_dropped_without_final_annotations, (select count(*) from per where dn > 0 and prot < n) split_conflict_components,
 (select coalesce(sum(n - prot),0)::bigint from per where dn > 0) rows_dropped_for_split_conflict, (select count(*) from hg) exact_duplicate_groups, (select count(*) from hg where d > 1) cross_dataset_exact_duplicate_groups,
 (select count(*) from hg where s > 1) cross_split_exact_duplicate_groups, (select count(*) from plan) output_rows, (select coalesce(sum(n_same - 1),0)::bigint from plan) rows_dropped_as_same_split_exact_duplicates,
 (select count(*) from plan join refs r on r.ref_id = representative_id join refs d on d.ref_id = donor_id where r.annotation_hash is distinct from d.annotation_hash) annotation_enriched_rows""")
def merge_stats(spark, folder):
    """A-6 to A-8: the merge's counters."""
    linked = _linked(spark, folder)
    return M.merge_stats(linked, M.plan_merge(linked, strict=False))


@query("w7_left_out", f"with recursive {COMP_SQL} select component, count(*) n_members, count(*) filter (coalesce(dn,0) > 0 and split = ps) n_left_out from full_ where mismatched group by component")
def left_out(spark, folder):
    """W-7: components of several sizes, which the plan leaves out, and how many of their rows nothing else counts."""
    return M.left_out(_linked(spark, folder))


@query("a2_scan_stats", f"""with {ROWS_SQL}, per as (select image_id, count(o) n, count(*) filter ({_STATUS} = 'retained') r, count(*) filter ({_STATUS} = 'ignored') i, count(*) filter ({_STATUS} = 'excluded') e from obj group by image_id)
select dataset, count(*) "rows", coalesce(sum(n),0)::bigint objects, coalesce(sum(r),0)::bigint retained_class_objects, coalesce(sum(i),0)::bigint ignored_objects_dropped, coalesce(sum(e),0)::bigint excluded_class_objects_dropped,
 count(*) filter (coalesce(r,0) = 0) rows_without_final_objects_before_enrichment, count(*) filter (split='train') rows_train, count(*) filter (split='val') rows_val, count(*) filter (split='test') rows_test from rows_ left join per using (image_id) group by dataset""")
def scan_stats(spark, folder):
    """A-2: statistics of the scan per source."""
    return M.scan_stats(_rows(spark, folder).select("dataset", "split", "objects"))


@query("a3_label_histogram", f"with {ROWS_SQL} select dataset, coalesce(o.native_label,'') native_label, nullif(o.meta_label,'') meta_label, {_STATUS} status, count(*) n from obj group by 1,2,3,4")
def label_histogram(spark, folder):
    """A-3: native labels, mappings and outcomes per source."""
    return M.label_histogram(_rows(spark, folder).select("dataset", "objects"))


@query("a3_class_counts", f"""with {ROWS_SQL}, d as (select distinct dataset from rows_), c as (select unnest(['person','bicycle','motorcycle','car','bus','truck']) meta_label),
n as (select dataset, o.meta_label, count(*) n from obj where {_STATUS} = 'retained' group by 1,2) select dataset, meta_label, coalesce(n,0) n from d cross join c left join n using (dataset, meta_label)""")
def class_counts(spark, folder):
    """A-3: retained objects per source and final class, with zeros."""
    rows = _rows(spark, folder)
    n = M.label_histogram(rows.select("dataset", "objects")).filter("status = 'retained'").groupBy("dataset", "meta_label").agg(F.sum("n").alias("n"))
    every = rows.select("dataset").distinct().select("dataset", F.explode(F.array(*[F.lit(c) for c in FINAL_CLASSES])).alias("meta_label"))
    return every.join(n, ["dataset", "meta_label"], "left").select("dataset", "meta_label", F.coalesce("n", F.lit(0)).alias("n"))


@query("a4_metadata", f"""with {ROWS_SQL}, p as (select dataset, unnest(['homepage','license','source_annotation_format']) k, meta_json from rows_), v as (select distinct dataset, k "key", json_extract_string(meta_json, '$.'||k) v from p)
select dataset, "key", string_agg(v, ',' order by v) "values" from v where v is not null and v <> '' group by 1,2""")
def metadata(spark, folder):
    """A-4: distinct metadata values per source."""
    return M.source_metadata(_rows(spark, folder).select("dataset", "meta_json")).withColumn("values", F.array_join("values", ","))


@query("f6_retained", f"""with {ROWS_SQL}, k as (select image_id, o, o.bbox[1]::double x, o.bbox[2]::double y, o.bbox[3]::double w, o.bbox[4]::double h, width iw, height ih from obj where {_STATUS} = 'retained' and len(o.bbox) = 4),
g as (select image_id, o.meta_label c from k where not (isnan(x) or isnan(y) or isnan(w) or isnan(h)) and x >= 0 and y >= 0 and w > 0 and h > 0 and x + w <= iw + 1e-3 and y + h <= ih + 1e-3)
select r.image_id, count(c) object_count, count(distinct c) class_count from rows_ r left join g using (image_id) group by r.image_id""")
def retained(spark, folder):
    """F-6, A-5: retained objects and classes per image; objects whose box cannot be stored are left out."""
    kept = M.retained_objects(_rows(spark, folder).select("image_id", "width", "height", "objects"), strict=False)
    return kept.select("image_id", F.size("objects").cast("bigint").alias("object_count"), F.size(M.class_counts(F.col("objects"))).cast("bigint").alias("class_count"))


@query("proj9_annotation_groups", f"""with {ROWS_SQL}, k as (select r.image_id, list_filter(list_transform(objects, lambda o: case when ({_STATUS}) = 'retained' and len(o.bbox) = 4 then {{'b': list_transform(o.bbox, lambda v: v::double), 'c': coalesce(o.iscrowd,false), 'm': o.meta_label, 'iw': width, 'ih': height}} end), lambda o: o is not null) os from rows_ r where objects is not null),
g as (select image_id, list_transform(list_filter(os, lambda o: not (isnan(o.b[1]) or isnan(o.b[2]) or isnan(o.b[3]) or isnan(o.b[4])) and o.b[1] >= 0 and o.b[2] >= 0 and o.b[3] > 0 and o.b[4] > 0 and o.b[1] + o.b[3] <= o.iw + 1e-3 and o.b[2] + o.b[4] <= o.ih + 1e-3), lambda o: {{'b': o.b, 'c': o.c, 'm': o.m}}) os from k)
select min(image_id) first_image, count(*) n, max(image_id) last_image from g where len(os) > 0 group by os having count(*) > 1""")
def annotation_groups(spark, folder):
    """P-9: images that share their annotations exactly."""
    kept = M.retained_objects(_rows(spark, folder).select("image_id", "width", "height", "objects"), strict=False)
    g = kept.filter(F.size("objects") > 0).groupBy(M.annotation_hash(F.col("objects")).alias("annotation_hash")).agg(F.count("*").alias("n"), F.min("image_id").alias("first_image"), F.max("image_id").alias("last_image"))
    return g.filter("n > 1").drop("annotation_hash")


@query("proj10_content_hash", f"with {ROWS_SQL} select image_id, sha256(image.bytes) content_hash from rows_ where image.bytes is not null")
def content_hash(spark, folder):
    """P-10: a hash of each picture."""
    return _rows(spark, folder).select("image_id", F.sha2("image.bytes", 256).alias("content_hash")).filter("content_hash is not null")


@query("proj11_lineage_ids", f"""with recursive {COMP_SQL} select component, sha256(string_agg(dataset||'|'||coalesce(split||'|','')||image_id||'|'||coalesce(h,''), chr(10) order by o.a, o.b, o.c, o.d)) lineage_id from comp group by component""")
def lineage_ids(spark, folder):
    """P-11: lineage ids of components."""
    return M.lineage_ids(_linked(spark, folder))


_OUTPUT_SQL = f"""with recursive {COMP_SQL}, {_PLAN_SQL}, lin as (select component, sha256(string_agg(dataset||'|'||coalesce(split||'|','')||image_id||'|'||coalesce(h,''), chr(10) order by o.a, o.b, o.c, o.d)) lineage_id, count(*) n_records, string_agg(distinct dataset, ',') ds from comp group by component),
{ROWS_SQL}, good as (select image_id, count(*) n from (select image_id, o.bbox[1]::double x, o.bbox[2]::double y, o.bbox[3]::double w, o.bbox[4]::double h, width iw, height ih from obj where {_STATUS} = 'retained' and len(o.bbox) = 4) where not (isnan(x) or isnan(y) or isnan(w) or isnan(h)) and x >= 0 and y >= 0 and w > 0 and h > 0 and x + w <= iw + 1e-3 and y + h <= ih + 1e-3 group by 1),
links as (select image_id, ref_id from comp),
out_ as (select rr.image_id, rr.dataset, rr.split, p.representative_id, p.donor_id, l.lineage_id, l.n_records, rep.h content_hash, don.annotation_hash donor_hash, don.image_id donor_image, coalesce(g.n, 0) n_objects, rr.meta_json, rep.o o from plan p join refs rep on rep.ref_id = p.representative_id join refs don on don.ref_id = p.donor_id
  join links dl on dl.ref_id = p.donor_id join rows_ dr on dr.image_id = dl.image_id join links rl on rl.ref_id = p.representative_id join rows_ rr on rr.image_id = rl.image_id join lin l using (component) left join good g on g.image_id = dr.image_id)"""


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    linked = _linked(spark, folder)
    rows = _rows(spark, folder).join(linked.select("image_id", "ref_id"), "image_id")
    return M.build_output(rows, linked, M.plan_merge(linked, strict=False), strict=False)


@query("proj13_output_rows", f"{_OUTPUT_SQL} select image_id, dataset, split, n_objects, lineage_id, split original_split, n_records, donor_image, content_hash from out_")
def output_rows(spark, folder):
    """P-13: the merged rows, without pixels, and what their metadata tells of their origin."""
    meta = lambda path: F.get_json_object("meta_json", f"$.{path}")
    records = F.json_array_length(meta("merge_source_records")).cast("bigint")
    return _merged(spark, folder).select("image_id", "dataset", "split", F.size("objects").cast("bigint").alias("n_objects"), meta("merge_lineage_id").alias("lineage_id"), meta("merge_original_split").alias("original_split"), records.alias("n_records"), meta("merge_annotation_source.image_id").alias("donor_image"), meta("merge_content_hash").alias("content_hash"))


@query("w6_output_order", f"{_OUTPUT_SQL} select image_id, split, row_number() over (partition by split order by o.a, o.b, o.c, o.d) - 1 place from out_")
def output_order(spark, folder):
    """W-6: the place of every output row within its split: the stable order of the representatives."""
    from boxlake.operators.splits import dense_number

    n = dense_number(_merged(spark, folder).select("image_id", "split", F.struct("split", "output_order").alias("o")), "o", "n")
    first = n.groupBy("split").agg(F.min("n").alias("first"))  # one row per split
    return n.join(first, "split").select("image_id", "split", (F.col("n") - F.col("first")).alias("place"))


@query("a9_order_hashes", f"{_OUTPUT_SQL}, n as (select *, row_number() over (partition by split order by o.a, o.b, o.c, o.d) - 1 n from out_) select split, count(*) n_rows, sum(('0x'||sha256(n||'|'||coalesce(content_hash,'')||'|'||image_id||'|'||lineage_id||'|'||coalesce(donor_hash,''))[1:12])::bigint)::double fingerprint from n group by 1")
def order_hashes(spark, folder):
    """A-9, P-12: what each split of the output holds and in which order, as one number."""
    return M.record_order_hashes(_merged(spark, folder)).select("split", "n_rows", F.col("fingerprint").cast("double").alias("fingerprint"))


@query("f11_violations", f"with {ROWS_SQL} select 'no objects' \"check\", image_id \"key\", count(*) n from rows_ where coalesce(len(objects),0) = 0 group by 2 union all select 'illegal object', image_id, count(*) from obj where coalesce(o.ignore,false) or o.meta_label is null or o.meta_label not in {_CLASSES} group by 2")
def violations(spark, folder):
    """F-11: what the latest rows would violate as a saved merge (hashes and lineages aside: f11_delivered_violations)."""
    rows = _rows(spark, folder).select("image_id", "split", "objects", F.lit(None).cast("string").alias("content_hash"), F.lit(None).cast("string").alias("lineage_id"))
    return M.violations(rows)


@query("f11_delivered_violations", f"""with recursive {COMP_SQL},
all_ as (select r.image_id, {_SPLIT} split, r.objects, sha256(r.image.bytes) h, c.component from image_rows r left join (select image_id, min(component) component from comp group by image_id) c using (image_id)), o as (select image_id, unnest(objects) o from all_ where objects is not null)
select 'repeated image_id' "check", image_id "key", count(*) n from all_ group by 2 having count(*) > 1
union all select 'hash in several splits', h, count(*) from all_ where h is not null group by 2 having count(distinct split) > 1
union all select 'lineage in several splits', component::varchar, count(*) from all_ where component is not null group by 2 having count(distinct split) > 1
union all select 'no objects', image_id, count(*) from all_ where coalesce(len(objects),0) = 0 group by 2
union all select 'illegal object', image_id, count(*) from o where coalesce(o.ignore,false) or o.meta_label is null or o.meta_label not in {_CLASSES} group by 2
union all select 'unknown split', split, count(*) from all_ where split is null group by 2""")
def delivered_violations(spark, folder):
    """F-11: what all rows as delivered would violate as a saved merge, by the hash of their bytes and their component."""
    parts = _linked(spark, folder).filter("image_id is not null").groupBy("image_id").agg(F.min("component").cast("string").alias("lineage_id"))
    rows = table(spark, folder, "image_rows").select("image_id", split_name(F.col("split")).alias("split"), "objects", F.sha2("image.bytes", 256).alias("content_hash"))
    return M.violations(rows.join(parts, "image_id", "left"))


@query("f11_merged_violations")
def merged_violations(spark, folder):
    """F-11: what the merge's own output violates."""
    out = _merged(spark, folder)
    objects = F.transform("objects", lambda o: F.struct(o["ignore"].alias("ignore"), o["meta_label"].alias("meta_label")))
    return M.violations(written(out.select("image_id", "split", objects.alias("objects"), "content_hash", "lineage_id"), "merged"))


@query("a9_manifest")
def manifest(spark, folder):
    """A-9: the manifest as one JSON document."""
    linked = _linked(spark, folder)
    return spark.createDataFrame([(M.manifest(_rows(spark, folder), linked, M.plan_merge(linked, strict=False), written(_merged(spark, folder), "merged")),)], "manifest string")


@query("a9_output", f"""{_OUTPUT_SQL}, c as (select unnest(d.class_counts) c from plan p join (select *, row_number() over (partition by ref_id order by scanned_at desc, image_id desc nulls last, content_hash desc nulls last, object_count desc nulls last) rn from row_refs where ref_id is not null) d on d.ref_id = p.donor_id and d.rn = 1)
select 'splits' part, r.split "key", count(*) n from plan p join refs r on r.ref_id = p.representative_id group by 2 union all select 'representative_datasets', r.dataset, count(*) from plan p join refs r on r.ref_id = p.representative_id group by 2 union all select 'class_counts', c.class_name, sum(c.n)::bigint from c where c.class_name in {_CLASSES} group by 2""")
def manifest_output(spark, folder):
    """A-9: what the manifest says of the output: rows per split and source, objects per class (of the donors)."""
    import json

    linked = _linked(spark, folder)
    held = json.loads(M.manifest(_rows(spark, folder), linked, M.plan_merge(linked, strict=False)))["output"]
    rows = [(part, k, n) for part in ("splits", "representative_datasets", "class_counts") for k, n in held[part].items() if n]
    return spark.createDataFrame(rows, "part string, key string, n bigint")


@query("u2_union", f"select dataset, split, count(*) n from (select dataset, {_SPLIT} split from image_rows union all select dataset, {_SPLIT} split from detection_samples) group by 1, 2")
def union(spark, folder):
    """U-2: sources put together by name."""
    parts = [table(spark, folder, t).select("dataset", split_name(F.col("split")).alias("split")) for t in ("image_rows", "detection_samples")]
    return parts[0].unionByName(parts[1]).groupBy("dataset", "split").agg(F.count("*").alias("n"))


@query("u3_missing_images", "select distinct image_id from detection_samples where image_id is not null except select image_id from image_rows where objects is not null and len(objects) > 0")
def missing_images(spark, folder):
    """U-3: set difference of image ids."""
    rows = table(spark, folder, "image_rows").filter("objects is not null and size(objects) > 0").select("image_id")
    return table(spark, folder, "detection_samples").select("image_id").filter("image_id is not null").distinct().join(rows, "image_id", "left_anti")


_OBJ = "obj as (select image_id, unnest(objects) o from image_rows where objects is not null)"


@query("f1_valid_objects", f"with {_OBJ} select image_id, count(*) filter (not coalesce(o.ignore,false) and o.meta_label is not null) n_meta, count(*) filter (not coalesce(o.ignore,false) and o.native_label is not null and not coalesce(o.iscrowd,false)) n_native from obj group by image_id")
def valid_objects(spark, folder):
    """F-1, F-2: valid objects by label mode, with and without crowd regions."""
    r = table(spark, folder, "image_rows").filter("size(objects) > 0")
    n = lambda mode, crowd: F.sum(F.size(L.valid_objects(F.col("objects"), mode, crowd)))
    return r.groupBy("image_id").agg(n("meta", True).alias("n_meta"), n("native", False).alias("n_native"))


@query("f7_empty_images", f"select dataset, count(*) filter (len(list_filter(coalesce(objects,[]), lambda o: not coalesce(o.ignore,false) and o.native_label is not null)) > 0) n_kept, count(*) n from image_rows group by dataset")
def empty_images(spark, folder):
    """F-7: images that keep a valid native object."""
    kept = F.size(L.valid_objects(F.col("objects"), "native")) > 0
    return table(spark, folder, "image_rows").groupBy("dataset").agg(F.count_if(kept).alias("n_kept"), F.count("*").alias("n"))


@query("f12_mismatched_fields", "select image_id, dataset, split from image_rows where split_part(image_id, ':', 1) <> dataset or split_part(image_id, ':', 2) <> split")
def mismatched_fields(spark, folder):
    """F-5, F-12: rows whose dataset or split contradicts their id."""
    part = lambda i: F.split_part("image_id", F.lit(":"), F.lit(i))
    return table(spark, folder, "image_rows").select("image_id", "dataset", "split").filter((part(1) != F.col("dataset")) | (part(2) != F.col("split")))


@query("j4_label_map", f"with {_OBJ}, m as (select * from (values ('van','car'),('taxi','car'),('pedestrian','person'),('lorry','truck')) t(n, m)) select o.native_label, m.m mapped, count(*) n from obj left join m on m.n = trim(o.native_label) group by 1, 2")
def label_map(spark, folder):
    """J-4: a class map applied to native labels."""
    class_map = {"van": "car", "taxi": "car", "pedestrian": "person", "lorry": "truck", "dog": None}
    o = table(spark, folder, "image_rows").select(F.explode("objects").alias("o"))
    return o.groupBy("o.native_label", L.mapped(F.col("o.native_label"), class_map).alias("mapped")).agg(F.count("*").alias("n"))


@query("s2_conditions", "select coalesce(nullif(lower(trim(condition)),''),'unknown') condition, coalesce(nullif(lower(trim(domain)),''),'unknown') domain, count(*) n from image_rows group by 1, 2")
def conditions(spark, folder):
    """Normalised conditions and domains."""
    return table(spark, folder, "image_rows").groupBy(L.named_or_unknown(F.col("condition")).alias("condition"), L.named_or_unknown(F.col("domain")).alias("domain")).agg(F.count("*").alias("n"))


@query("proj24_label_colours", f"with {_OBJ}, d as (select distinct o.native_label from obj), h as (select native_label, md5(native_label) m from d) select native_label, (64 + ('0x'||m[1:2])::int // 2)::int r, (64 + ('0x'||m[3:4])::int // 2)::int g, (64 + ('0x'||m[5:6])::int // 2)::int b from h where native_label is not null")
def label_colours(spark, folder):
    """P-24: the colour of each label."""
    d = table(spark, folder, "image_rows").select(F.explode("objects").alias("o")).select("o.native_label").distinct().filter("native_label is not null")
    c = L.label_colour(F.col("native_label"))
    return d.select("native_label", c[0].alias("r"), c[1].alias("g"), c[2].alias("b"))
