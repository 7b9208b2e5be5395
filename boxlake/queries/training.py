"""Queries of targets, evaluation, splits and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.functions import labels as L
from boxlake.operators import evaluate as E
from boxlake.operators import runs as R
from boxlake.operators import splits as S
from boxlake.operators import targets as T
from boxlake.queries.boxes import BRIDGE, bridge
from boxlake.queries.registry import registry
from boxlake.runtime import table
from boxlake.schema import FINAL_CLASSES

QUERIES, ORACLES, query = registry()

CLASSES = list(FINAL_CLASSES)
_CLASS_LIST = "['" + "','".join(CLASSES) + "']"
_IN = "('" + "','".join(CLASSES) + "')"
_OBJ = "obj as (select image_id, dataset, u.i - 1 pos, objects[u.i] o from image_rows, unnest(range(1, len(objects) + 1)) u(i) where objects is not null)"
_BAD = "o.bbox is null or len(o.bbox) <> 4 or (not isnan(o.bbox[1]) and o.bbox[1] < 0) or (not isnan(o.bbox[2]) and o.bbox[2] < 0) or (not isnan(o.bbox[3]) and o.bbox[3] <= 0) or (not isnan(o.bbox[4]) and o.bbox[4] <= 0)"
_REASON = f"case when o is null or coalesce(o.ignore,false) then 'ignored' when coalesce(o.meta_label,'') = '' then 'missing_label' when o.meta_label not in {_IN} then 'not_in_classes' when {_BAD} then 'invalid_bbox' else 'kept' end"


@query("f8_target_parser", f"with {_OBJ}, r as (select dataset, {_REASON} r from obj) select dataset, count(*) total, count(*) filter (r='ignored') ignored, count(*) filter (r='missing_label') missing_label, count(*) filter (r='not_in_classes') not_in_classes, count(*) filter (r='invalid_bbox') invalid_bbox, count(*) filter (r='kept') kept from r group by dataset")
def target_parser(spark, folder):
    """F-8: why objects become targets or not."""
    return T.filtering_stats(table(spark, folder, "image_rows").select("dataset", "objects"), CLASSES, by=("dataset",))


_KEPT = f"""src as (select image_id, width, height, list_filter(objects, lambda o: ({_REASON}) = 'kept') os from image_rows where objects is not null),
kept as (select image_id, width, height, u.i - 1 id, os[u.i] o, os[u.i].bbox[1]::double x, os[u.i].bbox[2]::double y, os[u.i].bbox[3]::double w, os[u.i].bbox[4]::double h, list_position({_CLASS_LIST}, os[u.i].meta_label)::int - 1 c, coalesce(os[u.i].iscrowd,false)::int cr from src, unnest(range(1, len(os) + 1)) u(i))"""


def _plain(c: str, places: int = 6) -> str:
    return f"case when not isnan({c}) then round({c} + 1e-12, {places}) end"


def _number(c: Column, places: int = 6) -> Column:
    """A number to compare: rounded beside the half, and null for NaN."""
    return F.when(~F.isnan(c), F.round(c + 1e-12, places))


@query("proj20_coco_annotations", f"with {_KEPT} select image_id, id::int id, c category_id, {_plain('x')} x, {_plain('y')} y, {_plain('w')} w, {_plain('h')} h, {_plain('w*h')} area, cr iscrowd from kept")
def coco_annotations(spark, folder):
    """P-20: every target as an annotation with its id, category, box, area and crowd flag."""
    t = T.parse_targets(table(spark, folder, "image_rows").select("image_id", "objects"), CLASSES)
    t = t.select("image_id", F.explode(T.coco_annotations(F.col("targets"))).alias("a"))
    return t.select("image_id", "a.id", "a.category_id", *[_number(F.col("a.bbox")[i]).alias(c) for i, c in enumerate("xywh")], _number(F.col("a.area")).alias("area"), "a.iscrowd")


@query("proj21_head_targets", f"with {_KEPT}, h as (select 'roi' head, 1 f union all select 'anchor', 0) select image_id, head, (c + f)::int \"label\", {_plain('x')} x1, {_plain('y')} y1, {_plain('x+w')} x2, {_plain('y+h')} y2, {_plain('w*h')} area, cr iscrowd from kept cross join h")
def head_targets(spark, folder):
    """P-21: corners, offset labels, areas and crowd flags for both kinds of detector heads."""
    t = T.parse_targets(table(spark, folder, "image_rows").select("image_id", "objects"), CLASSES)
    heads = F.array(*[F.struct(F.lit(h).alias("head"), T.head_targets(F.col("targets"), h).alias("t")) for h in T.HEAD_OFFSETS])
    t = t.select("image_id", F.explode(heads).alias("h")).select("image_id", "h.head", F.explode("h.t").alias("t"))
    return t.select("image_id", "head", "t.label", *[_number(F.col("t.box")[i]).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))], _number(F.col("t.area")).alias("area"), "t.iscrowd")


@query("proj22_batches", """with r as (select row_number() over (order by o_orderkey) - 1 n, o_orderkey from orders) select n // 16 batch, count(*) n_rows, min(o_orderkey) first_key, max(o_orderkey) last_key from r group by 1""")
def batches(spark, folder):
    """P-22, W-14: fixed-size batches in key order."""
    n = S.dense_number(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", "n")
    return S.batches(n, "n", 16).groupBy("batch").agg(F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("proj22_boxes", f"""with one as (select image_id, arg_max(struct_pack(objects, width, height), delivered_at) v from image_rows where image_id is not null group by 1), n as (select image_id, row_number() over (order by image_id) - 1 ord, v.objects objects, v.width width, v.height height from one),
src as (select ord, width, height, list_filter(objects, lambda o: ({_REASON}) = 'kept') os from n where objects is not null and width > 0 and height > 0), k as (select ord, width, height, unnest(os) o from src)
select ord // 16 batch, (ord % 16)::int batch_idx, list_position({_CLASS_LIST}, o.meta_label)::int - 1 cls, {_plain('(o.bbox[1]::double + o.bbox[3]::double / 2) / width', 9)} cx, {_plain('(o.bbox[2]::double + o.bbox[4]::double / 2) / height', 9)} cy, {_plain('o.bbox[3]::double / width', 9)} w, {_plain('o.bbox[4]::double / height', 9)} h from k""")
def batched_boxes(spark, folder):
    """P-22: normalised boxes with their picture's place in a batch of 16, over the latest delivery of every picture."""
    rows = table(spark, folder, "image_rows").filter("image_id is not null").groupBy("image_id").agg(F.max_by(F.struct("objects", "width", "height"), "delivered_at").alias("v"))
    n = S.dense_number(rows.select("image_id", "v.*"), "image_id", "ord").filter("width > 0 and height > 0")
    b = T.batched_boxes(T.parse_targets(n, CLASSES), "ord", 16)
    return b.select("batch", "batch_idx", "cls", *[_number(F.col(c), 9).alias(c) for c in ("cx", "cy", "w", "h")])


@query("proj19_transformed", f"""with {_KEPT}, g as (select *, width::double iw, height::double ih, least(640.0/width,640.0/height) f from kept where width > 0 and height > 0),
s as (select *, greatest(1,round_even(iw*f,0))/iw sx, greatest(1,round_even(ih*f,0))/ih sy, floor((640-greatest(1,round_even(iw*f,0)))/2) px, floor((640-greatest(1,round_even(ih*f,0)))/2) py from g where not (isnan(x) or isnan(y) or isnan(w) or isnan(h))),
b as (select image_id, o.meta_label l, greatest(0,least(x*sx+px,640)) x1, greatest(0,least(x*sx+px+w*sx,640)) x2, greatest(0,least(y*sy+py,640)) y1, greatest(0,least(y*sy+py+h*sy,640)) y2 from s)
select image_id, l "label", round(x1,4) x, round(y1,4) y, round(x2-x1,4) w, round(y2-y1,4) h from b where x2 > x1 and y2 > y1""")
def transformed(spark, folder):
    """P-19: targets in the resized picture, re-validated; boxes with NaN have no area and are dropped."""
    rows = table(spark, folder, "image_rows").select("image_id", "width", "height", "objects").filter("width > 0 and height > 0")
    t = T.transformed(T.parse_targets(rows, CLASSES), "letterbox", (640, 640)).select("image_id", F.explode("targets").alias("t"))
    return t.select("image_id", "t.label", *[F.round(F.col(f"t.{c}"), 4).alias(c) for c in "xywh"])


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "detection_samples").filter("image_id is not null").select("image_id", F.posexplode("targets").alias("pos", "t"))
    b = G.from_array(F.col("t.bbox_xywh"))
    rows = rows.select("image_id", "pos", F.col("t.label").alias("label"), b.alias("b"), F.coalesce("t.iscrowd", F.lit(False)).alias("iscrowd")).filter("b is not null and label is not null")
    return rows.select("image_id", "pos", "label", "b.x", "b.y", "b.w", "b.h", "iscrowd").distinct()


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Perturbed objects of image_rows with scores, as a stand-in for a model."""
    rows = table(spark, folder, "image_rows").groupBy("image_id").agg(F.max_by("objects", "delivered_at").alias("objects")).select("image_id", F.posexplode("objects").alias("pos", "o"))
    b = rows.select("image_id", "pos", F.col("o.meta_label").alias("label"), G.from_array(F.col("o.bbox")).alias("b")).filter("b is not null and coalesce(label,'') <> ''").filter(~G.has_nan(F.col("b")) & ~G.no_area(F.col("b")))
    shift = (F.col("pos") * 5) % 7 - 3
    return b.select("image_id", "pos", "label", ((F.col("pos") * 37 + F.floor("b.w")) % 100 / 100.0).alias("score"), (F.col("b.x") + shift).alias("x"), "b.y", "b.w", "b.h")


def _images(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "detection_samples").filter("image_id is not null")
    rows = rows.groupBy("image_id").agg(F.min(L.named_or_unknown(F.col("condition"))).alias("condition"), F.min(L.named_or_unknown(F.col("domain"))).alias("domain"))
    return S.dense_number(rows, "image_id", "ord")


_TRUTH = "tru as (select distinct image_id, u.i - 1 pos, targets[u.i].label label, targets[u.i].bbox_xywh bb, coalesce(targets[u.i].iscrowd,false) cr from detection_samples, unnest(range(1, len(targets)+1)) u(i) where targets is not null and image_id is not null and targets[u.i] is not null and targets[u.i].label is not null and len(targets[u.i].bbox_xywh) = 4 and len(list_filter(targets[u.i].bbox_xywh, lambda v: v is null)) = 0)"
_PRED = "pr0 as (select image_id, arg_max(objects, delivered_at) objects from image_rows group by image_id), pre as (select image_id, u.i - 1 pos, objects[u.i].meta_label label, objects[u.i].bbox bb from pr0, unnest(range(1, len(objects)+1)) u(i) where objects is not null and coalesce(objects[u.i].meta_label,'') <> '' and len(objects[u.i].bbox) = 4 and not isnan(objects[u.i].bbox[1]) and not isnan(objects[u.i].bbox[2]) and not isnan(objects[u.i].bbox[3]) and not isnan(objects[u.i].bbox[4]) and objects[u.i].bbox[3] > 0 and objects[u.i].bbox[4] > 0)"


@query("e3_metrics")
def metrics(spark, folder):
    """E-1 to E-9: precision and recall overall and per class, condition, domain and size (greedy matching has no SQL form)."""
    out = E.evaluate(_truth(spark, folder), _predictions(spark, folder), _images(spark, folder), CLASSES, 300)
    return out.withColumn("value", F.round("value", 9))


@query("e2_counts", f"with {_TRUTH}, {_PRED}, im as (select distinct image_id from detection_samples where image_id is not null) select (select count(*) from im) num_images, (select count(*) from tru where label in {_IN}) num_ground_truth_objects, (select count(*) from pre) num_predictions, (select count(*) from pre join im using (image_id) where label in {_IN}) num_usable")
def counts(spark, folder):
    """A-11, J-10: images, objects and predictions that take part."""
    images, p = _images(spark, folder), _predictions(spark, folder)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    usable = p.filter(F.col("label").isin(CLASSES)).join(images.select("image_id"), "image_id", "left_semi")
    # Four single rows side by side.
    return n(images, "num_images").crossJoin(n(_truth(spark, folder).filter(F.col("label").isin(CLASSES)), "num_ground_truth_objects")).crossJoin(n(p, "num_predictions")).crossJoin(n(usable, "num_usable"))


@query("j11_overlaps", f"""with {_TRUTH}, {_PRED}, j as (select t.image_id, t.pos gt_pos, p.pos det_pos, t.cr, p.bb[1]::double + (p.pos*5)%7-3 x, p.bb[2]::double y, p.bb[3]::double w, p.bb[4]::double h, t.bb[1]::double gx, t.bb[2]::double gy, t.bb[3]::double gw, t.bb[4]::double gh from tru t join pre p using (image_id, label)),
i as (select *, greatest(0, least(x+w,gx+gw)-greatest(x,gx)) * greatest(0, least(y+h,gy+gh)-greatest(y,gy)) it from j)
select image_id, gt_pos, det_pos, round(it / case when cr then w*h else w*h+gw*gh-it end, 6) iou from i where it / case when cr then w*h else w*h+gw*gh-it end >= 0.5""")
def overlaps(spark, folder):
    """J-11: detections and objects of one class and picture that overlap by half."""
    t = _truth(spark, folder).select("image_id", "label", F.col("pos").cast("bigint").alias("gt_pos"), G.box(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("g"), "iscrowd")
    p = _predictions(spark, folder).select("image_id", "label", F.col("pos").cast("bigint").alias("det_pos"), G.box(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("d"))
    both = t.join(p, ["image_id", "label"]).withColumn("iou", G.iou(F.col("d"), F.col("g"), F.col("iscrowd"))).filter("iou >= 0.5")
    return both.select("image_id", "gt_pos", "det_pos", F.round("iou", 6).alias("iou"))


@query("w10_top_predictions", f"with {_PRED}, s as (select image_id, pos, (pos*37 + floor(bb[3]))%100/100.0 score from pre), r as (select *, row_number() over (partition by image_id order by score desc, pos) rn from s where score >= 0.25) select image_id, pos, score::double score from r where rn <= 3")
def top_predictions(spark, folder):
    """F-9, W-10: the best detections per picture above a confidence."""
    p = _predictions(spark, folder).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("pos", "score"))).alias("p"))
    return p.select("image_id", F.explode(T.top_predictions(F.col("p"), 0.25, 3)).alias("p")).select("image_id", F.col("p.pos").cast("bigint").alias("pos"), "p.score")


_RAW = f"""r as (select k image_id, iw, ih, list({{'ln': ln, 'pk': pk, 'lab': lab, 's': ((pk * 37 + sk) % 100) / 100.0, 'x1': x, 'y1': y, 'x2': x + w, 'y2': y + h}} order by ln, pk, sk) p from i join o using (k) group by 1, 2, 3),
f as (select image_id, iw, ih, unnest(list_filter(p, lambda q: q.s >= 0.25 and q.lab in ('NO','RF'))) q from r),
c as (select *, greatest(0, least(q.x1, iw)) a1, greatest(0, least(q.y1, ih)) b1, greatest(0, least(q.x2, iw)) a2, greatest(0, least(q.y2, ih)) b2 from f),
v as (select image_id, q, a1, b1, a2 - a1 w, b2 - b1 h, row_number() over (partition by image_id order by q.s desc, q.ln, q.pk) rn from c where a2 > a1 and b2 > b1)"""


def _model_output(spark: SparkSession, folder: str) -> DataFrame:
    """Corners, labels and scores per picture, derived from lineitem, as a model would give them."""
    b = bridge(spark, folder)
    one = F.struct("ln", "pk", "sk", F.col("lab").alias("label"), (((F.col("pk") * 37 + F.col("sk")) % 100) / 100.0).alias("score"), G.xyxy(F.col("b")).alias("box"))
    return b.groupBy(F.col("k").alias("image_id"), F.col("iw").cast("int").alias("width"), F.col("ih").cast("int").alias("height")).agg(F.array_sort(F.collect_list(one)).alias("raw"))


@query("f9_predictions", f"with {BRIDGE}, {_RAW} select image_id, q.lab \"label\", q.s::double score, a1 x, b1 y, w, h from v where rn <= 2")
def usable_predictions(spark, folder):
    """F-9: a model's output without low scores, unknown classes and unusable boxes, the best two per picture."""
    p = T.usable_predictions(_model_output(spark, folder), "raw", ["NO", "RF"], 0.25, 2)
    return p.select("image_id", F.explode("predictions").alias("p")).select("image_id", "p.*")


@query("a11_counts", f"with {BRIDGE}, {_RAW} select (select count(*) from r) num_images, (select count(*) from o) num_ground_truth, (select count(*) from v where rn <= 2) num_predictions, (select count(*) from c where not (a2 > a1 and b2 > b1)) num_dropped_boxes")
def evaluation_counts(spark, folder):
    """A-11: pictures, objects, predictions and dropped boxes of an evaluation."""
    raw = _model_output(spark, folder)
    return E.evaluation_counts(raw, bridge(spark, folder), T.usable_predictions(raw, "raw", ["NO", "RF"], 0.25, 2))


@query("f10_drawable", f"with {_OBJ}, d as (select dataset, o, coalesce(o.native_label,'') <> '' and len(o.bbox) = 4 and len(list_filter(o.bbox, lambda v: v is null)) = 0 and o.bbox[3] > 0 and o.bbox[4] > 0 ok from obj where o is not null) select dataset, count(*) filter (ok and not coalesce(o.ignore,false)) n_shown, count(*) filter (ok and not coalesce(o.iscrowd,false)) n_with_ignored from d group by dataset")
def drawable(spark, folder):
    """F-10: objects that are drawn, without ignored ones, and with them but without crowd regions."""
    o = table(spark, folder, "image_rows").select("dataset", F.explode("objects").alias("o")).filter("o is not null")
    return o.groupBy("dataset").agg(F.count_if(T.drawable(F.col("o"))).alias("n_shown"), F.count_if(T.drawable(F.col("o"), "native", True, False)).alias("n_with_ignored"))


@query("src12_minute_split", "select case (epoch_us(ts)//60000000)%10 when 0 then 'val' when 1 then 'test' else 'train' end split, count(*) n from events where ts is not null group by 1")
def minute_split(spark, folder):
    """SRC-12: splits by minute in turn."""
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return table(spark, folder, "events").filter("ts is not null").groupBy(S.timestamp_block_split(ns).alias("split")).agg(F.count("*").alias("n"))


@query("src13_digest_split", """with d as (select doc_id, sha256(text) h from documents where text is not null), r as (select doc_id, (dense_rank() over (order by h) - 1) % 10 n from d) select doc_id, case n when 0 then 'val' when 1 then 'test' else 'train' end split from r""")
def digest_split(spark, folder):
    """SRC-13, W-9: equal contents share a split, digests take splits in turn."""
    d = table(spark, folder, "documents").filter("text is not null").select("doc_id", F.col("text").cast("binary").alias("b"))
    return S.digest_split(d, "b").select("doc_id", "split")


@query("w8_sequential_ids", "select c_name, row_number() over (order by c_name) id from customer")
def sequential_ids(spark, folder):
    """W-8, W-2: sequential ids by sorted name."""
    return S.dense_number(table(spark, folder, "customer").select("c_name"), "c_name", "id", 1).withColumn("id", F.col("id").cast("bigint"))


_RUN = "h as (select user_id run, row_number() over (partition by user_id order by ts, event_id) epoch, round(value,6) m from events where value is not null)"


def _history(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql.window import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, folder, "events").filter("value is not null").select(F.col("user_id").alias("run"), n.alias("epoch"), F.round("value", 6).alias("m"))


@query("w12_early_stopping", f"""with recursive {_RUN}, f(run, epoch, best, best_at, bad, stop) as (
 select run, epoch, m, epoch, 0, false from h where epoch = 1 union all
 select h.run, h.epoch, case when h.m > f.best + 0.001 then h.m else f.best end, case when h.m > f.best + 0.001 then h.epoch else f.best_at end, case when h.m > f.best + 0.001 then 0 else f.bad + 1 end,
  h.epoch >= 10 and (case when h.m > f.best + 0.001 then 0 else f.bad + 1 end) >= 8 from f join h on h.run = f.run and h.epoch = f.epoch + 1 where not f.stop),
l as (select run, max(epoch) e from f group by run), s as (select f.* from f join l on l.run = f.run and l.e = f.epoch)
select s.run, case when stop then s.epoch end stop_epoch, best_at best_epoch, best best_metric, (select arg_max(h.epoch, (h.m, -h.epoch)) from h where h.run = s.run and h.epoch <= s.epoch) top_epoch from s""")
def early_stopping(spark, folder):
    """W-12: where runs stop, and their best epochs."""
    return R.early_stopping(_history(spark, folder), "run", "epoch", "m").select("run", "stop_epoch", "best_epoch", "best_metric", "top_epoch")


@query("w13_learning_rate", "select s step, round(case when s < 101 then s/101.0 else 0.01 + 0.5*0.99*(1+cos(pi()*least(1.0, (s-101)/(5050-101.0)))) end, 9) factor from range(0, 5051) t(s)")
def learning_rate(spark, folder):
    """W-13: the warm-up cosine schedule."""
    return spark.range(5051).select(F.col("id").alias("step"), F.round(R.warmup_cosine(F.col("id"), 101, 5050, 0.01), 9).alias("factor"))


@query("a14_best_trial", f"with {_RUN} select run, arg_max(epoch, struct_pack(m := m, e := -epoch)) epoch, max(m) m from h group by run")
def best_trial(spark, folder):
    """A-14: the best epoch of each run, the earliest on ties."""
    return R.best_trial(_history(spark, folder).withColumn("epoch", F.col("epoch").cast("bigint")), "epoch", "m", by=("run",))


@query("a15_last_loss", f"with {_RUN} select run, arg_max(m, epoch) m from h where epoch % 3 = 0 group by run")
def last_loss(spark, folder):
    """A-15: the value of the last row that has one."""
    h = _history(spark, folder).withColumn("m", F.when(F.col("epoch") % 3 == 0, F.col("m")))
    return R.last_value(h, "run", "epoch", "m")


_SEED = "r as (select user_id % 3 seed, event_type metric, user_id % 5 g, round(avg(value),6) v from events where value is not null group by 1, 2, 3)"


@query("a13_seed_aggregate", f"with {_SEED}, n as (select g, count(distinct seed) k from r group by g) select g, metric, round(avg(v),6) mean, round(coalesce(stddev_samp(v),0),6) std, count(distinct seed) n, string_agg(printf('%.4f', v), ',' order by seed) \"values\" from r join n using (g) group by g, metric, k having count(distinct seed) = k")
def seed_aggregate(spark, folder):
    """A-13, J-12: mean and deviation over seeds of the metrics they share."""
    r = table(spark, folder, "events").filter("value is not null").groupBy((F.col("user_id") % 3).alias("seed"), F.col("event_type").alias("metric"), (F.col("user_id") % 5).alias("g")).agg(F.round(F.avg("value"), 6).alias("v"))
    return R.seed_aggregate(r, "seed", "metric", "v", ("g",)).select("g", "metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n", F.array_join(F.transform("values", lambda v: F.format_string("%.4f", v)), ",").alias("values"))


@query("a16_rates", "select event_type, count(*) n, round(coalesce(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts)))/1e6, 0), 0), 6) rate from events group by event_type")
def rates(spark, folder):
    """A-16: events per second."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    g = table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"), ((us(F.max("ts")) - us(F.min("ts"))) / 1e6).alias("s"))
    return g.select("event_type", "n", F.round(R.rate(F.col("n"), F.col("s")), 6).alias("rate"))


@query("s9_flattened_log", r"""with k as (select event_id, unnest(json_keys(props)) k, props from events where json_valid(props)), v as (select event_id, k, props ->> ('$."'||k||'"') v from k where k <> 'step')
select event_id, 'train/' || coalesce(nullif(trim(regexp_replace(lower(trim(k)), '[^a-z0-9_.-]+', '_', 'g'), '_'), ''), 'unknown') "key", v::double "value" from v where regexp_full_match(trim(v), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')""")
def flattened_log(spark, folder):
    """Flattened numeric entries of log rows."""
    rows = table(spark, folder, "events").select("event_id", F.from_json("props", "map<string,string>").alias("p")).filter("p is not null")
    return R.flattened_log(rows, "event_id", "p", "train")


@query("s9_sanitised", r"select distinct source, coalesce(nullif(trim(regexp_replace(lower(trim(source)), '[^a-z0-9_.-]+', '_', 'g'), '_'), ''), 'unknown') part from documents")
def sanitised(spark, folder):
    """Metric key parts."""
    return table(spark, folder, "documents").select("source", L.sanitised(F.col("source")).alias("part")).distinct()


@query("w15_first_rows", "select doc_id from documents order by doc_id limit 100")
def first_rows(spark, folder):
    """W-15: the first rows in key order (the profilers' sample)."""
    return table(spark, folder, "documents").select("doc_id").orderBy("doc_id").limit(100)
