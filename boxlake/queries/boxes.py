"""Queries of the box algebra, over the objects of image_rows and boxes derived from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import geometry as G
from boxlake.queries.registry import registry
from boxlake.runtime import spread, table

QUERIES, ORACLES, query = registry()


def _boxes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "image_rows").select("image_id", "width", "height", F.posexplode("objects").alias("pos", "o"))
    return rows.select("image_id", "width", "height", "pos", G.from_array(F.col("o.bbox")).alias("b"))


_SQL = """
o as (select image_id, width::double iw, height::double ih, u.i - 1 as pos, objects[u.i].bbox bb
  from image_rows, unnest(range(1, len(objects) + 1)) u(i) where objects is not null),
b as (select image_id, iw, ih, pos, case when len(bb) = 4 and len(list_filter(bb, lambda v: v is null)) = 0 then true else false end ok,
  bb[1]::double x, bb[2]::double y, bb[3]::double w, bb[4]::double h from o),
n as (select *, isnan(x) or isnan(y) or isnan(w) or isnan(h) nan from b where ok)"""


def _r(c, n: int = 6):
    return F.round(c, n)


@query("proj1_box_forms", f"with {_SQL} select image_id, pos, round(w*h,6) area, round(x+w,6) x2, round(y+h,6) y2, round(x+w/2,6) cx, round(y+h/2,6) cy from n where not nan")
def box_forms(spark, folder):
    """P-1: a box as corners, centre and area."""
    b = _boxes(spark, folder).filter("b is not null").filter(~G.has_nan(F.col("b")))
    c, p = G.cxcywh(F.col("b")), G.xyxy(F.col("b"))
    return b.select("image_id", F.col("pos").cast("bigint").alias("pos"), _r(G.area(F.col("b"))).alias("area"), _r(p[2]).alias("x2"), _r(p[3]).alias("y2"), _r(c[0]).alias("cx"), _r(c[1]).alias("cy"))


@query("proj2_normalised", f"with {_SQL} select image_id, pos, round((x+w/2)/iw,9) ncx, round((y+h/2)/ih,9) ncy, round(w/iw,9) nw, round(h/ih,9) nh from n where not nan and iw > 0 and ih > 0")
def normalised(spark, folder):
    """P-2: the normalised centre box."""
    b = _boxes(spark, folder).filter("b is not null").filter(~G.has_nan(F.col("b")))
    v = G.normalised_centre(F.col("b"), F.col("width"), F.col("height"))
    return b.select("image_id", F.col("pos").cast("bigint").alias("pos"), v.alias("v")).filter("v is not null").select("image_id", "pos", *[_r(F.col("v")[i], 9).alias(n) for i, n in enumerate(("ncx", "ncy", "nw", "nh"))])


@query("proj3_clipped", f"""with {_SQL}, c as (select image_id, pos, greatest(0,least(x,iw)) x1, greatest(0,least(y,ih)) y1, greatest(0,least(x+w,iw)) x2, greatest(0,least(y+h,ih)) y2 from n where not nan)
select image_id, pos, x2 > x1 and y2 > y1 has_area, case when x2 > x1 and y2 > y1 then round(x2-x1,6) end w, case when x2 > x1 and y2 > y1 then round(y2-y1,6) end h from c""")
def clipped(spark, folder):
    """P-3: boxes clamped to their image."""
    b = _boxes(spark, folder).filter("b is not null").filter(~G.has_nan(F.col("b")))
    c = b.withColumn("c", G.clipped(F.col("b"), F.col("width"), F.col("height")))
    return c.select("image_id", F.col("pos").cast("bigint").alias("pos"), F.col("c").isNotNull().alias("has_area"), _r(F.col("c.w")).alias("w"), _r(F.col("c.h")).alias("h"))


# Boxes over lineitem with deliberate negatives, empty and overhanging ones.
BRIDGE = """
i as (select o_orderkey k, 320+40*(o_orderkey%9) iw, 240+30*(o_orderkey%7) ih, case o_orderkey%10 when 0 then 'val' when 1 then 'test' else 'train' end split,
  case o_orderstatus when 'F' then 'fog' when 'O' then 'clear' else 'rain' end cond from orders),
o as (select l_orderkey k, l_linenumber ln, l_partkey pk, l_suppkey sk, cast((l_partkey*7)%700-40 as double) x, cast((l_suppkey*13)%520-30 as double) y,
  (l_quantity-2)*6 w, (l_quantity-1)*4 h, concat(l_returnflag,l_linestatus) lab from lineitem)"""


def bridge(spark: SparkSession, folder: str) -> DataFrame:
    """(k, iw, ih, split, cond, ln, pk, sk, b, lab): boxes derived from orders and lineitem."""
    orders = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    split = F.when(k % 10 == 0, "val").when(k % 10 == 1, "test").otherwise("train")
    cond = F.when(F.col("o_orderstatus") == "F", "fog").when(F.col("o_orderstatus") == "O", "clear").otherwise("rain")
    images = orders.select(k.alias("k"), (320 + 40 * (k % 9)).alias("iw"), (240 + 30 * (k % 7)).alias("ih"), split.alias("split"), cond.alias("cond"))
    lines = spread(table(spark, folder, "lineitem"))
    b = G.box((F.col("l_partkey") * 7) % 700 - 40, (F.col("l_suppkey") * 13) % 520 - 30, (F.col("l_quantity") - 2) * 6, (F.col("l_quantity") - 1) * 4)
    objects = lines.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), b.alias("b"), F.concat("l_returnflag", "l_linestatus").alias("lab"))
    return objects.join(images, "k")


_POLICY = """p as (select i.k, split, ln, pk, sk, lab, iw, ih, x, y, w, h, case when w<=0 or h<=0 then 'bad' when x<0 or y<0 or x+w>iw or y+h>ih then 'out' else 'in' end s,
 greatest(0,least(x,iw)) x1, greatest(0,least(y,ih)) y1, greatest(0,least(x+w,iw)) x2, greatest(0,least(y+h,ih)) y2 from i join o using (k)),
c as (select *, s = 'in' or (s = 'out' and x2 > x1 and y2 > y1) kept from p)"""


@query("proj4_policy_clip", f"with {BRIDGE}, {_POLICY} select k, ln, pk, sk, case when s='in' then x else x1 end x, case when s='in' then y else y1 end y, case when s='in' then w else x2-x1 end w, case when s='in' then h else y2-y1 end h from c where kept")
def policy_clip(spark, folder):
    """P-4: the clip policy; boxes without area are dropped."""
    b = bridge(spark, folder).withColumn("c", G.apply_policy(F.col("b"), F.col("iw"), F.col("ih"), "clip")).filter("c is not null")
    return b.select("k", "ln", "pk", "sk", "c.x", "c.y", "c.w", "c.h")


@query("proj4_policy_drop", f"with {BRIDGE}, {_POLICY} select split, count(*) n, sum(case when s='in' then 1 else 0 end)::bigint n_kept from c group by split")
def policy_drop(spark, folder):
    """P-4: the drop policy, counted per split."""
    b = bridge(spark, folder).withColumn("c", G.apply_policy(F.col("b"), F.col("iw"), F.col("ih"), "drop"))
    return b.groupBy("split").agg(F.count("*").alias("n"), F.count("c").alias("n_kept"))


@query("proj8_float32", f"""with {_SQL}, f as (select image_id, pos, iw, ih, ok, x::float::double x, y::float::double y, w::float::double w, h::float::double h, isnan(x) or isnan(y) or isnan(w) or isnan(h) nan from b)
select coalesce(case when not ok then 'arity' when nan then 'not_finite' when x<0 or y<0 or w<=0 or h<=0 then 'invalid' when x+w>iw+1e-3 or y+h>ih+1e-3 then 'exceeds' end, 'ok') status, count(*) n,
 round(sum(case when ok and not nan and x>=0 and y>=0 and w>0 and h>0 and x+w<=iw+1e-3 and y+h<=ih+1e-3 then w+h else 0 end),3) total from f group by 1""")
def float32_check(spark, folder):
    """P-8: the merge's float32 rounding and boundary check."""
    b = _boxes(spark, folder).withColumn("status", F.coalesce(G.checked_status(F.col("b"), F.col("width"), F.col("height")), F.lit("ok"))).withColumn("c", G.checked(F.col("b"), F.col("width"), F.col("height")))
    return b.groupBy("status").agg(F.count("*").alias("n"), _r(F.sum(F.coalesce(F.col("c.w") + F.col("c.h"), F.lit(0.0))), 3).alias("total"))


@query("proj14_resize", """with d as (select distinct width::double w, height::double h from image_rows where width > 0 and height > 0),
l as (select *, least(640/w, 640/h) s, least(800/least(w,h), 1333/greatest(w,h)) t from d)
select w::int width, h::int height, round_even(w*s,0)::int letter_w, round_even(h*s,0)::int letter_h, floor((640-round_even(w*s,0))/2)::int pad_x, floor((640-round_even(h*s,0))/2)::int pad_y,
 round_even(w*t,0)::int short_w, round_even(h*t,0)::int short_h, round(384/w,9) exact_x from l""")
def resize(spark, folder):
    """P-14: the geometry of letterbox, shortest-edge and exact resizes."""
    d = table(spark, folder, "image_rows").select("width", "height").filter("width > 0 and height > 0").distinct()
    w, h = F.col("width"), F.col("height")
    d = d.select("width", "height", G.resize_plan(w, h, "letterbox", (640, 640)).alias("l"), G.resize_plan(w, h, "shortest_edge", (800, 800), 1333).alias("s"), G.resize_plan(w, h, "exact", (384, 384)).alias("e"))
    back = lambda side, scale: F.rint(F.col(side) * F.col(scale)).cast("int")
    return d.select("width", "height", back("width", "l.scale_x").alias("letter_w"), back("height", "l.scale_y").alias("letter_h"), F.col("l.pad_x"), F.col("l.pad_y"), F.col("s.width").alias("short_w"), F.col("s.height").alias("short_h"), _r(F.col("e.scale_x"), 9).alias("exact_x"))


_LETTER = "s as (select *, least(640/iw, 640/ih) f from n where not nan and iw > 0 and ih > 0), g as (select *, round_even(iw*f,0)/iw sx, round_even(ih*f,0)/ih sy, floor((640-round_even(iw*f,0))/2) px, floor((640-round_even(ih*f,0))/2) py from s)"


@query("proj15_forward", f"with {_SQL}, {_LETTER} select image_id, pos, round(x*sx+px,6) x, round(y*sy+py,6) y, round(w*sx,6) w, round(h*sy,6) h from g")
def forward(spark, folder):
    """P-15: boxes in the letterboxed picture."""
    b = _boxes(spark, folder).filter("b is not null and width > 0 and height > 0").filter(~G.has_nan(F.col("b")))
    b = b.withColumn("p", G.resize_plan(F.col("width"), F.col("height"), "letterbox", (640, 640))).withColumn("r", G.resized(F.col("b"), F.col("p")))
    return b.select("image_id", F.col("pos").cast("bigint").alias("pos"), *[_r(F.col(f"r.{n}")).alias(n) for n in "xywh"])


@query("proj16_inverse", f"""with {_SQL}, {_LETTER}, t as (select image_id, pos, greatest(0,least((x*sx+px-px)/sx,iw)) x1, greatest(0,least((y*sy+py-py)/sy,ih)) y1, greatest(0,least((x*sx+px+w*sx-px)/sx,iw)) x2, greatest(0,least((y*sy+py+h*sy-py)/sy,ih)) y2 from g)
select image_id, pos, round(x1,4) x, round(y1,4) y, round(x2-x1,4) w, round(y2-y1,4) h from t where x2-x1 > 1e-6 and y2-y1 > 1e-6""")
def inverse(spark, folder):
    """P-16: letterboxed boxes brought back, clamped to the original picture."""
    b = _boxes(spark, folder).filter("b is not null and width > 0 and height > 0").filter(~G.has_nan(F.col("b")))
    b = b.withColumn("p", G.resize_plan(F.col("width"), F.col("height"), "letterbox", (640, 640))).withColumn("f", G.resized(F.col("b"), F.col("p")))
    b = b.withColumn("r", G.restored(F.col("f"), F.col("p"), F.col("width"), F.col("height"))).filter("r.w > 1e-6 and r.h > 1e-6")
    return b.select("image_id", F.col("pos").cast("bigint").alias("pos"), *[_r(F.col(f"r.{n}"), 4).alias(n) for n in "xywh"])


@query("proj17_predictions", f"""with {BRIDGE}, c as (select o.k, ln, pk, sk, iw::double iw, ih::double ih, greatest(0,least(x,640)) x1, greatest(0,least(y,640)) y1, greatest(0,least(x+w,640)) x2, greatest(0,least(y+h,640)) y2 from i join o using (k)),
u as (select * from c where x2 > x1 and y2 > y1), v as (select k, ln, pk, sk, greatest(0,least(x1*iw/640,iw)) x1, greatest(0,least(y1*ih/640,ih)) y1, greatest(0,least(x2*iw/640,iw)) x2, greatest(0,least(y2*ih/640,ih)) y2 from u)
select k, ln, pk, sk, round(x1,6) x, round(y1,6) y, round(x2-x1,6) w, round(y2-y1,6) h from v where x2 > x1 and y2 > y1""")
def predictions(spark, folder):
    """P-17: predicted corners made canonical."""
    b = bridge(spark, folder).withColumn("p", G.resize_plan(F.col("iw"), F.col("ih"), "exact", (640, 640))).withColumn("v", G.xyxy(F.col("b")))
    b = b.withColumn("c", G.canonical_prediction(F.col("v"), F.col("p"), F.col("iw"), F.col("ih"))).filter("c is not null")
    return b.select("k", "ln", "pk", "sk", *[_r(F.col(f"c.{n}")).alias(n) for n in "xywh"])


@query("proj18_flip", f"with {BRIDGE} select k, ln, pk, sk, case when k % 2 = 0 then iw - x - w else x end as x, w from i join o using (k)")
def flip(spark, folder):
    """P-18: the box part of a horizontal flip (the coin is fixed here so that SQL can follow it)."""
    b = bridge(spark, folder).withColumn("f", F.when(F.col("k") % 2 == 0, G.flipped(F.col("b"), F.col("iw"))).otherwise(F.col("b")))
    return b.select("k", "ln", "pk", "sk", "f.x", "f.w")


@query("filter3_within", f"with {_SQL} select image_id, count(*) n, sum(case when not nan and x>=-1e-6 and y>=-1e-6 and x+w<=iw+1e-6 and y+h<=ih+1e-6 then 1 else 0 end)::bigint n_within from n group by image_id")
def within(spark, folder):
    """F-3: boxes within their image."""
    b = _boxes(spark, folder).filter("b is not null")
    return b.groupBy("image_id").agg(F.count("*").alias("n"), F.count_if(G.within(F.col("b"), F.col("width"), F.col("height"))).alias("n_within"))
