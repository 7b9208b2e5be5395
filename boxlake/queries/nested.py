"""Queries of problem 2: deeply nested semi-structured records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.operators.nested import LIST_FIELDS, dewey_json, dewey_typed, flat_tables, with_links
from boxlake.runtime import table

_LISTS = "(" + ", ".join(f"'{f}'" for f in LIST_FIELDS) + ")"
# Every value below the elements, level by level; JSON written as a string in a list field counts as that JSON.
_WALK = f"""roots as (
  select image_id, 'objects' list_name, i - 1 pos, case when json_type(j) = 'VARCHAR' then try_cast(json_extract_string(j, '$') as json) else j end v from (select *, try_cast(objects[i].meta_json as json) j from (select image_id, objects, unnest(generate_series(1, len(objects))) i from image_rows)) where objects[i] is not null
  union all select image_id, 'targets', i - 1, to_json(targets[i]) from (select image_id, targets, unnest(generate_series(1, len(targets))) i from detection_samples) where targets[i] is not null),
w(image_id, list_name, pos, path, v, emit) as (
  select distinct image_id, list_name, pos, '', v, true from roots
  union all
  select image_id, list_name, pos, p, case when v is null then v when wrap and json_type(v) = 'OBJECT' then json_array(v) else v end, emit from (
    select image_id, list_name, pos, p, wrap, emit, case when (wrap or path = '') and json_type(x) = 'VARCHAR' then null else x end v from (
      select w.image_id, w.list_name, w.pos, w.path, case when json_type(w.v) = 'ARRAY' then w.path || '[' || e.key || ']' when w.path = '' then e.key else w.path || '.' || e.key end p,
        json_type(w.v) = 'OBJECT' and e.key in {_LISTS} wrap, json_type(w.v) = 'ARRAY' and e.type = 'OBJECT' emit,
        case when json_type(w.v) = 'OBJECT' and e.key in {_LISTS} and e.type = 'VARCHAR' then coalesce(try_cast(json_extract_string(e.value, '$') as json), e.value) else e.value end x
      from w, json_each(w.v) e where json_type(w.v) in ('ARRAY', 'OBJECT')) q) r where json_type(v) in ('ARRAY', 'OBJECT'))"""
_FOUND = f"with recursive {_WALK} select distinct image_id, list_name, pos, path child_path from w where emit"
_TABLES = f"""with recursive {_WALK}, n as (select distinct image_id, list_name, pos, path from w where emit),
k as (select *, case when path <> '' then regexp_replace(path, '\\.?[^\\[\\]]*(\\[\\d+\\])+$', '') end parent from n),
s as (select *, list_name || '[]' || case when path = '' then '' else '.' || regexp_replace(path, '\\[\\d+\\]', '[]', 'g') end schema_path, case when parent is not null then list_name || '[]' || case when parent = '' then '' else '.' || regexp_replace(parent, '\\[\\d+\\]', '[]', 'g') end end parent_schema_path from k)
select schema_path, parent_schema_path, count(*) n_rows, count(distinct case when parent is not null then (image_id, list_name, pos, parent) end) n_parents from s group by 1, 2"""
_KEYFRAMES = """with t as (select distinct image_id, targets from detection_samples), e as (select image_id, i - 1 pos, targets[i].meta.track.keyframes k from (select *, unnest(generate_series(1, len(targets))) i from t)),
f as (select image_id, pos, k, unnest(generate_series(1, len(k))) j from e)
select distinct image_id, pos, '' parent_path, 'meta.track.keyframes[' || (j - 1) || ']' child_path, k[j].frame frame from f where k[j] is not null"""


def _nodes(spark: SparkSession, folder: str, with_values: bool = False) -> DataFrame:
    rows = table(spark, folder, "image_rows").select("image_id", "objects")
    samples = table(spark, folder, "detection_samples").select("image_id", "targets")
    return dewey_json(rows, "image_id", "objects", "meta_json", "objects", with_values).unionByName(dewey_typed(samples, "image_id", "targets", "targets", with_values))


def found(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, folder).distinct()


def linked(spark: SparkSession, folder: str) -> DataFrame:
    """Every node with its parent link, table name and own fields."""
    out = with_links(_nodes(spark, folder, True)).withColumn("ordinals", F.concat_ws(".", F.col("ordinals").cast("array<string>")))
    return out.distinct()


def per_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and distinct parents of every flat table."""
    linked = with_links(found(spark, folder))
    parent = F.struct("image_id", "list_name", "pos", "parent_path")
    return linked.groupBy("schema_path", "parent_schema_path").agg(F.count("*").alias("n_rows"), F.countDistinct(F.when(F.col("parent_path").isNotNull(), parent)).alias("n_parents"))


def keyframes(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of one kind of child: keyframes of targets, with their parent and typed fields."""
    samples = table(spark, folder, "detection_samples").select("image_id", "targets").distinct()
    flat = flat_tables(with_links(dewey_typed(samples, "image_id", "targets", "targets", True)))
    rows = flat.get("targets[].meta.track.keyframes[]")
    if rows is None:
        return spark.createDataFrame([], "image_id string, pos int, parent_path string, child_path string, frame bigint")
    return rows.select("image_id", "pos", "parent_path", "child_path", "frame").distinct()


def columns(spark: SparkSession, folder: str) -> DataFrame:
    """The flat tables, their columns and types, and how many rows fill each."""
    out = None
    for path, rows in flat_tables(with_links(_nodes(spark, folder, True))).items():
        own = [c for c in rows.columns if c not in ("image_id", "list_name", "pos", "child_path", "parent_path", "schema_path", "parent_schema_path", "ordinals")]
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(rows.schema[c].dataType.simpleString()).alias("type"), F.count(F.col("`" + c.replace("`", "``") + "`")).alias("n_filled")) for c in own]) if own else F.expr("cast(array() as array<struct<column:string,type:string,n_filled:bigint>>)")
        part = rows.agg(cells.alias("c"), F.count("*").alias("n_rows")).select(F.lit(path).alias("schema_path"), "n_rows", F.explode("c").alias("c")).select("schema_path", "c.column", "c.type", "n_rows", "c.n_filled")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "schema_path string, column string, type string, n_rows bigint, n_filled bigint")


QUERIES = {"p2_found": found, "p2_linked": linked, "p2_tables": per_table, "p2_keyframes": keyframes, "p2_columns": columns}
ORACLES = {"p2_found": _FOUND, "p2_tables": _TABLES, "p2_keyframes": _KEYFRAMES}
