"""Queries of problems 4 and 5: groups of tied records, and splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.pictures import valid_refs
from boxlake.llm.consolidate import consolidated_groups
from boxlake.llm.related import PROPORTIONS, divided_groups, grouped_splits
from boxlake.llm.ties import plan_ties, source_ties, verdict_ties
from boxlake.runtime import table

# What white space is, and the parts of the SQL equivalents: components by the smallest label, ties, latest scans.
SQUEEZED = r"regexp_replace(lower({}), '^[\s\x0b\x{{a0}}]+|[\s\x0b\x{{a0}}]+$', '', 'g')"
COMPONENTS_SQL = """edges as (select a, b from ties union select b, a from ties), nodes as (select distinct a n from edges),
comp(n, l) using key (n) as (select n, n from nodes union select e.b, min(t.l) from comp t join edges e on e.a = t.n join recurring.comp r on r.n = e.b where t.l < r.l group by 1)"""
_PLAN_TIES = f"""plans as (select nullif({SQUEEZED.format('lineage_id')}, '') lineage, list_filter(component_ids, lambda x: x is not null) ids from merged_rows), held as (select lineage, ids, list_min(ids) least from plans where len(ids) > 0),
plan_ties as (select unnest(ids) a, least b from held union select least, min(least) over (partition by lineage) from held where lineage is not null)"""
_GROUPS = f"""with recursive {_PLAN_TIES},
ties as (select left_ref a, right_ref b from match_pairs where {SQUEEZED.format('verdict')} = 'match' and left_ref is not null and right_ref is not null union select a, b from plan_ties), {COMPONENTS_SQL},
listed as (select c.n ref_id, c.l from comp c where c.n in (select ref_id from row_refs union select ref_id from anchor_frames)),
grouped as (select ref_id, min(ref_id) over (partition by l) group_id, count(*) over (partition by l) n_members from listed)
"""
P4_FOUND_SQL = _GROUPS + "select ref_id, group_id from grouped where n_members >= 2"
P4_SIZES_SQL = _GROUPS + "select n_members, count(*) n_groups from grouped where n_members >= 2 and ref_id = group_id group by 1"
SPLIT_SQL = f"case when {SQUEEZED.format('split')} in ('train','training','tr') then 'train' when {SQUEEZED.format('split')} in ('val','valid','validation','dev') then 'val' when {SQUEEZED.format('split')} in ('test','testing') then 'test' end"
REFS_SQL = f"""refs as (select * replace ({SPLIT_SQL} as split, nullif(regexp_extract(lower(content_hash), '(?:^|[^0-9a-f])([0-9a-f]{{64}})(?:$|[^0-9a-f])', 1), '') as content_hash) from row_refs where ref_id is not null
 qualify row_number() over (partition by ref_id order by scanned_at desc nulls last, dataset desc nulls last, row_index desc nulls last, object_count desc nulls last, source_image_id desc nulls last) = 1)"""
_NUMBER = f"nullif(regexp_extract({SQUEEZED.format('source_image_id')}, '^\\+?0*(\\d+?)(?:\\.0*)?$', 1), '')"
_RELATED = f"""with recursive {REFS_SQL}, {_PLAN_TIES},
sources as (select ref_id, {_NUMBER} src from refs where dataset in ('hazydet', 'hazydet_clear')),
ties as (select a, b from plan_ties union select ref_id, min(ref_id) over (partition by src) from sources where src is not null), {COMPONENTS_SQL},
placed as (select r.ref_id, r.split, coalesce(c.l, r.ref_id) l from refs r left join comp c on c.n = r.ref_id),
grouped as (select ref_id, split, min(ref_id) over (partition by l) group_id, min(split) over (partition by l) lo, max(split) over (partition by l) hi from placed)
"""
P5_FOUND_SQL = _RELATED + "select ref_id, group_id from grouped where lo <> hi"
# The draw of a split: 52 bits of a hash of the group, the split and the seed.
_DRAW = "(('0x' || substr(md5(group_id || '|{0}|0'), 1, 13))::bigint + 0.5) / 4503599627370496.0"
_SCORES = ", ".join(f"{{'score': greatest({w} * \"all\"{' - filled' if k == 'train' else ''}, 0) / -ln({_DRAW.format(k)}), 'split': '{k}'}}" for k, w in PROPORTIONS.items())
_SPLITS = _RELATED + f""", sizes as (select group_id, count(*) n, sum(count(*)) over () "all" from grouped group by 1),
giants as (select *, n > "all" * {min(PROPORTIONS.values())} giant, coalesce(sum(n) filter (n > "all" * {min(PROPORTIONS.values())}) over (), 0) filled from sizes),
drawn as (select group_id, case when giant then 'train' else greatest({_SCORES})['split'] end new_split from giants)
"""
P5_SPLITS_SQL = _SPLITS + "select g.ref_id, g.split, g.group_id, d.new_split from grouped g join drawn d using (group_id)"
P5_SHARES_SQL = _SPLITS + "select new_split, count(*) n_records, count(distinct group_id) n_groups, round(count(*) / sum(count(*)) over (), 6) share from grouped join drawn using (group_id) group by 1"


def groups(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "row_refs").select("ref_id").unionByName(table(spark, folder, "anchor_frames").select("ref_id"))
    ties = verdict_ties(table(spark, folder, "match_pairs")).unionByName(plan_ties(table(spark, folder, "merged_rows")))
    return consolidated_groups(ties, listed)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return groups(spark, folder).select("ref_id", "group_id")


def sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many groups there are of each size."""
    return groups(spark, folder).filter("ref_id = group_id").groupBy("n_members").agg(F.count("*").alias("n_groups"))


def _related(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    refs = valid_refs(table(spark, folder, "row_refs"), "dataset", "source_image_id")
    return refs, plan_ties(table(spark, folder, "merged_rows")).unionByName(source_ties(refs))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return divided_groups(*_related(spark, folder)).select("ref_id", "group_id")


def splits(spark: SparkSession, folder: str) -> DataFrame:
    """A split for every record; no group of related records is divided."""
    refs, ties = _related(spark, folder)
    return grouped_splits(refs.select("ref_id", "split"), ties)


def shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares of records that the splits reach."""
    per = splits(spark, folder).groupBy("new_split").agg(F.count("*").alias("n_records"), F.count_distinct("group_id").alias("n_groups"))
    all_ = per.agg(F.sum("n_records").alias("all"))  # one row
    return per.crossJoin(all_).withColumn("share", F.round(F.col("n_records") / F.col("all"), 6)).drop("all")


QUERIES = {"p4_found": p4_found, "p4_sizes": sizes, "p5_found": p5_found, "p5_splits": splits, "p5_shares": shares}
ORACLES = {"p4_found": P4_FOUND_SQL, "p4_sizes": P4_SIZES_SQL, "p5_found": P5_FOUND_SQL, "p5_splits": P5_SPLITS_SQL, "p5_shares": P5_SHARES_SQL}
