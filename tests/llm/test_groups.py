import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxlake.llm.consolidate import consolidated_groups, decomposed_components
from boxlake.llm.related import divided_groups, grouped_splits, hash_to_min, rendezvous
from boxlake.llm.ties import plan_ties, source_ties, verdict_ties


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def as_sets(pairs):
    out = defaultdict(set)
    for x, c in pairs:
        out[c].add(x)
    return {frozenset(v) for v in out.values()}


def graph(seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(60)] + [(rng.randint(300, 380), rng.randint(300, 380)) for _ in range(60)]
    return edges + [(1, 0), (7, 7), (999, 999), (None, 3), (5, None)] + edges[:5]


def test_components(spark):
    for seed in range(2):
        edges = graph(seed)
        df, want = spark.createDataFrame(edges, "a bigint, b bigint"), as_sets(union_find(edges).items())
        for few in (0, 60) if seed else (2_000,):
            assert as_sets(map(tuple, decomposed_components(df, few=few).collect())) == want
        assert dict(map(tuple, hash_to_min(df).collect())) == union_find(edges)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert decomposed_components(none).count() == 0 and hash_to_min(none).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_any_graph(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert as_sets(map(tuple, decomposed_components(df, rate=2.0, hops=1, few=0).collect())) == as_sets(union_find(edges).items())


def test_ties(spark):
    verdicts = ["match", " Match\n", "mismatch", "rematch needed", None, "", "no_match", "MATCH"]
    rows = [(i, i + 1, v, 0) for i, v in enumerate(verdicts)] + [(None, 1, "match", 0), (1, None, "match", 0), (4, 4, "match", 0)]
    assert {tuple(r) for r in verdict_ties(spark.createDataFrame(rows, "left_ref bigint, right_ref bigint, verdict string, a int")).collect()} == {(0, 1), (1, 2), (7, 8), (4, 4)}
    plans = [([3, None, 1, 3], " AB "), ([9], "ab\t"), ([5, 6], None), (None, "ab"), ([], "ab"), ([None], "ab"), ([7], "")]
    ties = [tuple(r) for r in plan_ties(spark.createDataFrame(plans, "component_ids array<bigint>, lineage_id string")).collect()]
    assert as_sets(union_find(ties).items()) == {frozenset({1, 3, 9}), frozenset({5, 6}), frozenset({7})}
    refs = [(1, "hazydet", "007"), (2, "hazydet_clear", " 7.0 "), (3, "hazydet_real", "7"), (4, "hazydet", "n/a"), (5, "hazydet", "-9"), (6, "hazydet", None), (8, "hazydet", "-9")]
    ties = [tuple(r) for r in source_ties(spark.createDataFrame(refs, "ref_id bigint, dataset string, source_image_id string")).collect()]
    assert as_sets(union_find(ties).items()) == {frozenset({1, 2})}


def test_only_listed_ids_come_out(spark):
    ties = spark.createDataFrame([(1, 50), (50, 2), (3, 60), (4, 4), (70, 71)], "a bigint, b bigint")
    listed = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "ref_id bigint")
    assert {tuple(r) for r in consolidated_groups(ties, listed).collect()} == {(1, 1, 2), (2, 1, 2)}
    assert consolidated_groups(ties.filter(F.lit(False)), listed).count() == 0


def test_splits(spark):
    refs = spark.createDataFrame([(i, "train" if i % 7 else "val", "x") for i in range(1000)], "ref_id bigint, split string, component0 string")
    ties = spark.createDataFrame([(i, i - i % 4) for i in range(1000)] + [(900, 12345)], "a bigint, b bigint")
    out = grouped_splits(refs, ties).collect()
    by = defaultdict(set)
    for r in out:
        by[r["group_id"]].add(r["new_split"])
    assert len(out) == 1000 and len(by) == 250 and all(len(s) == 1 for s in by.values())
    shares = {s: sum(r["new_split"] == s for r in out) / 1000 for s in ("train", "val", "test")}
    assert abs(shares["train"] - 0.8) < 0.1 and shares["val"] > 0.03 and shares["test"] > 0.03
    again = {r["ref_id"]: r["new_split"] for r in grouped_splits(refs, ties, {"train": 0.8, "val": 0.1, "test": 0.2}).collect()}
    assert all(again[r["ref_id"]] in (r["new_split"], "test") for r in out)  # only towards the grown split
    divided = divided_groups(refs, ties).collect()
    assert {r["group_id"] for r in divided} == {g for g in range(0, 1000, 4) if any(x % 7 == 0 for x in range(g, g + 4))}
    assert spark.range(5).select(rendezvous(F.col("id"), {"train": 1.0, "val": 0.0})).distinct().first()[0] == "train"
    assert divided_groups(refs.filter(F.lit(False)), ties).count() == 0


def test_a_giant_group_does_not_shift_the_shares(spark):
    """A third of all records in one group, the rest in groups of one to three."""
    refs = spark.range(6000).selectExpr("id ref_id", "'train' split")
    ties = spark.range(2000).selectExpr("id a", "0L b").union(spark.range(2000, 6000).selectExpr("id a", "case when id % 4 = 1 then id - 1 else id end b"))
    for seed in range(2):
        out = grouped_splits(refs, ties, seed=seed).groupBy("new_split").count().collect()
        share = {r["new_split"]: r["count"] / 6000 for r in out}
        assert abs(share["train"] - 0.8) < 0.03 and abs(share["val"] - 0.1) < 0.025 and abs(share["test"] - 0.1) < 0.025
    assert {r["new_split"] for r in grouped_splits(refs, ties, {"train": 1.0, "val": 0.0}).select("new_split").distinct().collect()} == {"train"}
    assert grouped_splits(refs.limit(0), ties).count() == 0
