import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxlake.operators.nested import LIST_FIELDS, dewey_json, dewey_typed, flat_tables, json_nodes, with_links

OBJ = "image_id string, objects array<struct<bbox:array<float>,meta_json:string>>, pos int, list_name string"


def brute(value, path, out):
    if isinstance(value, dict):
        for k, x in value.items():
            if k in LIST_FIELDS:
                x = json.loads(x) if isinstance(x, str) and x[:1] in "[{" else x
                x = [x] if isinstance(x, dict) else x
            brute(x, f"{path}.{k}" if path else k, out)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            if isinstance(x, dict):
                out.add(f"{path}[{i}]")
            brute(x, f"{path}[{i}]", out)
    return out


leaf = st.none() | st.integers(0, 9) | st.text("ab[{", max_size=3)
tree = st.recursive(leaf, lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["a", "parts", "edits"]), c, max_size=3), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(tree)
def test_json_nodes(value):
    if isinstance(value, str):
        return
    try:
        want = brute(value, "", set())
    except json.JSONDecodeError:
        return
    assert {p for p, _ in json_nodes(json.dumps(value))} == want
    assert {p for p, _ in json_nodes(json.dumps(json.dumps(value)))} == want


def test_odd_json():
    assert json_nodes(None) == json_nodes("") == json_nodes('{"parts": [{') == json_nodes("5") == []
    assert json_nodes("[" * 5000 + "]" * 5000) == []
    assert [p for p, _ in json_nodes('{"reviews": "[{\\"rounds\\": {\\"n\\": 1}}, null]"}')] == ["reviews[0]", "reviews[0].rounds[0]"]


def test_tables(spark):
    long = json.dumps({"keypoints": [{"n": "x" * 200_000}]})
    rows = [("a", [([1.0], '{"parts": [{"subparts": [{"k": 1}, null, {"k": 2}]}], "contours": [[{"x": 1}]]}'), None, ([2.0], None), ([3.0], '{"x": ')], 7, "q"), ("b", None, 1, "q"), ("c", [], 1, "q"), (None, [([1.0], long)], 1, "q")]
    df = spark.createDataFrame(rows, OBJ)
    nodes = with_links(dewey_json(df, "image_id", "objects", "meta_json", "objects", True))
    got = {(r["image_id"], r["pos"], r["child_path"]): r for r in nodes.collect()}
    assert set(got) == {("a", 0, ""), ("a", 2, ""), ("a", 3, ""), ("a", 0, "parts[0]"), ("a", 0, "parts[0].subparts[0]"), ("a", 0, "parts[0].subparts[2]"), ("a", 0, "contours[0][0]"), (None, 0, ""), (None, 0, "keypoints[0]")}
    r = got["a", 0, "parts[0].subparts[2]"]
    assert (r["parent_path"], r["schema_path"], r["parent_schema_path"], r["ordinals"], json.loads(r["value"])) == ("parts[0]", "objects[].parts[].subparts[]", "objects[].parts[]", [0, 0, 2], {"k": 2})
    assert got["a", 0, "contours[0][0]"]["parent_path"] == "" and got["a", 0, ""]["parent_path"] is None
    tables = flat_tables(nodes)
    assert dict(tables["objects[].parts[].subparts[]"].dtypes)["k"] == "bigint" and sorted(r["k"] for r in tables["objects[].parts[].subparts[]"].collect()) == [1, 2]
    assert dict(tables["objects[]"].dtypes)["bbox"] == "array<double>" and tables["objects[]"].count() == 4 and "k" not in tables["objects[]"].columns
    assert flat_tables(nodes.filter(F.lit(False))) == {}
    own = dewey_json(df.withColumn("objects", F.transform("objects", lambda o: o.withField("meta_json", F.lit('{"pieces": "{\\"a\\": 1}", "parts": {"a": 1}}')))), "image_id", "objects", "meta_json", "objects", list_fields=("pieces",))
    assert {r["child_path"] for r in own.collect()} == {"", "pieces[0]"}
    assert set(flat_tables(nodes)) == {"objects[]", "objects[].parts[]", "objects[].parts[].subparts[]", "objects[].contours[][]", "objects[].keypoints[]"}
    assert dewey_json(df.filter(F.lit(False)), "image_id", "objects", "meta_json", "objects").count() == 0
    assert dewey_json(df.unionByName(df), "image_id", "objects", "meta_json", "objects").count() == 18


def test_typed(spark):
    kind = "image_id string, targets array<struct<label:string,meta:struct<track:struct<keyframes:array<struct<frame:int,occluders:array<struct<label:string>>>>>>>>"
    row = ("a", [("car", (([(1, [("x",), None]), None, (2, None)],),)), None, ("bus", None)])
    got = {(r["pos"], r["child_path"]) for r in dewey_typed(spark.createDataFrame([row, ("b", None)], kind), "image_id", "targets", "targets").collect()}
    assert got == {(0, ""), (2, ""), (0, "meta.track.keyframes[0]"), (0, "meta.track.keyframes[0].occluders[0]"), (0, "meta.track.keyframes[2]")}


def test_whole_values(spark):
    deep = "[" * 30_000 + '{"x": 1}' + "]" * 30_000
    text = {
        "own": '{"area": 2.5, "attributes": {"occluded": false, "shape": {"kind": "box"}}, "tags": ["a", "b"], "ring": [[1, 2], [3]], "parts": [{"name": "p", "at": [1, 2], "in": {"k": 1}, "subparts": "[{\\"k\\": 2}]"}, 7], "edits": []}',
        "cut": '{"parts": [{"a": 1}',
        "long": '{"n": ' + "1" * 5_000 + ', "parts": [{"m": ' + "2" * 2_000 + "}]}",
        "deep": deep,
        "half": '{"\\ud800": [{"a": "\\ud801"}]}',
        "twice": '{"parts": [{"a": 1}, {"a": 2}], "parts": [{"a": 3}]}',
        "comma": '{"parts": [{"a": 1},],}',
        "odd": '{"parts": [{"a`b": 1, "c:d, e": 2, "A": 3, "a": 4, "f.g": 5, "f": {"g": 6}, "": 7, "n": NaN, "pos": 8}]}',
    }
    df = spark.createDataFrame([(k, [([1.0], t)]) for k, t in text.items()], "image_id string, objects array<struct<bbox:array<float>,meta_json:string>>")
    nodes = with_links(dewey_json(df, "image_id", "objects", "meta_json", "objects", True))
    got = {(r["image_id"], r["child_path"]): json.loads(r["value"]) for r in nodes.collect()}
    bare = {(r["image_id"], r["child_path"]) for r in dewey_json(df, "image_id", "objects", "meta_json", "objects").collect()}
    assert bare == set(got)
    assert got["own", ""] == {"bbox": [1.0], "meta_json.area": 2.5, "meta_json.attributes.occluded": False, "meta_json.attributes.shape.kind": "box", "meta_json.tags": ["a", "b"], "meta_json.ring": [[1, 2], [3]], "meta_json.parts": [None, 7]}
    assert got["own", "parts[0]"] == {"name": "p", "at": [1, 2], "in.k": 1} and got["own", "parts[0].subparts[0]"] == {"k": 2}
    assert got["cut", ""] == {"bbox": [1.0], "meta_json": text["cut"]} and ("cut", "parts[0]") not in got
    assert got["long", "parts[0]"] == {"m": "2" * 2_000} and got["long", ""]["meta_json.n"] == "1" * 5_000
    assert got["deep", "[0]" * 30_000] == {"x": 1}
    assert got["half", "\\ud800[0]"] == {"a": "\ud801"}
    assert {p for k, p in got if k == "twice"} == {"", "parts[0]", "parts[1]"} and sum(r["child_path"] == "parts[0]" for r in nodes.filter("image_id = 'twice'").collect()) == 2
    assert ("comma", "parts[0]") in got
    tables = flat_tables(nodes)
    root = {r["image_id"]: r for r in tables["objects[]"].collect()}
    kinds = dict(tables["objects[]"].dtypes)
    assert kinds["meta_json.area"] == "double" and kinds["meta_json.ring"] == "array<array<bigint>>" and root["own"]["meta_json.attributes.occluded"] is False
    part = next(r.asDict() for r in tables["objects[].parts[]"].collect() if r["image_id"] == "odd")
    assert [part[c] for c in ("a`b", "c:d, e", "f.g", "f.g_", "_", "pos_")] == [1, 2, 5, 6, 7, 8] and sorted(part[c] for c in part if c.strip("_").lower() == "a" and part[c]) == [3, 4]
    assert tables["objects[]." + "[]" * 30_000].count() == 1


def test_typed_values(spark):
    kind = "image_id string, targets array<struct<label:string,meta:struct<track:struct<track_id:string,keyframes:array<struct<frame:int,bbox:array<float>>>>,reviews:array<struct<annotator:string>>>>>"
    df = spark.createDataFrame([("a", [("car", (("t1", [(1, [1.5, 2.0])]), [("x",)]))])], kind)
    got = {r["child_path"]: json.loads(r["value"]) for r in dewey_typed(df, "image_id", "targets", "targets", True).collect()}
    assert got == {"": {"label": "car", "meta.track.track_id": "t1"}, "meta.track.keyframes[0]": {"frame": 1, "bbox": [1.5, 2.0]}, "meta.reviews[0]": {"annotator": "x"}}
