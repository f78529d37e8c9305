import json
import random

from pyspark.sql import types as T

from foliant.operators import nested

LISTS, WRAP = ("divisions", "children"), ("tree",)
SCHEMA = "pub_id string, received_at string, tree string"


def rows_of(doc):
    """Brute force: (ord, parent_ord, type)."""
    out = []

    def items(v):
        if isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                return []
        return [x for x in ([v] if isinstance(v, dict) else v if isinstance(v, list) else []) if isinstance(x, dict)]

    def walk(v, up):
        for x in items(v):
            out.append((len(out) + 1, up, x.get("type")))
            walk(x.get("children"), len(out))

    walk(doc["divisions"], 0)
    return out


def flat(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    t = nested.latest_readable(df, "pub_id", "received_at", "tree", LISTS, WRAP)
    n = nested.node_rows(t, ["pub_id"], {"type": T.StringType()}, "children", nested.shape(t, "children").levels)
    return sorted((r.pub_id, r.ord, r.parent_ord, r.type) for r in n.collect())


def make(rng, depth):
    kids = []
    for _ in range(rng.randint(0, 3 if depth else 2)):
        node = {"type": rng.choice(["a", "b", "c"]), "x_note": {"children": [{"type": "no"}]}}
        if depth < 5:
            got = make(rng, depth + 1)
            way = rng.randint(0, 5)
            if way == 0:
                node["children"] = None
            elif way == 1 and got:
                node["children"] = got[0]
            elif way == 2:
                node["children"] = json.dumps(got)
            elif way < 5:
                node["children"] = got
        kids.append(node)
        if rng.random() < 0.2:
            kids.append(None)
    return kids


def test_random_trees_equal_brute_force(spark):
    rng, rows, want = random.Random(5), [], []
    for i in range(40):
        doc = {"divisions": make(rng, 0)}
        text = json.dumps(doc if i % 3 else {"tree": doc, "by": "x"})
        rows.append((f"p{i}", "2025", json.dumps(text) if i % 5 == 0 else text))
        want += [(f"p{i}", *r) for r in rows_of(doc)]
    assert flat(spark, rows) == sorted(want, key=lambda r: (r[0], r[1]))


def test_latest_readable_counts_and_bad_shapes(spark):
    ok = {"divisions": [{"type": "division", "children": ["junk", 3, None, {"type": "text"}, [1]]}]}
    rows = [
        ("p", "2025-01", json.dumps({"divisions": [{"type": "old"}]})),
        ("p", "2025-02", json.dumps(ok)),
        ("p", "2025-02", json.dumps(ok)),
        ("p", "2025-03", json.dumps(ok)[:-4]),
        ("p", "2025-04", None),
        ("p", "2025-05", ""),
        ("q", None, "[1, 2]"),
        ("r", "2025-01", json.dumps({"divisions": None})),
        ("s", "2025-01", json.dumps({"divisions": {"type": "division", "children": "no json"}})),
    ]
    assert flat(spark, rows) == [("p", 1, 0, "division"), ("p", 2, 1, "text"), ("s", 1, 0, "division")]
    assert flat(spark, []) == []


def test_relate_keeps_links_and_clashing_names(spark):
    df = spark.createDataFrame(
        [(1, 7, [{"_id": 1, "c": [{"v": "x"}, None]}, {"_id": 2, "c": []}]), (2, None, None), (None, 9, [])],
        "id int, _pos int, kids array<struct<_id:int,c:array<struct<v:string>>>>",
    )
    t = nested.relate(df, ["id"])
    assert set(t) == {"root", "root.kids", "root.kids.c"}
    assert t["root"].count() == 3 and "_pos_2" in t["root"].columns
    kids = {(r._parent_id, r._pos, r._id_2) for r in t["root.kids"].collect()}
    assert kids == {("1", 0, 1), ("1", 1, 2)}
    leaf = [(r._parent_id, r._pos, r.v) for r in t["root.kids.c"].orderBy("_pos").collect()]
    assert leaf == [("1/kids:0", 0, "x"), ("1/kids:0", 1, None)]


def test_merged_schema(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [{"c": "x"}]}',), ('{"b": [{"d": 2.5}]}',), ("bad",), (None,)], "j string")
    s = nested.merged_schema(df, "j").simpleString()
    assert "a:bigint" in s and "c:string" in s and "d:decimal" in s
    assert nested.merged_schema(df.limit(0), "j").simpleString() == "void"


def test_node_table_holds_every_field(spark, tmp_path):
    from foliant.plans import records

    kid = {"type": "table", "columns": ["a", None], "rows": [["1", "2"], [], None, ["3"]], "grid": True, "Type": "other case", "ord": 9, "x_mix": 1, "x_list": [{"k": 1, "m": ["u"]}]}
    note = {"type": "acronym", "abbreviation": "AB", "meaning": "a b", "proponent": False, "page": 4, "x_note": {"by": "me", "seen": [1, {"type": "no"}]}, "x_mix": {"q": 2}, "key": None, "title": ["odd"]}
    doc = {"divisions": [{"type": "division", "children": json.dumps([kid])}, {"type": "division", "children": note}]}
    spark.createDataFrame([("p", "1", json.dumps(doc))], SCHEMA).write.parquet(f"{tmp_path}/doc_trees.parquet")
    n = {r.ord: r for r in records.p2_node_table(spark, str(tmp_path)).collect()}
    assert [(n[i].parent_ord, n[i].type, n[i].path) for i in sorted(n)] == [(0, "division", "1"), (1, "table", "1.1"), (0, "division", "2"), (3, "acronym", "2.1")]
    assert (n[2].grid, n[2].Type_2, n[2].ord_2, n[2].x_mix, n[2].page) == (True, "other case", 9, "1", None)
    assert (n[4].abbreviation, n[4].meaning, n[4].proponent, n[4].page, n[4].x_note_by, n[4].x_mix, n[4].title) == ("AB", "a b", False, 4, "me", '{"q":2}', '["odd"]')
    a = {(r.array_path, r._parent_id, r._pos, r.value) for r in records.p2_node_arrays(spark, str(tmp_path)).collect()}
    assert {x[1:] for x in a if x[0] == "nodes.columns"} == {("p/2", 0, "a"), ("p/2", 1, None)}
    assert {x[1:] for x in a if x[0] == "nodes.rows"} == {("p/2", i, None) for i in range(4)}
    assert {x[1:] for x in a if x[0] == "nodes.rows.items"} == {("p/2/rows:0", 0, "1"), ("p/2/rows:0", 1, "2"), ("p/2/rows:3", 0, "3")}
    assert {x[1:] for x in a if x[0] == "nodes.x_note_seen"} == {("p/4", 0, "1"), ("p/4", 1, '{"type":"no"}')}
    assert {x[1:] for x in a if x[0].startswith("nodes.x_list")} == {("p/2", 0, '{"k":1}'), ("p/2/x_list:0", 0, "u")}


def test_node_table_without_trees(spark, tmp_path):
    from foliant.plans import records

    spark.createDataFrame([("p", "1", "bad")], SCHEMA).write.parquet(f"{tmp_path}/doc_trees.parquet")
    assert records.p2_node_table(spark, str(tmp_path)).collect() == [] == records.p2_node_arrays(spark, str(tmp_path)).collect()


def test_trees_of_any_depth(spark):
    deep = 4_000
    text = '{"divisions": [' + '{"type": "x", "children": [' * deep + "]}" * deep + ', {"type": "last"}]}'
    got = flat(spark, [("p", "1", text), ("q", "1", json.dumps({"divisions": [{"type": "a", "x": 1}]}))])
    assert len(got) == deep + 2
    assert got[:2] == [("p", 1, 0, "x"), ("p", 2, 1, "x")] and got[deep - 1 : deep + 1] == [("p", deep, deep - 1, "x"), ("p", deep + 1, 0, "last")]
    wrapped = json.dumps({"divisions": [{"type": "w"}]})
    for i in range(12):
        wrapped = json.dumps({"tree": json.loads(wrapped)} if i % 2 else [json.loads(wrapped)])
    assert flat(spark, [("p", "1", wrapped)]) == [("p", 1, 0, "w")]
    far = '{"divisions": [{"type": "t", "x": ' + "[" * 900 + "]" * 900 + "}]}"
    assert flat(spark, [("p", "1", far)]) == [("p", 1, 0, "t")]


def test_loads_without_recursion():
    rng = random.Random(2)

    def value(d):
        k = rng.randint(0, 6 if d else 3)
        if k == 4:
            return {f"k{i}": value(d - 1) for i in range(rng.randint(0, 3))}
        return [value(d - 1) for _ in range(rng.randint(0, 3))] if k > 4 else [None, True, -1.5e3, 'a "b" \\ \n,:{}'][k]

    class Deep:  # the recursive reader always gives up
        loads = staticmethod(lambda t: real(t) if t[:1] not in "[{" else (_ for _ in ()).throw(RecursionError))
        dumps = staticmethod(json.dumps)

    real, held = json.loads, nested.json
    nested.json = Deep
    try:
        for _ in range(300):
            v = [value(4)]
            text = json.dumps(v, indent=rng.choice([None, 1]))
            assert nested.loads(text) == v
            cut = text[: rng.randint(1, len(text) - 1)]
            bad = cut + rng.choice(["", ",", "]", "}", ":", "1", '"'])
            try:
                want = real(bad)
            except ValueError:
                want = None
            try:
                got = nested.loads(bad)
            except ValueError:
                got = None
            assert got == want, bad
    finally:
        nested.json = held
