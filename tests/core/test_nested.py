import json

from tracemill.operators import nested_records as n

STEP = "struct<type:string,parameters:string>"
SCHEMA = f"rec_no long, id string, snapshot string, instruction string, source string, config array<{STEP}>, related_apps array<string>, evaluator struct<func:string,result:string,expected:string,postconfig:array<{STEP}>>, raw struct<task_type:string,task_id:string>, task_id string, os string, fetched_at timestamp_ntz, variant string, files string"


def frame(spark, configs, post=None):
    rows = [(i, "x", None, None, None, c, None, None if post is None else ("f", None, None, post), None, None, None, None, "clash", "clash") for i, c in enumerate(configs)]
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return {tuple(r) for r in n.values(df).collect()}


def test_values(spark):
    p = {"files": [{"url": "u0", "path": "p"}, None, {"url": ""}, {"url": "u3", "files": [{"url": "deep"}]}, "text"], "command": ["a", "", None, 3, 2.5, True, ["x"], {"y": 1}]}
    twice = json.dumps(json.dumps(json.dumps({"command": "ls", "files": {"url": "one"}})))
    df = frame(spark, [[("download", json.dumps(p)), None, ("", twice), ("t", '{"command": ["cut'), (None, "[]"), ("z", None), ("w", '{"note": {"command": "x", "files": [{"url": "v"}]}}'), ("q", '{"command": NaN}'), ("r", "[" * 5000)], None, []], post=[("open", '{"command": 5}')])
    expected = {("config", 0, "type", 0), ("config", 0, "url", 0), ("config", 0, "url", 3), ("config", 0, "command", 0), ("config", 0, "command", 3), ("config", 0, "command", 4), ("config", 2, "url", 0), ("config", 2, "command", 0), ("config", 3, "type", 0), ("config", 5, "type", 0), ("config", 6, "type", 0), ("config", 7, "type", 0), ("config", 8, "type", 0)}
    post = {("postconfig", 0, "type", 0), ("postconfig", 0, "command", 0)}
    assert found(df) == {(0, *x) for x in expected | post} | {(r, *x) for r in (1, 2) for x in post}


def test_tables_lead_back(spark):
    df = frame(spark, [[("download", '{"files": [{"url": "a"}, {"url": "b", "path": "/p"}]}'), ("run", '{"command": ["x", 1]}'), ("bad", "{")]])
    t = n.flatten(df)
    steps = {(r.rec_no, r.section, r.step_idx): r.variant for r in t["steps"].collect()}
    assert steps == {(0, "config", 0): "files:[F]", (0, "config", 1): "command:[ms]", (0, "config", 2): "invalid"}
    for name in ("files", "commands"):
        assert all((r.rec_no, r.section, r.step_idx) in steps for r in t[name].collect())
    assert [(r.item_idx, r.url, r.path) for r in t["files"].orderBy("item_idx").collect()] == [(0, "a", None), (1, "b", "/p")]
    assert [(r.item_idx, r.value, r.kind) for r in t["commands"].orderBy("item_idx").collect()] == [(0, "x", "string"), (1, "1", "number")]
    assert t["records"].count() == 1
    assert all(x.limit(0).count() == 0 for x in t.values()) and n.values(df.limit(0)).count() == 0


def test_walk_and_assemble():
    for v in ({"a": [1, {"b": None}, []], "c": {}, "d": True, "e": "", "f": 1.5, "g": "1"}, [], {}, 3, [[["x"]], None]):
        rows = n.walk(v)
        assert n.assemble(rows) == v and [r[0] for r in rows] == list(range(len(rows))) and all(r[1] is None or r[1] < r[0] for r in rows)
    assert n.walk({"b": 1, "a": [2, "x"]})[0][5] == n.walk({"a": ["y", 7, 8], "b": 0.5})[0][5] == "{a:[ms],b:m}"
    assert n.walk([{"x": 1}, {"x": "t"}])[0][5] == "[{x:m}{x:s}]"
    assert n.walk({f"key{i}": i for i in range(100)})[0][5].startswith("#")
    assert n.members("{a:[ms],b:m,c:{d:s},e:n,f:s}") == {"b": "double", "e": "string", "f": "string"} and n.members("[m]") == {} == n.members("{}")
    deep = json.loads("[" * 800 + "]" * 800)
    assert len(n.walk(deep)) == 800


def test_nodes_subtypes_and_rebuild(spark):
    text = '{"files": [{"url": "a", "headers": [{"name": "h", "n": 2}]}, null], "deep": {"l": [[1], "x"]}}'
    df = frame(spark, [[("t", text), ("u", json.dumps(json.dumps({"name": "top", "n": 1}))), ("v", "{"), ("w", None)], None])
    found = n.nodes(df)
    sub = n.subtype(found, "{n:m,name:s}").collect()
    assert sorted((r.rec_no, r.step_idx, r.m_name, r.m_n) for r in sub) == [(0, 0, "h", 2.0), (0, 1, "top", 1.0)]
    head = next(r for r in sub if r.m_name == "h")
    ups = {r.node: r for r in found.filter("rec_no = 0 and step_idx = 0").collect()}
    chain = []
    at = head.node
    while at is not None:
        chain.append(ups[at].key or ups[at].item_idx)
        at = ups[at].parent
    assert chain == [0, "headers", 0, "files", None]
    again = {(r.rec_no, r.section, r.step_idx): json.loads(r.json) for r in n.rebuild(found).collect()}
    assert again == {(0, "config", 0): json.loads(text), (0, "config", 1): {"name": "top", "n": 1}}
    assert n.nodes(df.limit(0)).count() == 0 and n.subtype(found, "{zzz:s}").count() == 0
