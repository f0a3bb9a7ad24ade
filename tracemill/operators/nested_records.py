"""Nested, semi-structured task configs as flat tables with parent links.

Each step's ``parameters`` is JSON kept as text. A bottom-up tree automaton reads
the parsed tree: every node gets one of finitely many states from its label and
the states of its children, and the state of the root is the step's *variant*.
The variant says which typed subtype tables the step has rows in:

* ``records``  rec_no, id, task_id and the other plain columns  (supertype)
* ``steps``    rec_no, section, step_idx, type, variant          (supertype keys)
* ``files``    the steps' keys, item_idx, url, path              (variants with F)
* ``commands`` the steps' keys, item_idx, value, kind            (variants with C)
* ``nodes``    every value at any depth of the steps' parameters and of the evaluator's
  ``result`` and ``expected``: the steps' keys, node, parent, key, item_idx, type, shape, value

All tables lead back by (rec_no), (rec_no, section, step_idx) and (.., parent). A node's
``shape`` is its state in the full automaton: a letter for a leaf, the set of its elements'
states for a list, each key with its state for an object; so objects of one shape have the
same members, and :func:`subtype` makes a table with a typed column for each of them.
``nodes`` keeps all that the JSON holds: :func:`rebuild` makes the values anew from it.

One pass over the table, no shuffle: arrays are exploded in the JVM and the JSON
text goes through one Arrow UDF.

Defined cases: null or missing lists, steps and parameters give no rows below
them, null elements keep their places; JSON text encoded again (a JSON string that
holds JSON) is decoded until it is no string; broken JSON, JSON that is no object
and nesting deeper than Python's parser can follow have variant ``invalid`` and no
files or commands; NaN and Infinity are not JSON; of repeated keys in an object
the last counts; repeated rows are repeated records and keep rec_no.
"""

from __future__ import annotations

import hashlib
import json
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.session import ship_by_value

# states of leaves: null, boolean, number, text, empty text
NULL, BOOL, NUM, STR, EMPTY = "n", "b", "m", "s", "e"
# states of inner nodes: an object with a non-empty url, any other object
FILE, OBJ = "F", "o"

PARSED = T.StructType(
    [
        T.StructField("variant", T.StringType()),
        T.StructField("files", T.ArrayType(T.StructType([T.StructField("item_idx", T.IntegerType()), T.StructField("url", T.StringType()), T.StructField("path", T.StringType())]))),
        T.StructField("commands", T.ArrayType(T.StructType([T.StructField("item_idx", T.IntegerType()), T.StructField("value", T.StringType()), T.StructField("kind", T.StringType())]))),
    ]
)


def _no_constant(name):
    raise ValueError(name)


def _decode(text):
    return json.loads(text, parse_constant=_no_constant)


def unwrap(text: str | None):
    """The object that text holds, however often it was encoded, else None."""
    try:
        value = text
        while isinstance(value, str):
            value = _decode(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def leaf_state(value) -> str:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return BOOL
    if isinstance(value, (int, float)):
        return NUM
    if isinstance(value, str):
        return STR if value else EMPTY
    return OBJ


def entry_state(value) -> str:
    """Transition of an element: an object's state follows from that of its ``url``."""
    if isinstance(value, dict):
        return FILE if leaf_state(value.get("url")) in (STR, NUM) else OBJ
    return leaf_state(value) if not isinstance(value, list) else "l"


def member_state(value) -> str:
    """Transition of a list: the set of its elements' states, in a fixed order."""
    if isinstance(value, list):
        return "[" + "".join(sorted({entry_state(x) for x in value})) + "]"
    return entry_state(value)


def root_state(obj: dict | None) -> str:
    """The accepting state, ``files:...|command:...``; ``plain`` when it has neither."""
    if obj is None:
        return "invalid"
    parts = [f"{name}:{member_state(obj[name])}" for name in ("files", "command") if name in obj]
    return "|".join(parts) or "plain"


def _as_text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def _listed(value) -> list:
    return value if isinstance(value, list) else [value]


def route(obj: dict | None, variant: str) -> tuple[list, list]:
    """Rows of the subtype tables. Only variants whose state holds F, or s or m, have any."""
    files, commands = [], []
    for part in variant.split("|"):
        name, _, state = part.partition(":")
        if name == "files" and FILE in state:
            for i, x in enumerate(_listed(obj["files"])):
                if entry_state(x) == FILE:
                    path = x.get("path")
                    files.append((i, _as_text(x["url"]), path if isinstance(path, str) else None))
        elif name == "command" and (STR in state or NUM in state):
            for i, x in enumerate(_listed(obj["command"])):
                if leaf_state(x) in (STR, NUM):
                    commands.append((i, _as_text(x), "string" if isinstance(x, str) else "number"))
    return files, commands


def parse_parameters(texts: pd.Series) -> pd.DataFrame:
    variants, files, commands = [], [], []
    for text in texts:
        obj = unwrap(text) if isinstance(text, str) else None
        variant = "absent" if text is None else root_state(obj)
        f, c = route(obj, variant) if obj is not None else ([], [])
        variants.append(variant)
        files.append([{"item_idx": i, "url": u, "path": p} for i, u, p in f])
        commands.append([{"item_idx": i, "value": v, "kind": k} for i, v, k in c])
    return pd.DataFrame({"variant": variants, "files": files, "commands": commands})


#: a state written in more letters than this is named by its hash
STATE_LENGTH = 200


def kind_of(value) -> str:
    for kinds, name in ((dict, "object"), (list, "array"), (str, "string"), (bool, "boolean"), ((int, float), "number")):
        if isinstance(value, kinds):
            return name
    return "null"


def walk(value) -> list[tuple]:
    """``(node, parent, key, item_idx, type, shape, value)`` of value and all below it, parents first."""
    nodes: list[list] = []
    todo = [(value, None, None, None)]
    while todo:  # no recursion, so that depth is no matter
        v, parent, key, idx = todo.pop()
        no, kind = len(nodes), kind_of(v)
        text = None if kind in ("object", "array", "null") else _as_text(v)
        nodes.append([no, parent, key, idx, kind, None if kind in ("object", "array") else leaf_state(v), text])
        if kind == "object":
            todo += [(x, no, k, None) for k, x in reversed(v.items())]
        elif kind == "array":
            todo += [(x, no, None, i) for i, x in reversed(list(enumerate(v)))]
    below: dict[int, list[str]] = {}
    for n in reversed(nodes):  # children have greater numbers than their parent
        if n[5] is None:
            states = below.pop(n[0], [])
            state = "{" + ",".join(sorted(states)) + "}" if n[4] == "object" else "[" + "".join(sorted(set(states))) + "]"
            n[5] = state if len(state) <= STATE_LENGTH else "#" + hashlib.md5(state.encode("utf-8", "surrogatepass")).hexdigest()
        if n[1] is not None:
            below.setdefault(n[1], []).append(n[5] if n[2] is None else f"{n[2]}:{n[5]}")
    return [tuple(n) for n in nodes]


def unwrap_any(text: str):
    """Whether text holds JSON that is no string, however often it was encoded, and the value."""
    try:
        value = text
        while isinstance(value, str):
            value = _decode(value)
    except (ValueError, RecursionError):
        return False, None
    return True, value


NODES = T.ArrayType(
    T.StructType(
        [
            T.StructField("node", T.IntegerType()),
            T.StructField("parent", T.IntegerType()),
            T.StructField("key", T.StringType()),
            T.StructField("item_idx", T.IntegerType()),
            T.StructField("type", T.StringType()),
            T.StructField("shape", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )
)


def parse_nodes(texts: pd.Series) -> pd.Series:
    names = NODES.elementType.names
    out = []
    for text in texts:
        valid, value = unwrap_any(text) if isinstance(text, str) else (False, None)
        out.append([dict(zip(names, n)) for n in walk(value)] if valid else [])
    return pd.Series(out)


def assemble(rows) -> object:
    """The value whose nodes, as of :func:`walk`, are given."""
    made: dict[int, object] = {}
    for node, parent, key, idx, kind, _, text in sorted(rows):
        empty = {"object": dict, "array": list}.get(kind)
        v = empty() if empty else None if kind == "null" else text if kind == "string" else _decode(text)
        made[node] = v
        if parent is not None and not pd.isna(parent):
            above = made[int(parent)]
            if isinstance(above, dict):
                above[key] = v
            else:
                above.append(v)
    return made[0]


ship_by_value(sys.modules[__name__])
_nodes = F.pandas_udf(parse_nodes, NODES)
_parse = F.pandas_udf(parse_parameters, PARSED)


def _section(name: str, steps: Column) -> Column:
    # null stays null, so that the explode drops it
    return F.transform(steps, lambda s, i: F.struct(F.lit(name).alias("section"), i.cast("int").alias("step_idx"), s.getField("type").alias("type"), s.getField("parameters").alias("parameters")))


def steps(df: DataFrame, key: str = "rec_no") -> DataFrame:
    """``(rec_no, section, step_idx, type, variant, files, commands)``, one row per list element.

    A null element keeps its place: its type is null and its variant ``absent``.
    """
    none = F.expr("array()").cast("array<struct<section:string,step_idx:int,type:string,parameters:string>>")
    both = F.concat(F.coalesce(_section("config", F.col("config")), none), F.coalesce(_section("postconfig", F.col("evaluator.postconfig")), none))
    rows = df.select(F.col(key).alias("rec_no"), F.explode(both).alias("s")).select("rec_no", "s.*")
    parsed = rows.withColumn("p", _parse("parameters"))
    return parsed.select("rec_no", "section", "step_idx", "type", F.col("p.variant").alias("variant"), F.col("p.files").alias("files"), F.col("p.commands").alias("commands"))


def documents(df: DataFrame, key: str = "rec_no") -> DataFrame:
    """``(rec_no, section, step_idx, json)``: parameters of every step, and the evaluator's result and expected as step 0 of these sections."""
    none = F.expr("array()").cast("array<struct<section:string,step_idx:int,type:string,parameters:string>>")
    one = lambda name: F.struct(F.lit(name).alias("section"), F.lit(0).alias("step_idx"), F.lit(None).cast("string").alias("type"), F.col(f"evaluator.{name}").alias("parameters"))
    every = F.concat(F.coalesce(_section("config", F.col("config")), none), F.coalesce(_section("postconfig", F.col("evaluator.postconfig")), none), F.array(one("result"), one("expected")))
    rows = df.select(F.col(key).alias("rec_no"), F.explode(every).alias("s"))
    return rows.select("rec_no", "s.section", "s.step_idx", F.col("s.parameters").alias("json")).filter("json is not null")


def nodes(df: DataFrame, key: str = "rec_no") -> DataFrame:
    """``(rec_no, section, step_idx, node, parent, key, item_idx, type, shape, value)`` of every JSON value at any depth.

    node counts a document's values from 0, the root, whose parent is null; text that
    holds no JSON has no nodes.
    """
    return documents(df, key).withColumn("n", _nodes("json")).select("rec_no", "section", "step_idx", F.inline("n"))


def members(shape: str) -> dict[str, str]:
    """Leaf members of an object's shape with their column types; a shape named by its hash has none."""
    kinds = {NUM: "double", BOOL: "boolean", STR: "string", EMPTY: "string", NULL: "string"}
    out, depth, part = {}, 0, ""
    for c in (shape[1:-1] + ",") if shape[:1] == "{" else "":
        if c == "," and not depth:
            name, _, state = part.rpartition(":")
            if state in kinds and name:
                out[name] = kinds[state]
            part = ""
            continue
        depth += (c in "[{") - (c in "]}")
        part += c
    return out


def subtype(found: DataFrame, *shapes: str) -> DataFrame:
    """Table of the objects of these shapes: the nodes' keys and a typed column per leaf member.

    found is what :func:`nodes` gives. A member that is of several types in the shapes, or
    missing in some, is a string, null where it is missing.
    """
    kinds: dict[str, str] = {}
    for s in shapes:
        for name, kind in members(s).items():
            kinds[name] = kind if kinds.get(name, kind) == kind else "string"
    keys = ["rec_no", "section", "step_idx"]
    objects = found.filter(F.col("shape").isin(*shapes)).select(*keys, "node", "parent", F.col("key").alias("in_key"), "item_idx", "shape")
    if not kinds:
        return objects
    leaves = found.filter(F.col("key").isin(*kinds) & ~F.col("type").isin("object", "array"))
    columns = [F.max(F.when(F.col("key") == n, F.col("value"))).cast(k).alias(f"m_{n}") for n, k in kinds.items()]
    wide = leaves.groupBy(*keys, F.col("parent").alias("node")).agg(*columns)
    return objects.join(wide, [*keys, "node"], "left").select(*keys, "node", "parent", "in_key", "item_idx", "shape", *[f"m_{n}" for n in kinds])


def rebuild(found: DataFrame) -> DataFrame:
    """``(rec_no, section, step_idx, json)``: each document again, made from its nodes alone, with sorted keys."""
    names = NODES.elementType.names
    parts = found.groupBy("rec_no", "section", "step_idx").agg(F.collect_list(F.struct(*names)).alias("all"))

    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(assemble([tuple(n[c] for c in names) for n in rows]), sort_keys=True) for rows in lists])

    return parts.select("rec_no", "section", "step_idx", F.pandas_udf(run, "string")("all").alias("json"))


def normal_json(text: Column) -> Column:
    """The JSON value that text holds, however often it was encoded, written with sorted keys; null for none."""

    def run(texts: pd.Series) -> pd.Series:
        found = [unwrap_any(t) if isinstance(t, str) else (False, None) for t in texts]
        return pd.Series([json.dumps(v, sort_keys=True) if ok else None for ok, v in found], dtype=object)

    return F.pandas_udf(run, "string")(text)


def flatten(df: DataFrame, key: str = "rec_no") -> dict[str, DataFrame]:
    """The five tables. ``files`` and ``commands`` hold only steps of their variants."""
    s = steps(df, key)
    keys = ["rec_no", "section", "step_idx", "variant"]
    record = df.select(
        F.col(key).alias("rec_no"), "id", "snapshot", "instruction", "source", "task_id", "os", "fetched_at", "related_apps",
        F.col("evaluator.func").alias("evaluator_func"), F.col("raw.task_type").alias("raw_task_type"), F.col("raw.task_id").alias("raw_task_id"),
    )
    return {
        "records": record,
        "steps": s.select("rec_no", "section", "step_idx", "type", "variant"),
        "files": s.select(*keys, F.inline("files")),
        "commands": s.select(*keys, F.inline("commands")),
        "nodes": nodes(df, key),
    }


def values(df: DataFrame, key: str = "rec_no") -> DataFrame:
    """``(rec_no, section, step_idx, field, item_idx)``: one row per non-empty type, url and command part."""
    item = lambda field: lambda x: F.struct(F.lit(field).alias("field"), x.getField("item_idx").alias("item_idx"))
    kind = F.when(F.length("type") > 0, F.array(F.struct(F.lit("type").alias("field"), F.lit(0).alias("item_idx")))).otherwise(
        F.expr("array()").cast("array<struct<field:string,item_idx:int>>")
    )
    found = F.concat(kind, F.transform("files", item("url")), F.transform("commands", item("command")))
    return steps(df, key).select("rec_no", "section", "step_idx", F.inline(found))
