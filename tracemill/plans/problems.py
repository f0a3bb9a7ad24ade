"""The general training-data problems: nested records (2) and incremental runs (5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.operators import merkle, nested_records
from tracemill.plans.registry import CORE
from tracemill.session import table

TASK_COLUMNS = ("rec_no", "id", "snapshot", "instruction", "source", "config", "related_apps", "evaluator", "raw", "task_id", "os", "fetched_at")

# JSON text may be encoded again and again; the oracle unwraps four times
_P2_STEPS = r"""
WITH s AS (
  SELECT rec_no, 'config' AS section, unnest(config) AS st, CAST(generate_subscripts(config, 1) - 1 AS INTEGER) AS step_idx FROM task_config
  UNION ALL
  SELECT rec_no, 'postconfig', unnest(evaluator.postconfig), CAST(generate_subscripts(evaluator.postconfig, 1) - 1 AS INTEGER) FROM task_config
), u0 AS (SELECT rec_no, section, step_idx, st.type AS type, CASE WHEN json_valid(st.parameters) THEN CAST(st.parameters AS JSON) END AS j FROM s
), u1 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u0
), u2 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u1
), u3 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u2
), u4 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u3
), p AS (SELECT rec_no, section, step_idx, type, CASE WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM u4
), f0 AS (SELECT rec_no, section, step_idx, CASE WHEN json_type(j->'$.files') = 'ARRAY' THEN CAST(j->'$.files' AS JSON[]) ELSE [j->'$.files'] END AS l FROM p WHERE json_type(j->'$.files') IS NOT NULL
), f AS (SELECT rec_no, section, step_idx, unnest(l) AS e, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_idx FROM f0
), c0 AS (SELECT rec_no, section, step_idx, CASE WHEN json_type(j->'$.command') = 'ARRAY' THEN CAST(j->'$.command' AS JSON[]) ELSE [j->'$.command'] END AS l FROM p WHERE json_type(j->'$.command') IS NOT NULL
), c AS (SELECT rec_no, section, step_idx, unnest(l) AS e, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_idx FROM c0
), urls AS (SELECT rec_no, section, step_idx, item_idx, e->>'$.url' AS url, CASE WHEN json_type(e->'$.path') = 'VARCHAR' THEN e->>'$.path' END AS path FROM f
  WHERE json_type(e) = 'OBJECT' AND json_type(e->'$.url') IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') AND e->>'$.url' <> ''
), parts AS (SELECT rec_no, section, step_idx, item_idx, e->>'$' AS value, CASE WHEN json_type(e) = 'VARCHAR' THEN 'string' ELSE 'number' END AS kind FROM c
  WHERE json_type(e) IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') AND e->>'$' <> '')
"""


@CORE.query(
    "p2_found",
    _P2_STEPS
    + """SELECT rec_no, section, step_idx, 'type' AS field, CAST(0 AS INTEGER) AS item_idx FROM p WHERE length(type) > 0
UNION ALL SELECT rec_no, section, step_idx, 'url', item_idx FROM urls
UNION ALL SELECT rec_no, section, step_idx, 'command', item_idx FROM parts""",
)
def p2_found(spark, d):
    return nested_records.values(table(spark, d, "task_config", "rec_no", "config", "evaluator"))


@CORE.query("p2_files", _P2_STEPS + "SELECT rec_no, section, step_idx, item_idx, url, path FROM urls")
def p2_files(spark, d):
    return nested_records.flatten(table(spark, d, "task_config", *TASK_COLUMNS))["files"].drop("variant")


@CORE.query("p2_commands", _P2_STEPS + "SELECT rec_no, section, step_idx, item_idx, value, kind FROM parts")
def p2_commands(spark, d):
    return nested_records.flatten(table(spark, d, "task_config", *TASK_COLUMNS))["commands"].drop("variant")


@CORE.query("p2_steps", _P2_STEPS + "SELECT rec_no, section, step_idx, type FROM p")
def p2_steps(spark, d):
    return nested_records.flatten(table(spark, d, "task_config", *TASK_COLUMNS))["steps"].drop("variant")


_P2_STATE = """CASE coalesce(json_type({e}), 'NULL') WHEN 'NULL' THEN 'n' WHEN 'BOOLEAN' THEN 'b' WHEN 'VARCHAR' THEN CASE WHEN {e}->>'$' = '' THEN 'e' ELSE 's' END WHEN 'ARRAY' THEN 'l'
WHEN 'OBJECT' THEN CASE WHEN json_type({e}->'$.url') IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR (json_type({e}->'$.url') = 'VARCHAR' AND {e}->>'$.url' <> '') THEN 'F' ELSE 'o' END ELSE 'm' END"""


def _p2_member(name: str) -> str:
    at = f"(j->'$.{name}')"
    listed = f"'[' || coalesce(array_to_string(list_sort(list_distinct(list_transform(CAST({at} AS JSON[]), lambda x: {_P2_STATE.format(e='x')}))), ''), '') || ']'"
    return f"CASE WHEN json_type({at}) = 'ARRAY' THEN '{name}:' || {listed} WHEN json_type({at}) IS NOT NULL THEN '{name}:' || {_P2_STATE.format(e=at)} END"


@CORE.query(
    "p2_variants",
    _P2_STEPS
    + f""", v AS (SELECT p.section, CASE WHEN s.st.parameters IS NULL THEN 'absent' WHEN p.j IS NULL THEN 'invalid'
  ELSE coalesce(nullif(concat_ws('|', {_p2_member("files")}, {_p2_member("command")}), ''), 'plain') END AS variant
  FROM p JOIN s ON p.rec_no = s.rec_no AND p.section = s.section AND p.step_idx = s.step_idx)
SELECT section, variant, count(*) AS n_steps FROM v GROUP BY ALL""",
)
def p2_variants(spark, d):
    """How many steps the automaton sent to each variant."""
    return nested_records.flatten(table(spark, d, "task_config", *TASK_COLUMNS))["steps"].groupBy("section", "variant").agg(F.count("*").alias("n_steps"))


@CORE.query(
    "p2_records",
    """SELECT rec_no, id, snapshot, instruction, source, task_id, os, fetched_at, array_to_string(related_apps, '|') AS related_apps,
evaluator.func AS evaluator_func, raw.task_type AS raw_task_type, raw.task_id AS raw_task_id FROM task_config""",
)
def p2_records(spark, d):
    r = nested_records.flatten(table(spark, d, "task_config", *TASK_COLUMNS))["records"]
    return r.withColumn("related_apps", F.array_join("related_apps", "|"))


# every JSON document of a record, unwrapped, with its nodes
_P2_NODES = r"""
WITH s AS (
  SELECT rec_no, 'config' AS section, unnest(config).parameters AS t, CAST(generate_subscripts(config, 1) - 1 AS INTEGER) AS step_idx FROM task_config
  UNION ALL SELECT rec_no, 'postconfig', unnest(evaluator.postconfig).parameters, CAST(generate_subscripts(evaluator.postconfig, 1) - 1 AS INTEGER) FROM task_config
  UNION ALL SELECT rec_no, 'result', evaluator.result, 0 FROM task_config
  UNION ALL SELECT rec_no, 'expected', evaluator.expected, 0 FROM task_config
), u0 AS (SELECT rec_no, section, step_idx, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM s
), u1 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u0
), u2 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u1
), u3 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u2
), u4 AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN CAST(j->>'$' AS JSON) END ELSE j END AS j) FROM u3
), docs AS (SELECT rec_no, section, step_idx, j FROM u4 WHERE j IS NOT NULL AND json_type(j) <> 'VARCHAR'
), tree AS (SELECT rec_no, section, step_idx, t.id, t.parent, t.key, t.type, t.value FROM docs, json_tree(docs.j) AS t)
"""


def _nodes(spark, d):
    return nested_records.nodes(table(spark, d, "task_config", "rec_no", "config", "evaluator"))


@CORE.query(
    "p2_nodes",
    _P2_NODES
    + """, named AS (SELECT n.*, p.key AS in_key, p.type AS in_type FROM tree n LEFT JOIN tree p ON n.rec_no = p.rec_no AND n.section = p.section AND n.step_idx = p.step_idx AND n.parent = p.id)
SELECT rec_no, section, step_idx, CASE WHEN in_type = 'OBJECT' THEN key END AS key, CASE WHEN in_type = 'ARRAY' THEN CAST(key AS INTEGER) END AS item_idx, in_key,
CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS type,
CASE WHEN type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN value->>'$' END AS value FROM named""",
)
def p2_nodes(spark, d):
    """Every JSON value of every record with its place in its parent and the parent's own place."""
    n = _nodes(spark, d)
    keys = ["rec_no", "section", "step_idx"]
    above = n.select(*keys, F.col("node").alias("parent"), F.coalesce("key", F.col("item_idx").cast("string")).alias("in_key"))
    return n.join(above, [*keys, "parent"], "left").select(*keys, "key", "item_idx", "in_key", "type", "value")


@CORE.query("p2_rebuilt", _P2_NODES + "SELECT rec_no, section, step_idx, true AS same FROM docs")
def p2_rebuilt(spark, d):
    """Whether each document, made anew from its nodes alone, is the one in the table."""
    t = table(spark, d, "task_config", "rec_no", "config", "evaluator")
    own = nested_records.documents(t).select("rec_no", "section", "step_idx", nested_records.normal_json(F.col("json")).alias("was")).filter("was is not null")
    again = nested_records.rebuild(nested_records.nodes(t))
    return own.join(again, ["rec_no", "section", "step_idx"], "left").select("rec_no", "section", "step_idx", F.coalesce(F.col("was") == F.col("json"), F.lit(False)).alias("same"))


@CORE.query(
    "p2_headers",
    _P2_STEPS
    + """, h0 AS (SELECT rec_no, section, step_idx, item_idx AS file_idx, CAST(e->'$.headers' AS JSON[]) AS l FROM f WHERE json_type(e->'$.headers') = 'ARRAY'),
h AS (SELECT rec_no, section, step_idx, file_idx, unnest(l) AS e, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_idx FROM h0)
SELECT rec_no, section, step_idx, file_idx, item_idx, e->>'$.name' AS name, e->>'$.url' AS url FROM h WHERE json_type(e->'$.name') = 'VARCHAR' AND json_type(e->'$.url') = 'VARCHAR' AND len(json_keys(e)) = 2""",
)
def p2_headers(spark, d):
    """Headers of files, the objects of one shape, with the place of their file: a subtype table two levels down."""
    n = _nodes(spark, d)
    keys = ["rec_no", "section", "step_idx"]
    found = nested_records.subtype(n, *[f"{{name:{a},url:{b}}}" for a in "se" for b in "se"])
    lists = n.filter("type = 'array' and key = 'headers'").select(*keys, F.col("node").alias("parent"), F.col("parent").alias("file"))
    top = n.filter("type = 'array' and key = 'files' and parent = 0").select(*keys, F.col("node").alias("list"))
    listed = n.filter("type = 'object' and item_idx is not null").select(*keys, F.col("node").alias("file"), F.col("item_idx").alias("file_idx"), F.col("parent").alias("list")).join(top, [*keys, "list"], "left_semi")
    alone = n.filter("type = 'object' and key = 'files' and parent = 0").select(*keys, F.col("node").alias("file"), F.lit(0).alias("file_idx"))
    placed = found.join(lists, [*keys, "parent"]).join(listed.drop("list").unionByName(alone), [*keys, "file"])
    return placed.filter("section in ('config', 'postconfig')").select(*keys, "file_idx", "item_idx", F.col("m_name").alias("name"), F.col("m_url").alias("url"))


@CORE.query("p2_shapes", _P2_NODES + "SELECT section, json_type(j) = 'ARRAY' AS is_list, count(*) AS n FROM docs GROUP BY ALL")
def p2_shapes(spark, d):
    """Documents by section and by whether their root is a list."""
    roots = _nodes(spark, d).filter("parent is null")
    return roots.groupBy("section", (F.col("type") == "array").alias("is_list")).agg(F.count("*").alias("n"))


_P5 = """
WITH cur AS (SELECT id, max(used) AS used, max(create_at) AS create_at FROM rollout_run WHERE id IS NOT NULL GROUP BY id),
good AS (SELECT DISTINCT s.rollout_id, s.sync_no, s.used, s.create_at FROM monitor_seen s JOIN monitor_run r ON s.sync_no = r.sync_no WHERE r.status = 'COMPLETED'),
seen AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY rollout_id ORDER BY sync_no DESC) = 1)
"""


def _p5_diff(spark, d):
    current = merkle.records(table(spark, d, "rollout_run", "id", "used", "create_at"), "id", ["used", "create_at"])
    saved = merkle.last_seen(table(spark, d, "monitor_seen", "sync_no", "rollout_id", "used", "create_at"), table(spark, d, "monitor_run", "sync_no", "status"))
    return merkle.diff(current, saved)


@CORE.query(
    "p5_found",
    _P5
    + """SELECT c.id FROM cur c LEFT JOIN seen s ON c.id = s.rollout_id
WHERE s.rollout_id IS NULL OR c.used IS DISTINCT FROM s.used OR c.create_at IS DISTINCT FROM s.create_at""",
)
def p5_found(spark, d):
    return _p5_diff(spark, d).filter("change <> 'removed'").select(F.col("k").alias("id"))


@CORE.query(
    "p5_changes",
    _P5
    + """SELECT CASE WHEN s.rollout_id IS NULL THEN 'added' WHEN c.id IS NULL THEN 'removed' ELSE 'changed' END AS change, count(*) AS n
FROM cur c FULL JOIN seen s ON c.id = s.rollout_id
WHERE s.rollout_id IS NULL OR c.id IS NULL OR c.used IS DISTINCT FROM s.used OR c.create_at IS DISTINCT FROM s.create_at GROUP BY 1""",
)
def p5_changes(spark, d):
    return _p5_diff(spark, d).groupBy("change").agg(F.count("*").alias("n"))
