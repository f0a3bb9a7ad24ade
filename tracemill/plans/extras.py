"""Queries on feeding, dispatch, rewards, action scripts, graders, sinks and registries."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from tracemill.functions import actions, mathscore
from tracemill.operators import advantage, batch, catalog, curation, dispatch, loss, reward
from tracemill.plans.adapters import CATALOG, TOKENS, long, token_batch
from tracemill.plans.adapters import catalog as cat
from tracemill.plans.registry import CORE
from tracemill.session import shared_dir, table
from tracemill.sources import readers, recipes, writers

_O = "WITH o AS (SELECT o_orderkey AS k FROM orders) "


def _orders(s, d):
    return table(s, d, "orders", F.col("o_orderkey").alias("k"))


# actions ------------------------------------------------------------------------------

_HEAD = "concat_ws(chr(10), 'import pyautogui', 'import time', repeat(chr(39), 3), 'Observation:', '', '', 'Thought:', 'go', repeat(chr(39), 3), '')"


@CORE.query(
    "action_script",
    _O
    + f"""SELECT k, CASE k % 4 WHEN 0 THEN {_HEAD} || chr(10) || 'pyautogui.hotkey(''left'')' || chr(10) || 'time.sleep(1)' || chr(10) || chr(10) || 'pyautogui.press('' '')'
 WHEN 1 THEN {_HEAD} || chr(10) || 'pyautogui.scroll(-5)' WHEN 2 THEN 'DONE' ELSE 'WAIT' END AS code FROM o""",
)
def action_script(s, d):
    """Scripts of replies with one or two actions."""
    two, one = "Thought: go\nAction: hotkey(key='arrowleft')\n\npress(key='space')", "Thought: go\nAction: scroll(direction='down')"
    k = F.col("k") % 4
    reply = F.when(k == 0, two).when(k == 1, one).when(k == 2, "Thought: go\nAction: finished()").otherwise("Thought: go\nAction: wait()")
    return _orders(s, d).select("k", actions.script_udf(reply).alias("code"))


@CORE.query("action_script_boxes", _O + "SELECT k, round((k % 1000) / 1000.0 * 1920, 3) AS x, round((k % 700) / 1000.0 * 1080, 3) AS y FROM o")
def action_script_boxes(s, d):
    """Places of clicks on the screen, read back from their scripts."""
    reply = F.concat(F.lit("Thought: go\nAction: click(start_box='("), F.col("k") % 1000, F.lit(","), F.col("k") % 700, F.lit(")')"))
    code = actions.script_udf(reply)
    place = lambda i: F.regexp_extract("code", r"click\(([-\d.]+), ([-\d.]+), button='left'\)", i).cast("double")
    return _orders(s, d).withColumn("code", code).select("k", place(1).alias("x"), place(2).alias("y"))


# graders ------------------------------------------------------------------------------

# given answer, right answer, whether graders take it (fixed cases)
GRADED = [
    (r"\frac{1}{2}", "1/2", 1), ("0.5", r"\frac{1}{2}", 1), (r"(1, 2)", "(1,2)", 1), (r"[1, 2)", "(1,2)", 0), ("3x+x", "4x", 1), ("(x+1)^2", "x^2+2x+1", 1), ("x^2", "x^3", 0),
    ("1,000", "1000", 1), ("12%", "12", 1), ("7", "8", 0), (r"\text{east}", "east", 1),
]
_VALUES = ", ".join(f"({i}, {ok})" for i, (_, _, ok) in enumerate(GRADED))


@CORE.query("prime_scores", _O + f"SELECT k, CAST(v.ok AS DOUBLE) AS score FROM o JOIN (VALUES {_VALUES}) v(i, ok) ON v.i = k % {len(GRADED)}")
def prime_scores(s, d):
    """Boxed answers of several forms, graded against the right ones."""
    case = s.createDataFrame([(i, f"so \\boxed{{{a}}}", b) for i, (a, b, _) in enumerate(GRADED)], "i int, text string, truth string")
    rows = _orders(s, d).withColumn("i", (F.col("k") % len(GRADED)).cast("int")).join(F.broadcast(case), "i")
    score = F.pandas_udf(_prime, "double")
    return rows.select("k", score("text", "truth").alias("score"))


def _prime(text, truth):
    import pandas as pd

    return pd.Series([mathscore.prime_score(t, g) for t, g in zip(text, truth)])


@CORE.query("matrix_equality", _O + "SELECT k, k % 3 > 0 AS same FROM o")
def matrix_equality(s, d):
    """Matrices that are equal entry by entry, one of them in another writing, and ones that differ in an entry."""
    return _orders(s, d).select("k", F.pandas_udf(_same_matrices, "boolean")("k").alias("same"))


def _same_matrices(keys):
    import pandas as pd

    left = lambda n: rf"\begin{{pmatrix}}{n} & 2x\\0.5 & {n + 1}\end{{pmatrix}}"
    right = lambda n: rf"\begin{{pmatrix}}{n}.0 & x+x\\1/2 & {n + 1 if n % 3 else n + 5}\end{{pmatrix}}"
    return pd.Series([mathscore.math_equal(left(int(n)), right(int(n)), percent=False, tolerance=1e-9) for n in keys])


@CORE.query("verify_scores", _O + "SELECT k, CASE k % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.25::DOUBLE END AS score FROM o")
def verify_scores(s, d):
    """Right and wrong answers, and ones whose comparison is too large and scores 0.25."""
    boxed = lambda x: F.concat(F.lit("so \\boxed{"), x, F.lit("}"))
    k = F.col("k").cast("string")
    text = F.when(F.col("k") % 3 == 0, boxed(F.concat(k, F.lit("x+x")))).when(F.col("k") % 3 == 1, boxed(F.concat(k, F.lit("y")))).otherwise(boxed(F.lit("(a+b)^9999")))
    truth = F.concat((F.col("k") + 1).cast("string"), F.lit("x"))
    return _orders(s, d).select("k", F.pandas_udf(_verify, "double")(text, truth).alias("score"))


def _verify(text, truth):
    import pandas as pd

    return pd.Series([mathscore.verify_score(t, g, 0.25) for t, g in zip(text, truth)])


@CORE.query("strict_box_scores", _O + "SELECT k, CASE WHEN k % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS score, CASE WHEN k % 4 < 3 THEN CAST(k + k % 2 AS VARCHAR) END AS pred FROM o")
def strict_box_scores(s, d):
    """The last box in the last 100 characters: right, wrong, and too far back."""
    box = F.concat(F.lit("\\boxed{"), (F.col("k") + F.col("k") % 2).cast("string"), F.lit("}"))
    text = F.when(F.col("k") % 4 < 3, F.concat(F.repeat(F.lit("z"), F.lit(200)), box)).otherwise(F.concat(box, F.repeat(F.lit("z"), F.lit(200))))
    return _orders(s, d).select("k", F.pandas_udf(_strict, "score double, pred string")(text, F.col("k").cast("string")).alias("r")).select("k", "r.*")


def _strict(text, truth):
    import pandas as pd

    found = [mathscore.dapo_score(t, g, strict=True) for t, g in zip(text, truth)]
    return pd.DataFrame({"score": [f["score"] for f in found], "pred": [f["pred"] for f in found]})


# rewards ------------------------------------------------------------------------------


@CORE.query("rewards_judged", _O + "SELECT k, CASE WHEN k % 3 = 0 THEN 0.25 WHEN k % 3 = 1 THEN (k % 2 + 1) / 2.0 END AS score FROM o")
def rewards_judged(s, d):
    """Cached rewards, else the share of two judges, else null."""
    o = _orders(s, d)
    rows = o.select("k", F.when(F.col("k") % 3 == 0, "0.25").when(F.col("k") % 3 == 2, "lost").alias("cached"))
    said = F.when(F.col("k") % 3 == 2, "no idea").otherwise(F.concat(F.lit("Score: "), F.when(F.col("j") == 0, F.col("k") % 2).otherwise(1)))
    replies = o.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1)))).select("k", said.alias("reply"))
    return reward.judged(rows, replies, "k").select("k", "score")


@CORE.query("reward_manager_overlong", f"WITH {TOKENS}, s AS (SELECT _row, sum(m) AS n FROM t GROUP BY _row) SELECT _row, round(1.0 + least(-(n - 2) / 2 * 0.5, 0), 6) + 0.0 AS total FROM s")
def reward_manager_overlong(s, d):
    """A score of 1 less the penalty for more than two of four tokens, by the manager of that name."""
    out = reward.apply(token_batch(s, d), "overlong", score=F.lit(1.0), most=4, buffer=2, factor=0.5)
    return out.select("_row", (F.round(F.aggregate("rewards", F.lit(0.0), lambda a, x: a + x), 6) + 0.0).alias("total"))


_MEAN = "s AS (SELECT _row, uid, sum(r) AS s FROM t GROUP BY _row, uid), o AS (SELECT _row, (s - CASE WHEN count(*) OVER (PARTITION BY uid) = 1 THEN 0 ELSE avg(s) OVER (PARTITION BY uid) END) / (CASE WHEN count(*) OVER (PARTITION BY uid) = 1 THEN 1 ELSE stddev_samp(s) OVER (PARTITION BY uid) END + 1e-6) AS val FROM s)"


@CORE.query("adv_grpo_multi_turn", f"WITH {TOKENS}, {_MEAN} SELECT t._row, t.pos, CASE WHEN t.pos % 2 = 0 THEN round(o.val, 6) + 0.0 ELSE 0.0 END AS advantages FROM t JOIN o ON t._row = o._row")
def adv_grpo_multi_turn(s, d):
    """Group-relative advantages on the last places of a loss mask that also covers the prompt."""
    prompt = F.array(F.lit(1), F.lit(0))
    df = token_batch(s, d).withColumn("loss_mask", F.concat(prompt, F.transform("mask", lambda m, i: ((i + 1) % 2).cast("int"))))
    return long(advantage.dispatch(df, "grpo", multi_turn=True), "advantages")


@CORE.query("losses_by_name", "SELECT unnest(['clip_cov', 'gspo', 'kl_cov', 'ppo']) AS name")
def losses_by_name(s, d):
    names = sorted(set(loss.LOSSES) & {"clip_cov", "gspo", "kl_cov", "ppo", "vanilla"})
    return s.createDataFrame([(("ppo" if n == "vanilla" else n),) for n in names], "name string").distinct()


@CORE.query("kl_controllers", "SELECT round(0.2 * power(1 + 0.2 * 64 / 1000.0, 5), 9) AS adaptive, CAST(0.2 AS DOUBLE) AS fixed")
def kl_controllers(s, d):
    """Coefficients after five updates with a KL of twice the target."""
    a, f = advantage.AdaptiveKL(0.2, 6.0, 1000), advantage.FixedKL(0.2)
    for _ in range(5):
        a.update(12.0, 64)
        f.update(12.0, 64)
    return s.createDataFrame([(round(a.value, 9), f.value)], "adaptive double, fixed double")


# feeding and dispatch ---------------------------------------------------------------------

_VN = "CAST(CASE WHEN regexp_full_match(model_version, 'v[0-9]+') THEN substring(model_version, 2) END AS BIGINT)"


@CORE.query(
    "served_rows",
    f"""WITH {CATALOG}, q AS (SELECT task_id, row_number() OVER (ORDER BY coalesce(max({_VN}), -1) DESC, min(coalesce(used, 0)), task_id) - 1 AS slot FROM cat GROUP BY task_id),
r AS (SELECT id, task_id, row_number() OVER (PARTITION BY task_id ORDER BY coalesce({_VN}, -1) DESC, coalesce(used, 0), coalesce(reward, 0) DESC, id) AS rank FROM cat)
SELECT r.id, CAST(q.slot AS BIGINT) AS slot FROM r JOIN q ON r.task_id = q.task_id WHERE q.slot < 16 AND r.rank <= 4""",
)
def served_rows(s, d):
    """The rows that 16 reads of one batch serve."""
    served, _ = catalog.serve(cat(s, d).filter("task_id is not null"), batches=1, batch=16, per_task=4)
    return served[0].select("id", "slot")


@CORE.query("served_usage", f"WITH {CATALOG} SELECT CAST(sum(coalesce(used, 0)) + (SELECT 3 * sum(least(n, 2)) FROM (SELECT count(*) AS n FROM cat WHERE task_id = (SELECT min(task_id) FROM cat) GROUP BY task_id)) AS BIGINT) AS used FROM cat WHERE task_id = (SELECT min(task_id) FROM cat)")
def served_usage(s, d):
    """Use of one task's rows after three batches of one read of two rows."""
    c = cat(s, d)
    first = c.agg(F.min("task_id").alias("task_id"))
    _, after = catalog.serve(c.join(F.broadcast(first), "task_id", "left_semi"), batches=3, batch=1, per_task=2)
    return after.agg(F.sum(F.coalesce("used", F.lit(0))).cast("long").alias("used"))


@CORE.query(
    "dispatch_padded",
    "WITH o AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS _row, o_orderkey FROM orders), n AS (SELECT count(*) AS n, (7 - count(*) % 7) % 7 AS short FROM o), a AS (SELECT _row, o_orderkey, false AS pad FROM o UNION ALL SELECT _row + n, o_orderkey, true FROM o, n WHERE _row < short) SELECT _row, o_orderkey, pad, CAST(floor(_row / ((n + short) / 7)) AS INTEGER) AS rank FROM a, n",
)
def dispatch_padded(s, d):
    b = batch.number_rows(table(s, d, "orders", "o_orderkey"), "o_orderkey")
    return dispatch.split(b, 7, pad=True).select("_row", "o_orderkey", F.col("_pad").alias("pad"), "rank")


@CORE.query("dispatch_collected", "SELECT o_orderkey, o_orderkey * 2 AS twice FROM orders")
def dispatch_collected(s, d):
    """Every rank doubles its rows; pads are gone again."""
    b = batch.number_rows(table(s, d, "orders", "o_orderkey"), "o_orderkey")
    return dispatch.run(b, 7, lambda pdf: pdf.assign(twice=pdf["o_orderkey"] * 2), "_row long, o_orderkey long, _pad boolean, twice long").select("o_orderkey", "twice")


@CORE.query("dispatch_to_all", "SELECT r_regionkey, CAST(i AS INTEGER) AS rank FROM region, range(3) t(i)")
def dispatch_to_all(s, d):
    return dispatch.to_all(table(s, d, "region", "r_regionkey"), 3)


@CORE.query("batch_gate", "SELECT o_orderkey AS k, o_orderkey % 40 >= 16 OR (o_orderkey % 40 > 0 AND o_orderkey % 7 >= 5) AS go FROM orders")
def batch_gate(s, d):
    """Whether a batch of k % 40 rows may go that has waited k % 7 seconds."""
    import pandas as pd

    go = F.pandas_udf(lambda n, w: pd.Series([curation.ready(int(a), 2, 8, float(b), 5.0) for a, b in zip(n, w)]), "boolean")
    return _orders(s, d).select("k", go(F.col("k") % 40, F.col("k") % 7).alias("go"))


@CORE.query("accumulated_rounds", f"WITH {CATALOG}, r AS (SELECT id, task_id, id % 4 AS round, reward FROM cat WHERE reward IS NOT NULL), g AS (SELECT round, task_id FROM r GROUP BY ALL HAVING stddev_pop(reward) > 0 OR count(*) = 1), c AS (SELECT round, count(*) AS n FROM g GROUP BY round), u AS (SELECT min(round) AS last FROM (SELECT round, sum(n) OVER (ORDER BY round) AS upto FROM c) WHERE upto >= 20), k AS (SELECT r.id, r.round FROM r JOIN g ON r.round = g.round AND r.task_id IS NOT DISTINCT FROM g.task_id, u WHERE r.round <= u.last) SELECT id FROM k ORDER BY round, id LIMIT 40")
def accumulated_rounds(s, d):
    """Four rounds of the catalog, added up to 20 prompts of two rows."""
    c = cat(s, d).filter("reward is not null")
    return curation.accumulate((c.filter(F.col("id") % 4 == r) for r in range(4)), "reward", 20, 2, group="task_id", order="id").select("id")


# domains, loaders, sinks --------------------------------------------------------------------


@CORE.query("domains_of_configs", _O + "SELECT CASE k % 5 WHEN 0 THEN 'd' || k % 3 WHEN 1 THEN 't' WHEN 2 THEN 'c' WHEN 3 THEN 'a' ELSE 'unknown' END AS domain, count(*) AS n FROM o WHERE k % 2 = 0 GROUP BY 1")
def domains_of_configs(s, d):
    """Tasks with a reward by domain, which stands in another field of each fifth config."""
    k = F.col("k").cast("string")
    five = F.col("k") % 5
    raw = lambda name, v: F.concat(F.lit('{"id": "'), k, F.lit(f'", "raw": {{"{name}": "{v}"}}}}'))
    config = (
        F.when(five == 0, F.concat(F.lit('{"id": "'), k, F.lit('", "domain": "d'), (F.col("k") % 3).cast("string"), F.lit('", "app": "x"}')))
        .when(five == 1, F.concat(F.lit('{"id": "'), k, F.lit('", "task_type": "t"}')))
        .when(five == 2, raw("category", "c")).when(five == 3, raw("app", "a")).otherwise(F.concat(F.lit('{"id": "'), k, F.lit('"}')))
    )
    rows = _orders(s, d).select(config.alias("config"), F.when(F.col("k") % 2 == 0, 1.0).otherwise(0.0).alias("reward"))
    return recipes.tasks_by_domain(rows, "config", "reward").groupBy("domain").agg(F.count("*").alias("n"))


def _orders_of(spark, folder):
    return spark.read.parquet(f"{folder}/orders.parquet")


@CORE.query("loaded_by_name", "SELECT o_orderkey, o_orderstatus FROM orders")
def loaded_by_name(s, d):
    readers.loader("orders")(_orders_of)
    return readers.load(s, "orders", "o_orderkey", "o_orderstatus", folder=d).select("o_orderkey", "o_orderstatus")


@CORE.query("searched_passages", _O + "SELECT k, 'about ' || k AS title, 1 AS n FROM o WHERE k % 2 = 0 UNION ALL SELECT k, NULL, 0 FROM o WHERE k % 2 = 1")
def searched_passages(s, d):
    """Hits of a search service, here a function, for every second row."""
    q = _orders(s, d).withColumn("q", F.when(F.col("k") % 2 == 0, F.col("k").cast("string")))
    found = readers.searched(q, "q", lambda qs, top: [[{"title": f"about {x}", "text": x, "score": 1.0}] for x in qs], 3)
    return found.select("k", F.get("hits", F.lit(0))["title"].alias("title"), F.size("hits").alias("n"))


@CORE.query("episode_frames", "SELECT o_orderstatus AS run_id, CAST(o_orderkey AS VARCHAR) AS trajectory_id, CAST(i AS INTEGER) AS step FROM orders, range(2) t(i) WHERE i <= o_orderkey % 2")
def episode_frames(s, d):
    """Frames of episodes as written to and read from their table."""
    folder = f"{shared_dir(s)}/episodes-{uuid.uuid4().hex}"
    o = table(s, d, "orders", F.col("o_orderstatus").alias("run_id"), F.col("o_orderkey").cast("string").alias("trajectory_id"), (F.col("o_orderkey") % 2).cast("int").alias("more"))
    frame = F.encode(F.lit("x"), "UTF-8")
    writers.episodes(o.select("run_id", "trajectory_id", F.lit("{}").alias("config"), F.lit("[]").alias("messages"), F.lit(1.0).alias("reward"), F.array_repeat(frame, F.col("more") + 1).alias("frames")), folder)
    return s.read.parquet(f"{folder}/frames").select("run_id", F.col("trajectory_id").cast("string").alias("trajectory_id"), "step")


@CORE.query("trajectory_tree_read", "SELECT 'r' || n_nationkey % 2 AS run, 't' || n_nationkey % 3 AS task, 'x' || n_nationkey AS trajectory, CASE WHEN n_nationkey % 2 = 0 THEN CAST(0.5 AS DOUBLE) END AS reward, CAST(n_nationkey % 2 AS BIGINT) AS n_images FROM nation")
def trajectory_tree_read(s, d):
    """Folders run/task/trajectory of the nations, half of them with a reward, the others with an image."""
    root = f"{shared_dir(s)}/tree-{uuid.uuid4().hex}"
    jvm = s.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    for (k,) in table(s, d, "nation", "n_nationkey").collect():  # 25 rows at any scale
        name = "reward.txt" if k % 2 == 0 else "image_1.png"
        out = fs.create(path(f"{root}/r{k % 2}/t{k % 3}/x{k}/{name}"))
        out.write(bytearray(b"0.5\n"))
        out.close()
    return readers.trajectory_tree(s, root)


@CORE.query("batch_from_columns", "SELECT CAST(i AS BIGINT) AS _row, CAST(i * 2 AS BIGINT) AS a FROM range(5) t(i)")
def batch_from_columns(s, d):
    return batch.from_columns(s, {"a": [0, 2, 4, 6, 8]}, 5)


@CORE.query("meta_union", "SELECT '{\"a\": 1, \"b\": 2}' AS meta")
def meta_union(s, d):
    return s.createDataFrame([(json.dumps(batch.union_meta({"a": 1}, {"a": 1, "b": 2})),)], "meta string")


@CORE.query("recipe_preference_split", "SELECT CASE WHEN _row < floor(n * 0.75) THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS _row, count(*) OVER () AS n FROM orders) GROUP BY 1")
def recipe_preference_split(s, d):
    b = batch.number_rows(table(s, d, "orders", "o_orderkey"), "o_orderkey")
    train, test = recipes.helpful_pairs(b)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).groupBy("part").agg(F.count("*").alias("n"))


@CORE.query("recipe_preference_rl", "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, 'p' || o_orderkey AS content, 'r' || o_orderkey AS truth FROM orders")
def recipe_preference_rl(s, d):
    k = F.col("o_orderkey").cast("string")
    b = batch.number_rows(table(s, d, "orders", "o_orderkey"), "o_orderkey").withColumns({"prompt": F.concat(F.lit("p"), k), "response": F.concat(F.lit("r"), k)})
    return recipes.helpful_rl(b, "train").select(F.col("extra_info.index").alias("index"), F.col("prompt")[0]["content"].alias("content"), F.col("reward_model.ground_truth").alias("truth"))


@CORE.query("recipe_evaluation_set", _O + "SELECT k AS index, 'q' || k AS content, CAST(k % 4 AS VARCHAR) AS truth, 'Science' AS ability FROM o")
def recipe_evaluation_set(s, d):
    k = F.col("index")
    rows = table(s, d, "orders", F.col("o_orderkey").alias("index"))
    out = recipes.evaluation_set(rows, "benchmark", F.concat(F.lit("q"), k.cast("string")), k % 4, "Science")
    return out.select(F.col("extra_info.index").alias("index"), F.col("prompt")[0]["content"].alias("content"), F.col("reward_model.ground_truth").alias("truth"), "ability")
