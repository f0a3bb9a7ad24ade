"""Queries on evaluation reports, logs, judgements and the rest of the array functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.functions import flops, scoring
from tracemill.functions import tokens as tk
from tracemill.operators import advantage as adv
from tracemill.operators import curation, metrics
from tracemill.operators import trajectory as tr
from tracemill.plans.adapters import CATALOG, TOKENS, catalog, token_batch
from tracemill.operators.batch import first_rows
from tracemill.plans.registry import CORE
from tracemill.plans.rollouts import _DOM, _domains
from tracemill.session import shared_dir, table
from tracemill.sources import readers
from tracemill.sources.store import TableStore

r6 = lambda c, name: (F.round(c, 6) + 0.0).alias(name)
_CATS = {"sheets": "office", "slides": "office", "writer": "office", "player": "daily", "browser": "daily", "image_editor": "professional", "code_editor": "professional", "none": "empty"}
_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _CATS.items())

CORE.query(
    "category_success",
    f"""WITH {CATALOG}, {_DOM}, j AS (SELECT CASE m.domain {_CASE} END AS category, reward FROM cat c JOIN m ON lower(c.task_id) = m.task_id WHERE reward >= 0)
SELECT k.category, coalesce(any_value(n), 0) AS n_runs, round(coalesce(any_value(s), 0) / greatest(coalesce(any_value(n), 0), 1) * 100, 6) + 0.0 AS success_percent FROM (SELECT unnest(['office', 'daily', 'professional', 'empty']) AS category) k LEFT JOIN (SELECT category, count(*) AS n, sum(reward) AS s FROM j GROUP BY 1) p ON k.category = p.category GROUP BY k.category""",
)(
    lambda s, d: metrics.category_rates(catalog(s, d).filter("reward >= 0").withColumn("task_id", F.lower("task_id")).join(_domains(s, d), "task_id"), _CATS).select("category", "n_runs", r6("success_percent", "success_percent"))
)
CORE.query("done_flag_success", "WITH e AS (SELECT event_type, user_id, bool_or(value > 95) AS ok FROM events GROUP BY 1, 2) SELECT event_type, count(*) AS n, count(*) FILTER (ok) AS n_done, round(avg(CASE WHEN ok THEN 1.0 ELSE 0 END), 6) AS rate FROM e GROUP BY 1")(
    lambda s, d: metrics.done_rates(table(s, d, "events", "event_type", "user_id", (F.col("value") > 95).alias("done")), "event_type", "user_id", "done").withColumn("rate", F.round("rate", 6))
)
CORE.query("best_logged_reward", "SELECT max(value) AS best_reward FROM events")(lambda s, d: metrics.best_reward(table(s, d, "events", F.concat(F.lit("step 3 reward: "), F.col("value").cast("string"), F.lit(" done")).alias("line")), "line"))
CORE.query("merged_worker_summaries", "WITH w AS (SELECT user_id % 4 AS worker, count(*) AS n, count(*) FILTER (value > 50) AS ok FROM events GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(ok) AS BIGINT) AS ok, round(sum(ok) * 1.0 / sum(n), 6) AS rate FROM w")(
    lambda s, d: table(s, d, "events", "user_id", "value").groupBy(F.col("user_id") % 4).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("ok")).transform(metrics.merged).withColumn("rate", F.round("rate", 6))
)
CORE.query("value_spread", "SELECT round(avg(value), 6) AS mean, max(value) AS max, min(value) AS min, round(stddev_pop(value), 6) AS std FROM events")(lambda s, d: metrics.spread(table(s, d, "events", "value"), "value").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)}))
CORE.query("rank_timings", "WITH r AS (SELECT event_type AS name, user_id % 8 AS rank, sum(value) AS s FROM events GROUP BY 1, 2) SELECT name, round(avg(s), 6) AS seconds FROM r GROUP BY 1")(
    lambda s, d: metrics.rank_timings(table(s, d, "events", F.col("event_type").alias("name"), (F.col("user_id") % 8).alias("rank"), F.col("value").alias("seconds"))).select("name", F.round("seconds", 6).alias("seconds"))
)
_J = "(SELECT user_id AS trajectory, event_id % 4 AS w, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS score FROM events)"
_judged = lambda s, d: table(s, d, "events", F.col("user_id").alias("trajectory"), (F.col("event_id") % 4).alias("w"), F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("score"))
CORE.query("judge_votes_per_window", f"SELECT trajectory, w, round(avg(score), 6) AS score FROM {_J} GROUP BY 1, 2")(lambda s, d: metrics.judge_votes(_judged(s, d), "trajectory", "w", "score")[0].withColumn("score", F.round("score", 6)))
CORE.query("judge_votes_per_trajectory", f"SELECT trajectory, round(avg(score), 6) AS score FROM {_J} GROUP BY 1")(lambda s, d: metrics.judge_votes(_judged(s, d), "trajectory", "w", "score")[1].withColumn("score", F.round("score", 6)))
_S = "WITH " + TOKENS + ", s AS (SELECT _row, sum(r) AS s, sum(m) AS len, sum(lp * m) AS lp FROM t GROUP BY _row)"
CORE.query(
    "preference_metrics",
    f"{_S} SELECT round(avg(s), 6) AS score_mean, round(max(s), 6) AS score_max, round(min(s), 6) AS score_min, round(avg(len), 6) AS length_mean, max(len) AS length_max, min(len) AS length_min, round(avg(CASE WHEN _row % 2 = 0 THEN lp END), 6) AS chosen_logps, round(avg(CASE WHEN _row % 2 = 1 THEN lp END), 6) AS rejected_logps FROM s",
)(lambda s, d: _rounded(metrics.preference_metrics(token_batch(s, d).select(adv.score().alias("s"), tk.total("mask").alias("n"), (F.col("_row") % 2 == 0).alias("c"), tk.masked_sum("logp", "mask").alias("lp")), "s", "n", "c", "lp")))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


CORE.query("absolute_preference_accuracy", f"{_S} SELECT round(avg(CASE WHEN sign(s - 0.2) = sign(CASE WHEN len > 3 THEN 1 ELSE -1 END) THEN 1.0 ELSE 0 END), 6) AS acc FROM s")(
    lambda s, d: token_batch(s, d).select(adv.score().alias("s"), (tk.total("mask") > 3).cast("double").alias("a")).agg(F.round(metrics.absolute_accuracy(F.col("s") - 0.2, F.col("a")), 6).alias("acc"))
)
CORE.query("length_imbalance", "WITH l AS (SELECT user_id % 8 AS part, sum(user_id) AS s FROM events GROUP BY 1) SELECT CAST(min(s) AS BIGINT) AS min, CAST(max(s) AS BIGINT) AS max, CAST(max(s) - min(s) AS BIGINT) AS minmax_diff, avg(s) AS mean FROM l")(
    lambda s, d: metrics.imbalance(table(s, d, "events", "user_id").withColumn("part", F.col("user_id") % 8), "part", "user_id")
)
CORE.query("val_section_labels", "SELECT DISTINCT CASE WHEN user_id % 2 = 0 AND event_type IN ('click', 'error') THEN 'val-core' ELSE 'val-aux' END AS section, user_id % 2 AS v, event_type IN ('click', 'error') AS at_max FROM events")(
    lambda s, d: table(s, d, "events", "user_id", "event_type").withColumns({"v": F.col("user_id") % 2, "at_max": F.col("event_type").isin("click", "error")}).select(
        metrics.validation_section(F.when(F.col("v") == 0, "acc").otherwise("len"), F.when(F.col("at_max"), "mean@8").otherwise("std@8"), 8).alias("section"), "v", "at_max"
    ).distinct()
)
CORE.query("training_tflops", "SELECT round((6.0 * ((3.0 * 896 * 4864 + 896 * 64 * (2 * 14 + 2 * 2)) * 24 + 2.0 * 151936 * 896) * sum(l_quantity) + 12.0 * 64 * 14 * 24 * sum(l_quantity * l_quantity)) / 10 / 1e12, 6) AS tflops FROM lineitem")(
    lambda s, d: flops.achieved(table(s, d, "lineitem", "l_quantity"), "l_quantity", F.lit(10.0), hidden=896, intermediate=4864, layers=24, heads=14, kv_heads=2, vocabulary=151936).select(F.round("tflops", 6).alias("tflops"))
)

# arrays ---------------------------------------------------------------------------------------

_A = "WITH a AS (SELECT o_orderkey AS k, range(o_orderkey % 9) AS a FROM orders) "


def _arrays(s, d):
    n = (F.col("o_orderkey") % 9).cast("int")
    return table(s, d, "orders", F.col("o_orderkey").alias("k"), F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)")).alias("a"))


CORE.query("positions_after_marks", _A + "SELECT k, array_to_string(list_filter(list_transform(list_filter(a, lambda x: x % 3 = 0), lambda x: x + 1), lambda x: x < len(a)), ',') AS p FROM a")(lambda s, d: _arrays(s, d).select("k", F.array_join(tk.positions_after(F.filter("a", lambda x: x % 3 == 0), F.size("a")), ",").alias("p")))
CORE.query("every_second_place", _A + "SELECT k, array_to_string(list_filter(a, lambda x: x >= 1 AND (x - 1) % 2 = 0), ',') AS p FROM a")(lambda s, d: _arrays(s, d).select("k", F.array_join(tk.every_second("a", 1), ",").alias("p")))
CORE.query("rounded_up", "SELECT o_orderkey AS k, CAST(ceil(o_orderkey / 7.0) AS BIGINT) AS c, CAST(ceil(o_orderkey / 7.0) * 7 AS BIGINT) AS r FROM orders")(lambda s, d: table(s, d, "orders", F.col("o_orderkey").alias("k")).select("k", tk.ceil_div(F.col("k"), 7).alias("c"), tk.round_up(F.col("k"), 7).alias("r")))
CORE.query("finalised_responses", _A + ", f AS (SELECT k, CASE WHEN len(a) >= 2 AND a[len(a) - 1] = 6 AND a[len(a)] = 7 THEN a[1:len(a) - 2] ELSE a END AS a FROM a) SELECT k, array_to_string(a[3:least(len(a), 6)], ',') AS response FROM f")(
    lambda s, d: _arrays(s, d).select("k", tk.finalise(F.col("a"), F.lit(2), [6, 7], 6, 4, F.col("a"))["response"].alias("x")).select("k", F.array_join("x", ",").alias("response"))
)
CORE.query("preference_pair_stack", _A + "SELECT k, array_to_string(list_transform(range(4), lambda i: CASE WHEN i < len(a) THEN i ELSE 0 END), ',') || '|9,0,0,0' AS pair FROM a")(
    lambda s, d: _arrays(s, d).select("k", tk.pair_stack(F.col("a"), F.array(F.lit(9)), 4).alias("p")).select("k", F.concat_ws("|", F.array_join(F.get("p", F.lit(0)), ","), F.array_join(F.get("p", F.lit(1)), ",")).alias("pair"))
)
CORE.query("newest_items", _A + "SELECT k, array_to_string(a[greatest(len(a) - 2, 1):], ',') AS kept FROM a")(lambda s, d: _arrays(s, d).select("k", F.array_join(tr.newest(F.col("a"), 3), ",").alias("kept")))
CORE.query("merged_tool_turns", "WITH e AS (SELECT user_id, event_id, CASE WHEN event_type IN ('click', 'view') THEN 'tool' ELSE 'assistant' END AS role FROM events), n AS (SELECT *, CASE WHEN role = 'tool' AND lag(role) OVER (PARTITION BY user_id ORDER BY event_id) = 'tool' THEN 0 ELSE 1 END AS n FROM e) SELECT event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS turn FROM n")(
    lambda s, d: tr.merge_tool_turns(table(s, d, "events", "user_id", "event_id", F.when(F.col("event_type").isin("click", "view"), "tool").otherwise("assistant").alias("role")), "user_id", "event_id").select("event_id", "turn")
)

# the rest of the catalog ------------------------------------------------------------------------

_C = "WITH " + CATALOG
CORE.query("group_order_rotated", f"{_C}, g AS (SELECT task_id, min(create_at) AS group_at FROM cat GROUP BY 1), r AS (SELECT task_id, row_number() OVER (ORDER BY group_at ASC NULLS LAST, task_id) - 1 AS r, count(*) OVER () AS n FROM g), l AS (SELECT r FROM r WHERE task_id = (SELECT min(task_id) FROM g)) SELECT r.task_id, CAST((r.r - l.r - 1 + n) % n AS BIGINT) AS place FROM r, l")(
    lambda s, d: _rotated(catalog(s, d))
)


def _rotated(c):
    g = c.groupBy("task_id").agg(F.min("create_at").alias("group_at"))
    return curation.rotate(g, g.agg(F.min("task_id")).first()[0])


CORE.query("batch_row_limit", f"{_C} SELECT id FROM cat ORDER BY id LIMIT 256")(lambda s, d: curation.cut_batch(catalog(s, d).select("id"), 32, 8, "id"))
CORE.query("seeded_sample", f"{_C} SELECT id FROM cat ORDER BY md5('42|' || id), id LIMIT 500")(
    lambda s, d: first_rows(catalog(s, d).select("id").withColumn("h", F.md5(F.concat_ws("|", F.lit("42"), F.col("id").cast("string")))), 500, "h", "id").select("id")
)
CORE.query("metrics_listed", "SELECT event_type AS name, md5(string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id)) AS digest FROM events GROUP BY 1")(
    lambda s, d: metrics.listed(table(s, d, "events", F.col("event_type").alias("name"), "user_id", "event_id"), "name", "user_id", "event_id").select("name", F.md5(F.array_join("values", ",")).alias("digest"))
)
CORE.query("conditional_group_counts", f"{_C} SELECT run_id, count(*) FILTER (reward >= 0) AS n_scored, count(DISTINCT task_id) AS n_tasks, CAST(sum(CASE WHEN used > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_used FROM cat GROUP BY run_id")(
    lambda s, d: catalog(s, d).groupBy("run_id").agg(F.count_if(F.col("reward") >= 0).alias("n_scored"), F.countDistinct("task_id").alias("n_tasks"), F.sum(F.when(F.col("used") > 0, 1).otherwise(0)).alias("n_used"))
)
CORE.query("latest_positive_per_task", f"{_C} SELECT task_id, id FROM (SELECT task_id, id, row_number() OVER (PARTITION BY task_id ORDER BY create_at DESC NULLS LAST, id DESC) AS k FROM cat WHERE reward = 1) WHERE k = 1")(
    lambda s, d: curation.newest_positive(catalog(s, d), F.col("reward") == 1).select("task_id", "id")
)


@CORE.query("store_transaction", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 5 > 0")
def store_transaction(s, d):
    """Insert, update, delete and read through the table store."""
    import uuid

    store = TableStore(s, f"{shared_dir(s)}/store-{uuid.uuid4().hex}")
    store.insert("o", table(s, d, "orders", "o_orderkey", "o_orderstatus"))
    store.update("o", F.col("o_orderkey") % 3 == 0, {"o_orderstatus": F.lit("X")})
    store.delete("o", F.col("o_orderkey") % 5 == 0)
    return store.query("SELECT * FROM {o} WHERE o_orderkey >= :low", low=0)


CORE.query("images_per_folder", "WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT DISTINCT user_id, CAST(event_id AS INTEGER) AS no FROM e WHERE n <= 4 OR i IN (0, CAST(round_even((n - 1) / 3.0, 0) AS BIGINT), CAST(round_even(2 * (n - 1) / 3.0, 0) AS BIGINT), n - 1)")(
    lambda s, d: readers.image_places(table(s, d, "events", "user_id", F.concat(F.lit("/x/image_"), F.col("event_id").cast("string"), F.lit(".png")).alias("path")), "user_id", "path", 4).select("user_id", "no")
)
CORE.query("steps_in_numeric_order", "SELECT event_id, CAST(event_id % 1000 AS INTEGER) AS step FROM events")(lambda s, d: readers.step_arrays(table(s, d, "events", "event_id", F.concat(F.lit("logp_"), (F.col("event_id") % 1000).cast("string"), F.lit(".parquet")).alias("file"))).select("event_id", "step"))
CORE.query("boxed_reports_any_gold", "SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS acc FROM orders")(lambda s, d: _any_gold(table(s, d, "orders", F.col("o_orderkey").alias("k"))))


def _any_gold(o):
    from tracemill.functions import mathscore as m

    hit = lambda gold: m.math_score_udf(F.concat(F.lit("\\boxed{"), F.col("k").cast("string"), F.lit("}")), gold)
    second = F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise("none")
    return o.select("k", (F.greatest(hit(F.lit("x")), hit(second)) > 0).alias("acc"))


CORE.query("char_count_reward", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM orders")(
    lambda s, d: table(s, d, "orders", F.col("o_orderkey").alias("k")).select("k", scoring.char_count_score(F.lit(""), F.when(F.col("k") % 3 == 0, "4").when(F.col("k") % 3 == 1, "5"), F.lit("4")).alias("score"))
)
