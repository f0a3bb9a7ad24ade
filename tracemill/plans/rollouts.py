"""Queries on the rollout catalog, its curation and the checkpoint registry."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.operators import batch, catalog, curation, metrics
from tracemill.plans.adapters import CATALOG, current
from tracemill.plans.adapters import catalog as cat
from tracemill.plans.registry import CORE
from tracemill.session import table
from tracemill.sources import readers
from tracemill.streaming import monitor

_C = "WITH " + CATALOG
_NEW, _OLD = "create_at DESC NULLS LAST, id DESC", "create_at ASC NULLS FIRST, id ASC"
r6 = lambda c, name: (F.round(c, 6) + 0.0).alias(name)

# catalog ----------------------------------------------------------------------------------

_BIG_RUN = "(SELECT run_id FROM cat GROUP BY run_id ORDER BY count(*) DESC, run_id LIMIT 1)"


def _big_run(c):
    return c.groupBy("run_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "run_id").limit(1).select("run_id")


CORE.query("catalog_scan_by_run", f"{_C} SELECT id, trajectory_id, task_id, reward FROM cat WHERE run_id = {_BIG_RUN}")(
    lambda s, d: current(readers.catalog_run(s, f"{d}/rollout_run.parquet", _big_run(cat(s, d)).first().run_id)).select("id", "trajectory_id", "task_id", "reward")
)
_V = f"""{_C}, v AS (SELECT run_id, model_version, max(create_at) AS last_at FROM cat WHERE model_version IS NOT NULL GROUP BY run_id, model_version),
vr AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY last_at DESC NULLS LAST, model_version DESC) AS rank FROM v)"""
CORE.query("latest_two_versions", f"{_V} SELECT run_id, model_version, last_at, CAST(rank AS INTEGER) AS rank FROM vr WHERE rank <= 2")(lambda s, d: catalog.newest_versions(cat(s, d), 2).select("run_id", "model_version", "last_at", "rank"))
for _n in (1, 2):
    CORE.query(
        f"nth_newest_model_success_{_n}",
        f"""{_V} SELECT c.run_id, c.model_version, round(sum(CASE WHEN reward >= 0 THEN reward ELSE 0 END), 6) AS success, count(*) AS n_rows, count(DISTINCT task_id) AS n_tasks, round(sum(CASE WHEN reward >= 0 THEN reward ELSE 0 END) / count(*), 6) AS avg_success
FROM cat c JOIN vr ON c.run_id = vr.run_id AND c.model_version = vr.model_version WHERE rank = {_n} GROUP BY c.run_id, c.model_version""",
    )(lambda s, d, n=_n: catalog.nth_newest_success(cat(s, d), n).withColumns({"success": F.round("success", 6), "avg_success": F.round("avg_success", 6)}))

_UPDATES = f"""{_C}, ch AS (SELECT run_id, trajectory_id || CASE WHEN id % 14 = 0 THEN '-new' ELSE '' END AS trajectory_id, task_id, 0.25 AS reward, 'v99' AS model_version FROM cat WHERE id % 7 = 0)"""


def _changes(c):
    t = F.when(F.col("id") % 14 == 0, F.concat("trajectory_id", F.lit("-new"))).otherwise(F.col("trajectory_id"))
    return c.filter("id % 7 = 0").select("run_id", t.alias("trajectory_id"), "task_id", F.lit(0.25).alias("reward"), F.lit("v99").alias("model_version"))


_K = ["run_id", "trajectory_id"]
CORE.query(
    "upsert_rollouts",
    f"""{_UPDATES} SELECT coalesce(c.run_id, n.run_id) AS run_id, coalesce(c.trajectory_id, n.trajectory_id) AS trajectory_id, c.id, c.create_at, coalesce(n.reward, c.reward) AS reward, coalesce(n.model_version, c.model_version) AS model_version
FROM cat c FULL JOIN ch n ON c.run_id = n.run_id AND c.trajectory_id = n.trajectory_id""",
)(lambda s, d: (lambda c: catalog.upsert(c, _changes(c)).select(*_K, "id", "create_at", "reward", "model_version"))(cat(s, d)))
CORE.query(
    "upsert_events",
    f"""{_UPDATES} SELECT n.run_id, n.trajectory_id, n.model_version, 0 AS used_delta, CASE WHEN c.id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS event_type FROM ch n LEFT JOIN cat c ON c.run_id = n.run_id AND c.trajectory_id = n.trajectory_id""",
)(lambda s, d: (lambda c: catalog.upsert_with_events(c, _changes(c))[1])(cat(s, d)))
CORE.query("insert_rollouts", f"{_UPDATES} SELECT run_id, trajectory_id, reward FROM cat UNION ALL SELECT run_id, trajectory_id || '-new', 0.25 FROM ch")(
    lambda s, d: (
        lambda c: catalog.insert(c.select(*_K, "reward"), _changes(c).select("run_id", F.concat("trajectory_id", F.lit("-new")).alias("trajectory_id"), "reward"))
    )(cat(s, d))
)
CORE.query(
    "usage_increment",
    f"""{_C}, u AS (SELECT c.run_id, c.trajectory_id, count(*) AS n FROM cat c JOIN rollout_run r ON c.run_id = r.run_id AND c.trajectory_id = r.trajectory_id AND r.used > 1 GROUP BY 1, 2)
SELECT c.run_id, c.trajectory_id, CAST(coalesce(c.used, 0) + coalesce(u.n, 0) AS INTEGER) AS used FROM cat c LEFT JOIN u ON c.run_id = u.run_id AND c.trajectory_id = u.trajectory_id""",
)(lambda s, d: catalog.add_usage(cat(s, d), table(s, d, "rollout_run", *_K, "used").filter("used > 1")).select(*_K, "used"))
CORE.query("delete_run", f"{_C} SELECT id FROM cat WHERE run_id <> {_BIG_RUN}")(lambda s, d: (lambda c: catalog.delete_runs(c, [r.run_id for r in _big_run(c).collect()]).filter("run_id is not null").select("id"))(cat(s, d)))
CORE.query("usage_running_total", f"{_C} SELECT id, CAST(sum(coalesce(used, 0)) OVER (PARTITION BY run_id, task_id ORDER BY id) AS BIGINT) AS total FROM cat")(
    lambda s, d: batch.running_total(cat(s, d).select("id", "run_id", "task_id", "used"), "used", ["run_id", "task_id"], "id").select("id", "total")
)
CORE.query("row_md5", "SELECT DISTINCT id, md5(coalesce(CAST(id AS VARCHAR), '') || '|' || coalesce(run_id, '') || '|' || coalesce(task_id, '') || '|' || coalesce(CAST(used AS VARCHAR), '') || '|' || coalesce(model_version, '')) AS row_hash FROM rollout_run")(
    lambda s, d: _row_hash(table(s, d, "rollout_run", "id", "run_id", "task_id", "used", "model_version")).distinct()
)


def _row_hash(df):
    from tracemill.functions.text import row_md5

    return df.select("id", row_md5("id", "run_id", "task_id", "used", "model_version").alias("row_hash"))


_VN = "CAST(CASE WHEN regexp_full_match(model_version, 'v[0-9]+') THEN substring(model_version, 2) END AS BIGINT)"
CORE.query("task_statistics", f"{_C} SELECT task_id, count(*) AS n, round(avg(used), 10) AS avg_used, round(avg(coalesce(reward, 0)), 10) + 0.0 AS avg_reward, max({_VN}) AS max_version FROM cat GROUP BY task_id")(
    lambda s, d: catalog.task_statistics(cat(s, d)).withColumns({"avg_used": F.round("avg_used", 10), "avg_reward": F.round("avg_reward", 10) + 0.0})
)
CORE.query("task_priority_top", f"{_C} SELECT task_id, coalesce(max({_VN}), -1) AS max_version, min(coalesce(used, 0)) AS min_used FROM cat GROUP BY task_id ORDER BY 2 DESC, 3, 1 LIMIT 50")(lambda s, d: catalog.task_priority(cat(s, d)).limit(50))
CORE.query(
    "top_rows_per_task", f"{_C} SELECT id, CAST(rank AS INTEGER) AS rank FROM (SELECT id, row_number() OVER (PARTITION BY task_id ORDER BY coalesce({_VN}, -1) DESC, coalesce(used, 0), coalesce(reward, 0) DESC, id) AS rank FROM cat) WHERE rank <= 4"
)(lambda s, d: catalog.top_per_task(cat(s, d), 4).select("id", "rank"))
CORE.query("task_queue_slots", "SELECT o_orderkey, (o_orderkey % 64) % 10 AS slot FROM orders")(lambda s, d: table(s, d, "orders", "o_orderkey").select("o_orderkey", catalog.queue_slot(F.col("o_orderkey"), 64, 10).alias("slot")))
CORE.query("changed_rows", f"{_C}, h AS (SELECT id, md5(CAST(used AS VARCHAR)) AS a, md5(CAST(used + CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR)) AS b FROM cat WHERE used IS NOT NULL AND id % 2 = 0) SELECT id FROM h WHERE a <> b")(
    lambda s, d: _changed(cat(s, d).filter("used is not null"))
)


def _changed(c):
    from tracemill.functions.text import row_md5
    from tracemill.streaming.monitor import changed_ids

    seen = c.filter("id % 2 = 0").select("id", row_md5("used").alias("row_hash"))
    now = c.withColumn("used", F.col("used") + F.when(F.col("id") % 5 == 0, 1).otherwise(0)).select("id", row_md5("used").alias("row_hash"))
    return changed_ids(now, seen)


CORE.query("new_ids_except", f"{_C} SELECT id FROM cat EXCEPT SELECT rollout_id FROM monitor_seen")(lambda s, d: cat(s, d).select("id").join(table(s, d, "monitor_seen", F.col("rollout_id").alias("id")), "id", "left_anti"))
CORE.query("known_ids_intersect", f"{_C} SELECT id FROM cat INTERSECT SELECT rollout_id FROM monitor_seen")(lambda s, d: cat(s, d).select("id").intersect(table(s, d, "monitor_seen", F.col("rollout_id").alias("id"))))
CORE.query("distinct_tasks", "SELECT DISTINCT task_id FROM rollout_run")(lambda s, d: table(s, d, "rollout_run", "task_id").distinct())
CORE.query(
    "newly_passing",
    f"""{_C}, p AS (SELECT id FROM cat WHERE reward = 1), sp AS (SELECT id FROM cat WHERE reward = 1 AND id % 3 = 0), added AS (SELECT id FROM cat WHERE id % 5 = 0) SELECT id FROM p EXCEPT SELECT id FROM sp EXCEPT SELECT id FROM added""",
)(lambda s, d: (lambda c: monitor.newly_passing(c.filter("reward = 1"), c.filter("reward = 1 and id % 3 = 0"), c.filter("id % 5 = 0")))(cat(s, d)))

# curation ---------------------------------------------------------------------------------

_SCORED = "reward IS NOT NULL AND reward <> -1"


def _swap(group: str, pool: str, positive: str) -> str:
    """Oracle of the replacement rule over group(*, mean) with columns id, task_id, create_at, reward."""
    return f"""best AS (SELECT * FROM (SELECT id AS nid, task_id AS nt, create_at AS nc, reward AS nr, row_number() OVER (PARTITION BY task_id ORDER BY {_NEW}) AS rk FROM {pool} WHERE {positive}) WHERE rk = 1),
rk AS (SELECT g.id, g.task_id, g.create_at, g.reward, mean, b.*, row_number() OVER (PARTITION BY g.task_id ORDER BY {_OLD}) AS old, max(CASE WHEN g.id = b.nid THEN 1 ELSE 0 END) OVER (PARTITION BY g.task_id) AS inside FROM {group} g LEFT JOIN best b ON g.task_id = b.nt),
sw AS (SELECT CASE WHEN s THEN nid ELSE id END AS id, task_id, CASE WHEN s THEN nc ELSE create_at END AS create_at, CASE WHEN s THEN nr ELSE reward END AS reward FROM (
 SELECT *, abs(mean) <= 1e-12 AND old = 1 AND inside = 0 AS s FROM rk WHERE abs(mean) > 1e-12 OR nid IS NOT NULL))"""


_FRESH = f"""{_V}, fresh AS (SELECT c.* FROM cat c JOIN (SELECT DISTINCT model_version FROM vr WHERE rank <= 2) t ON c.model_version = t.model_version WHERE used = 0 AND {_SCORED}),
el AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY task_id) AS n, avg(reward) OVER (PARTITION BY task_id) AS mean FROM fresh) WHERE n >= 4 AND mean >= 0 AND mean < 1.0)"""
CORE.query("eligible_rollouts", f"{_FRESH} SELECT id, round(mean, 6) + 0.0 AS mean FROM el")(lambda s, d: curation.eligible(_fresh(cat(s, d)), 4, 1.0).select("id", r6("_mean", "mean")))


def _fresh(c):
    top = catalog.newest_versions(c, 2).select("model_version").distinct()
    return curation.scored(c.filter("used = 0").join(top, "model_version", "left_semi"))


CORE.query("replaced_all_zero_groups", f"{_FRESH}, {_swap('el', f'(SELECT * FROM cat WHERE {_SCORED})', 'reward > 0')} SELECT id, task_id, reward FROM sw")(
    lambda s, d: (lambda c: curation.replace_all_zero(curation.eligible(_fresh(c), 4, 1.0), curation.scored(c), F.col("reward") > 0).select("id", "task_id", "reward"))(cat(s, d))
)
CORE.query(
    "trainable_group_sizes",
    f"""{_FRESH}, {_swap('el', f'(SELECT * FROM cat WHERE {_SCORED})', 'reward > 0')} SELECT task_id, least(count(*), 4) AS n, CASE WHEN max(reward) > 0 THEN true ELSE false END AS has_positive FROM sw GROUP BY task_id""",
)(
    lambda s, d: (
        lambda c: curation.trainable(c, catalog.newest_versions(c, 2).select("model_version"), per_task=4).groupBy("task_id").agg(F.count("*").alias("n"), (F.max("reward") > 0).alias("has_positive"))
    )(cat(s, d))
)
CORE.query(
    "trainable_rollouts",
    f"""{_FRESH}, {_swap('el', f'(SELECT * FROM cat WHERE {_SCORED})', 'reward > 0')},
tr AS (SELECT *, md5('42|' || id) AS h, row_number() OVER (PARTITION BY task_id, reward > 0 ORDER BY md5('42|' || id), id) AS c FROM sw)
SELECT id, task_id FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY CASE WHEN c > 1 THEN 1 ELSE 0 END, h, id) AS rk FROM tr WHERE c <= 4) WHERE rk <= 4""",
)(lambda s, d: (lambda c: curation.trainable(c, catalog.newest_versions(c, 2).select("model_version"), per_task=4).select("id", "task_id"))(cat(s, d)))
CORE.query(
    "monitor_trainable",
    f"""{_V}, fresh AS (SELECT c.* FROM cat c JOIN vr ON c.run_id = vr.run_id AND c.model_version = vr.model_version AND vr.rank <= 2 WHERE {_SCORED}),
el AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY task_id) AS n, avg(reward) OVER (PARTITION BY task_id) AS mean FROM fresh) WHERE n >= 4 AND mean >= 0 AND mean < 1.0),
{_swap('el', f'(SELECT * FROM cat WHERE {_SCORED})', 'reward = 1')},
q AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY {_NEW}) AS k FROM sw), q2 AS (SELECT *, max(CASE WHEN reward = 1 AND k <= 4 THEN 1 ELSE 0 END) OVER (PARTITION BY task_id) AS has, min(CASE WHEN reward = 1 THEN k END) OVER (PARTITION BY task_id) AS f FROM q)
SELECT id, task_id FROM q2 WHERE CASE WHEN has = 1 OR f IS NULL THEN k <= 4 ELSE k <= 3 OR k = f END""",
)(lambda s, d: curation.monitor_trainable(cat(s, d), per_task=4).select("id", "task_id"))
_GROUPS = f"""{_C}, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY {_NEW}) AS k FROM cat) WHERE k <= 4),
g AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY task_id) AS n, avg(coalesce(reward, 0)) OVER (PARTITION BY task_id) AS mean FROM top) WHERE n = 4 AND mean >= 0 AND mean < 1), {_swap('g', 'cat', 'reward = 1')},
gr AS (SELECT *, min(create_at) OVER (PARTITION BY task_id) AS group_at FROM sw)"""
CORE.query("training_groups", f"{_GROUPS} SELECT id, task_id, group_at FROM gr")(lambda s, d: curation.training_groups(cat(s, d), 4).select("id", "task_id", "group_at"))
CORE.query("group_order", f"{_GROUPS}, o AS (SELECT DISTINCT task_id, group_at FROM gr) SELECT task_id, CAST(row_number() OVER (ORDER BY group_at ASC NULLS LAST, task_id) - 1 AS BIGINT) AS place FROM o")(
    lambda s, d: curation.rotate(curation.training_groups(cat(s, d), 4), None)
)
CORE.query("latest_n_per_task", f"{_C} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY task_id ORDER BY {_NEW}) AS k, count(*) OVER (PARTITION BY task_id) AS n FROM cat) WHERE k <= 8 AND n >= 8")(
    lambda s, d: curation.newest_full_groups(cat(s, d), 8).select("id")
)
CORE.query(
    "proportional_sizes",
    f"""{_C}, p AS (SELECT task_id, count(*) AS n, count(*) FILTER (reward > 0.8) AS c, count(*) FILTER (reward = 0) AS w FROM cat GROUP BY task_id),
q AS (SELECT *, c * 1.0 / n AS p, CASE WHEN c = 0 THEN 0 ELSE least(ceil(c * 1.0 / n * 8), c) END AS qc FROM p)
SELECT task_id, CAST(qc AS BIGINT) AS n_correct, CAST(least(CASE WHEN c = 0 THEN 8 ELSE 8 - qc END, w) AS BIGINT) AS n_wrong FROM q WHERE (c = 0 AND w > 0) OR (c > 0 AND p <= 0.875 AND p >= 0.125)""",
)(lambda s, d: curation.proportional(cat(s, d)).groupBy("task_id").agg(F.count_if(F.col("reward") > 0.8).alias("n_correct"), F.count_if(F.col("reward") == 0).alias("n_wrong")))
CORE.query(
    "priority_filter",
    f"""{_C}, m AS (SELECT *, max(CASE WHEN reward = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY task_id) AS neg FROM cat WHERE reward IN (0, 1)) SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY task_id ORDER BY reward DESC, id) AS k FROM m WHERE neg = 1) WHERE k <= 8""",
)(lambda s, d: curation.priority(cat(s, d)).select("id"))
CORE.query("dynamic_sampling", f"{_C} SELECT id FROM (SELECT id, stddev_pop(reward) OVER (PARTITION BY run_id, task_id) AS sd, count(*) OVER (PARTITION BY run_id, task_id) AS n FROM cat WHERE reward IS NOT NULL) WHERE sd > 1e-12 OR n = 1")(
    lambda s, d: curation.drop_flat_groups(cat(s, d).filter("reward is not null").withColumn("uid", F.struct("run_id", "task_id")), "reward").select("id")
)
CORE.query(
    "accuracy_filter",
    f"""{_C}, m AS (SELECT id, task_id, avg(reward) OVER (PARTITION BY task_id) AS acc, max(num_chunks) OVER (PARTITION BY task_id) AS len FROM cat WHERE reward IS NOT NULL AND num_chunks IS NOT NULL),
p AS (SELECT id, task_id, acc >= 0.1 AND acc <= 0.9 AND len < 10 AS pass FROM m) SELECT id, pass FROM p ORDER BY pass DESC, task_id, id LIMIT (SELECT CAST(floor(count(*) / 2.0) AS BIGINT) FROM p)""",
)(lambda s, d: curation.accuracy_filter(cat(s, d).filter("reward is not null and num_chunks is not null").withColumnsRenamed({"reward": "acc", "num_chunks": "length"}), 0.1, 0.9, 11, 2.0, "task_id", "id").select("id", "pass"))
CORE.query(
    "negative_prefix_trim",
    f"""{_C}, st AS (SELECT id, reward, unnest(range(coalesce(num_chunks, 0))) AS step FROM cat WHERE reward IN (0, 1)), a AS (SELECT floor(avg(n)) AS a FROM (SELECT id, count(*) AS n FROM st WHERE reward > 0 GROUP BY id))
SELECT id, CAST(step AS INTEGER) AS step FROM st, a WHERE reward <> 0 OR step >= a""",
)(
    lambda s, d: curation.trim_negative_prefix(
        cat(s, d).filter("reward in (0, 1) and num_chunks > 0").select("id", "reward", F.explode(F.sequence(F.lit(0), F.col("num_chunks") - 1)).alias("step")), "id"
    ).select("id", "step")
)
for _m, _e in {"pow": "power(abs(reward), 2.0)", "max_min": "CASE WHEN reward = (SELECT max(reward) FROM z) OR reward = (SELECT min(reward) FROM z) THEN 1.0 ELSE 0.0 END", "max_random": "CASE WHEN reward = (SELECT max(reward) FROM z) THEN 0.4 ELSE 0.1 END"}.items():
    CORE.query(f"resample_weights_{_m}", f"{_C}, z AS (SELECT id, reward FROM cat WHERE {_SCORED}) SELECT id, round({_e} + 1e-8, 6) AS weight FROM z")(
        lambda s, d, m=_m: curation.resample_weights(curation.scored(cat(s, d)).select("id", "reward"), "reward", m).select("id", F.round("weight", 6).alias("weight"))
    )
CORE.query("resampled_rollouts")(lambda s, d: curation.resample(curation.scored(cat(s, d)).select(F.col("id").alias("_row"), "reward"), "reward"))

# set operations, joins and evaluation over the catalog ---------------------------------------

CORE.query(
    "experiment_regressions",
    f"""{_C}, e AS (SELECT run_id, task_id, max_by(reward, id) AS r FROM cat WHERE reward IS NOT NULL GROUP BY run_id, task_id)
SELECT a.task_id, a.run_id AS run_a, b.run_id AS run_b FROM e a JOIN e b ON a.task_id = b.task_id AND a.run_id < b.run_id WHERE a.r = 1 AND b.r = 0""",
)(lambda s, d: _regressions(cat(s, d)))


def _regressions(c):
    return metrics.regressions(c, "run_id", "task_id", "reward", "id")


_DOM = "m AS (SELECT task_id, min(domain) AS domain FROM (SELECT lower(trim(regexp_replace(trim(task_id), '\\.json$', ''))) AS task_id, domain FROM task_manifest) GROUP BY task_id)"


def _domains(s, d):
    key = F.lower(F.trim(F.regexp_replace(F.trim("task_id"), r"\.json$", "")))
    return table(s, d, "task_manifest", "task_id", "domain").select(key.alias("task_id"), "domain").groupBy("task_id").agg(F.min("domain").alias("domain"))


CORE.query(
    "domain_success_rollup",
    f"""{_C}, {_DOM}, j AS (SELECT coalesce(m.domain, 'unknown') AS domain, reward FROM cat c LEFT JOIN m ON lower(c.task_id) = m.task_id WHERE reward >= 0)
SELECT domain, count(*) AS n_runs, round(sum(reward), 6) AS success, round(sum(reward) / count(*), 6) AS rate FROM j GROUP BY domain UNION ALL SELECT 'total', count(*), round(sum(reward), 6), round(sum(reward) / count(*), 6) FROM j""",
)(
    lambda s, d: metrics.domain_rates(cat(s, d).withColumn("task_id", F.lower("task_id")).join(_domains(s, d), "task_id", "left").withColumn("domain", F.coalesce("domain", F.lit("unknown")))).select(
        F.when(F.col("is_total") == 1, "total").otherwise(F.col("domain")).alias("domain"), "n_runs", F.round("success", 6).alias("success"), F.round("rate", 6).alias("rate")
    )
)
CORE.query(
    "domain_stats_compared",
    f"""{_C}, {_DOM}, j AS (SELECT coalesce(m.domain, 'unknown') AS domain, reward, c.id FROM cat c LEFT JOIN m ON lower(c.task_id) = m.task_id WHERE reward >= 0),
a AS (SELECT domain, avg(reward) AS r FROM j WHERE id % 2 = 0 AND domain <> 'os' GROUP BY domain), b AS (SELECT domain, avg(reward) AS r FROM j WHERE id % 2 = 1 AND domain <> 'writer' GROUP BY domain)
SELECT coalesce(a.domain, b.domain) AS domain, round(coalesce(a.r, 0), 6) + 0.0 AS rate_a, round(coalesce(b.r, 0), 6) + 0.0 AS rate_b, round(coalesce(b.r, 0) - coalesce(a.r, 0), 6) + 0.0 AS delta FROM a FULL JOIN b ON a.domain = b.domain""",
)(lambda s, d: _compared(cat(s, d).withColumn("task_id", F.lower("task_id")).join(_domains(s, d), "task_id", "left").withColumn("domain", F.coalesce("domain", F.lit("unknown"))).filter("reward >= 0")))


def _compared(j):
    both = metrics.rates_compared(j.filter("id % 2 = 0 and domain <> 'os'"), j.filter("id % 2 = 1 and domain <> 'writer'"), "domain", "reward")
    return both.select("domain", *[r6(c, c) for c in ("rate_a", "rate_b", "delta")])


CORE.query("experiment_summary", f"{_C}, t AS (SELECT run_id, task_id, avg(reward) AS m, max(reward) AS b, sum(reward) AS s, count(*) AS n FROM cat WHERE {_SCORED} GROUP BY 1, 2) SELECT run_id, round(sum(s) / sum(n), 10) + 0.0 AS mean_reward, round(avg(m), 10) + 0.0 AS mean_task_reward, round(avg(b), 10) + 0.0 AS any_correct, count(*) AS n_tasks FROM t GROUP BY run_id")(
    lambda s, d: metrics.experiment_summary(curation.scored(cat(s, d)), "run_id", "task_id", "reward").select("run_id", *[(F.round(c, 10) + 0.0).alias(c) for c in ("mean_reward", "mean_task_reward", "any_correct")], "n_tasks")
)
CORE.query(
    "task_step_statistics",
    f"""{_C} SELECT task_id, count(*) AS n, round(avg(num_chunks), 6) AS steps_mean, round(stddev_pop(num_chunks), 6) AS steps_std, min(num_chunks) AS steps_min, max(num_chunks) AS steps_max, round(avg(CASE WHEN reward = 1 THEN 1.0 ELSE 0 END), 6) AS success_rate,
round(avg(CASE WHEN reward = 1 THEN num_chunks END), 6) AS success_steps_mean, count(DISTINCT run_id) AS n_runs FROM cat WHERE num_chunks IS NOT NULL GROUP BY task_id""",
)(lambda s, d: _r(metrics.task_statistics(cat(s, d).filter("num_chunks is not null"), "task_id", "num_chunks", F.coalesce(F.col("reward") == 1, F.lit(False)), "run_id"), "steps_mean", "steps_std", "success_rate", "success_steps_mean"))


def _r(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


CORE.query("runs_per_task_histogram", f"{_C}, t AS (SELECT task_id, count(DISTINCT run_id) AS n_runs FROM cat GROUP BY task_id) SELECT n_runs, count(*) AS n_tasks FROM t GROUP BY n_runs")(
    lambda s, d: metrics.group_sizes(cat(s, d), "task_id", "run_id", "n_runs").withColumnRenamed("n_groups", "n_tasks")
)
CORE.query("batch_composition", f"{_C} SELECT model_version, count(*) AS n FROM cat GROUP BY model_version")(lambda s, d: metrics.composition(cat(s, d), "model_version"))
CORE.query("batch_composition_by_task", f"{_C} SELECT task_id, count(*) AS n FROM cat GROUP BY task_id")(lambda s, d: metrics.composition(cat(s, d), "task_id"))
CORE.query("offline_eval_mean", f"{_C}, t AS (SELECT run_id, task_id, avg(reward) AS m FROM cat WHERE {_SCORED} GROUP BY 1, 2) SELECT run_id, round(avg(m), 6) + 0.0 AS reward FROM t GROUP BY run_id")(
    lambda s, d: metrics.mean_of_means(curation.scored(cat(s, d)), "run_id", "task_id", "reward").select("run_id", r6("reward", "reward"))
)
CORE.query(
    "majority_reward",
    f"""{_C}, v AS (SELECT task_id, reward, count(*) AS n, min(id) AS f FROM cat WHERE {_SCORED} GROUP BY 1, 2) SELECT task_id, reward FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY n DESC, f) AS k FROM v) WHERE k = 1""",
)(lambda s, d: metrics.majority_value(curation.scored(cat(s, d)).select("task_id", F.col("reward").alias("vote"), "reward", "id"), ["task_id"], "vote", "reward", "id"))
CORE.query("pass_at_2_gap", f"{_C} SELECT task_id, round(max(CASE WHEN k = 1 THEN reward END) - max(CASE WHEN k = 2 THEN reward END), 6) + 0.0 AS gap FROM (SELECT task_id, reward, row_number() OVER (PARTITION BY task_id ORDER BY reward DESC, id) AS k FROM cat WHERE {_SCORED}) WHERE k <= 2 GROUP BY task_id HAVING count(*) = 2")(
    lambda s, d: curation.best_gap(curation.scored(cat(s, d)), "reward", "task_id", "id").select("task_id", r6("gap", "gap"))
)
CORE.query(
    "pair_accuracy",
    f"""{_C}, x0 AS (SELECT row_number() OVER (ORDER BY task_id, id) - 1 AS p, coalesce(num_chunks, 0) AS s, reward AS a FROM cat WHERE {_SCORED}), x AS (SELECT *, floor(p / 8) AS g FROM x0),
p AS (SELECT i.g, abs(i.a - j.a) AS w, CASE WHEN (i.s - j.s > 0) = (i.a - j.a > 0) THEN abs(i.a - j.a) ELSE 0 END AS ok FROM x i JOIN x j ON i.g = j.g AND i.p < j.p),
g AS (SELECT x.g, CASE WHEN coalesce(any_value(q.w), 0) = 0 THEN 0.5 ELSE any_value(q.ok) / any_value(q.w) END AS acc FROM x LEFT JOIN (SELECT g, sum(w) AS w, sum(ok) AS ok FROM p GROUP BY 1) q ON x.g = q.g GROUP BY 1) SELECT round(avg(acc), 6) AS dpo_acc FROM g""",
)(lambda s, d: _pair_accuracy(curation.scored(cat(s, d))))


def _pair_accuracy(c):
    """Runs of 8 rows stand for the samples of one prompt."""
    rows = batch.number_rows(c.withColumn("c", F.coalesce("num_chunks", F.lit(0))), "task_id", "id")
    return metrics.pair_accuracy(rows, F.floor(F.col("_row") / 8), "c", "reward", "_row").select(F.round("dpo_acc", 6).alias("dpo_acc"))


CORE.query("sampling_audit", f"{_C} SELECT split_part(trajectory_id, '_', 1) AS task, count(*) AS n_original, count(*) FILTER (id % 3 > 0) AS n_final, count(*) FILTER (id % 3 > 0) - count(*) AS delta FROM cat GROUP BY 1")(
    lambda s, d: (lambda c: batch.sampling_audit(c, c.filter("id % 3 > 0"), "trajectory_id"))(cat(s, d))
)
CORE.query("reduce_metrics_by_name", "SELECT event_type || CASE user_id % 3 WHEN 0 THEN '_max' WHEN 1 THEN '_min' ELSE '' END AS key, round(CASE user_id % 3 WHEN 0 THEN max(value) WHEN 1 THEN min(value) ELSE avg(value) END, 6) AS value FROM events GROUP BY event_type, user_id % 3")(
    lambda s, d: metrics.reduce_by_name(table(s, d, "events", "event_type", "user_id", "value").select(F.concat("event_type", F.when(F.col("user_id") % 3 == 0, "_max").when(F.col("user_id") % 3 == 1, "_min").otherwise("")).alias("key"), "value")).select("key", F.round("value", 6).alias("value"))
)
CORE.query("latency_overall", "SELECT count(*) AS n, round(avg(value), 4) AS model_duration, round(avg(value / 3), 4) AS env_duration FROM events")(lambda s, d: metrics.latency(_latency(s, d), "model_duration", "env_duration")[0])
CORE.query("latency_per_step", "SELECT user_id % 11 AS step, count(*) AS n, round(avg(value), 4) AS model_duration, round(avg(value / 3), 4) AS env_duration FROM events GROUP BY 1")(lambda s, d: metrics.latency(_latency(s, d), "model_duration", "env_duration")[1])


def _latency(s, d):
    return table(s, d, "events", "user_id", "value").select((F.col("user_id") % 11).alias("step"), F.col("value").alias("model_duration"), (F.col("value") / 3).alias("env_duration"))


CORE.query("throughput", "SELECT round(sum(value) / (sum(user_id % 5 + 1) * 8), 6) AS tokens_per_sec_gpu FROM events")(lambda s, d: table(s, d, "events", "value", "user_id").agg(F.round(metrics.throughput(F.sum("value"), F.sum(F.col("user_id") % 5 + 1), 8), 6).alias("tokens_per_sec_gpu")))
CORE.query("timing_per_token", "SELECT event_type AS name, CAST(sum(user_id) AS BIGINT) AS seconds, CASE WHEN event_type = 'gen' THEN sum(user_id) * 1000.0 / 50 WHEN event_type = 'ref' THEN sum(user_id) * 1000.0 / 150 END AS ms_per_token FROM (SELECT CASE event_type WHEN 'error' THEN 'gen' WHEN 'click' THEN 'ref' ELSE event_type END AS event_type, user_id FROM events) GROUP BY 1")(
    lambda s, d: metrics.timing(table(s, d, "events", "event_type", "user_id").select(F.when(F.col("event_type") == "error", "gen").when(F.col("event_type") == "click", "ref").otherwise(F.col("event_type")).alias("name"), "user_id").groupBy("name").agg(F.sum("user_id").alias("seconds")), 100, 50)
)

# checkpoints --------------------------------------------------------------------------------

CORE.query("checkpoint_latest_n", "SELECT id, version, CAST(substring(version, 2) AS BIGINT) AS version_no FROM checkpoint WHERE regexp_full_match(version, 'v[0-9]+') ORDER BY version_no DESC, id DESC LIMIT 5")(lambda s, d: catalog.latest_checkpoints(table(s, d, "checkpoint", "id", "version"), 5))
CORE.query("checkpoint_next_version", "SELECT 'v' || CAST(coalesce(max(CAST(substring(version, 2) AS BIGINT)) + 1, 0) AS VARCHAR) AS next_version FROM checkpoint WHERE source = 'train' AND regexp_full_match(version, 'v[0-9]+')")(lambda s, d: catalog.next_version(table(s, d, "checkpoint")))
CORE.query("registry_lookup", "SELECT id, version FROM checkpoint WHERE deleted_at IS NULL AND version = 'v7'")(lambda s, d: catalog.lookup(table(s, d, "checkpoint"), version="v7").select("id", "version"))
CORE.query("registry_listing", "SELECT id, status FROM checkpoint WHERE deleted_at IS NULL AND status = 'COMPLETED' ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 5 OFFSET 1")(lambda s, d: catalog.listing(table(s, d, "checkpoint"), "COMPLETED", 5, 1).select("id", "status"))
CORE.query("registry_partial_update", "SELECT id, CASE WHEN id = 2 AND deleted_at IS NULL THEN 'fixed' ELSE remark END AS remark, CASE WHEN id = 2 AND deleted_at IS NULL THEN TIMESTAMP '2026-06-01' ELSE updated_at END AS updated_at FROM checkpoint")(
    lambda s, d: catalog.partial_update(table(s, d, "checkpoint"), 2, {"remark": "fixed", "path": "/x"}, ["remark"], F.lit("2026-06-01").cast("timestamp_ntz"))[0].select("id", "remark", "updated_at")
)
CORE.query("registry_soft_delete", "SELECT id, CASE WHEN id = 2 AND deleted_at IS NULL THEN TIMESTAMP '2026-06-01' ELSE deleted_at END AS deleted_at FROM checkpoint")(lambda s, d: catalog.soft_delete(table(s, d, "checkpoint"), 2, F.lit("2026-06-01").cast("timestamp_ntz")).select("id", "deleted_at"))
CORE.query("registry_hard_delete", "SELECT id FROM checkpoint WHERE id <> 2")(lambda s, d: catalog.hard_delete(table(s, d, "checkpoint"), 2).select("id"))
CORE.query("registry_count", "SELECT count(*) AS n FROM checkpoint WHERE deleted_at IS NULL AND status = 'FAILED'")(lambda s, d: catalog.count_rows(table(s, d, "checkpoint"), status="FAILED"))
CORE.query("registry_name_search", "SELECT id, name FROM checkpoint WHERE deleted_at IS NULL AND name LIKE '%ckpt_b%'")(lambda s, d: catalog.search_name(table(s, d, "checkpoint"), "ckpt_b").select("id", "name"))
CORE.query("registry_newest", "SELECT id FROM checkpoint ORDER BY created_at DESC NULLS LAST, id DESC LIMIT 1")(lambda s, d: catalog.newest(table(s, d, "checkpoint")).select("id"))
CORE.query("registry_activate", "SELECT id, status FROM checkpoint UNION ALL SELECT 9999, 'starting'")(lambda s, d: catalog.activate(table(s, d, "checkpoint"), {"id": 9999, "path": "/p"}, F.lit("2026-06-01").cast("timestamp_ntz")).select("id", "status"))
_UT = "ut AS (SELECT o_orderkey AS id, o_orderkey % 40 AS checkpoint_id, CAST(o_orderkey % 10 AS INTEGER) AS priority, CAST(o_orderkey % 4 AS INTEGER) AS status, CASE WHEN o_orderkey % 10 = 9 THEN 'system' ELSE 'normal' END AS type, o_orderdate AS created_at FROM orders)"


def _ut(s, d):
    k = F.col("o_orderkey")
    return table(s, d, "orders", "o_orderkey", "o_orderdate").select(k.alias("id"), (k % 40).alias("checkpoint_id"), (k % 10).cast("int").alias("priority"), (k % 4).cast("int").alias("status"), F.when(k % 10 == 9, "system").otherwise("normal").alias("type"), F.col("o_orderdate").alias("created_at"))


CORE.query("registry_join_checkpoint", f"WITH {_UT} SELECT ut.id, ut.checkpoint_id, c.name AS checkpoint_name, c.path AS checkpoint_path FROM ut LEFT JOIN checkpoint c ON ut.checkpoint_id = c.id ORDER BY ut.created_at DESC, ut.id DESC LIMIT 20 OFFSET 5")(
    lambda s, d: catalog.with_checkpoint(_ut(s, d), table(s, d, "checkpoint", "id", "name", "path"), F.col("created_at").desc(), F.col("id").desc(), limit=20, offset=5).select("id", "checkpoint_id", "checkpoint_name", "checkpoint_path")
)
CORE.query("registry_queue_join_checkpoint", f"WITH {_UT} SELECT ut.id, ut.priority, c.name AS checkpoint_name FROM ut LEFT JOIN checkpoint c ON ut.checkpoint_id = c.id ORDER BY ut.priority DESC, ut.created_at, ut.id LIMIT 20")(
    lambda s, d: catalog.with_checkpoint(_ut(s, d), table(s, d, "checkpoint", "id", "name", "path"), F.col("priority").desc(), F.col("created_at").asc(), F.col("id").asc(), limit=20).select("id", "priority", "checkpoint_name")
)
CORE.query("registry_task_queue", f"WITH {_UT} SELECT id, priority FROM ut WHERE status = 0 AND type = 'normal' ORDER BY priority DESC, created_at, id LIMIT 25")(lambda s, d: catalog.task_queue(_ut(s, d), 25, status=0, type="normal").select("id", "priority"))
CORE.query("registry_queue_head", f"WITH {_UT} SELECT id FROM ut ORDER BY priority DESC, created_at, id LIMIT 1")(lambda s, d: catalog.task_queue(_ut(s, d), 1).select("id"))
CORE.query("registry_move_state", f"WITH {_UT} SELECT id, CASE WHEN id = 2 THEN 1 ELSE status END AS status, CASE WHEN id = 2 THEN TIMESTAMP '2026-06-01' END AS started_at FROM ut")(
    lambda s, d: catalog.move_state(_ut(s, d).withColumns({"updated_at": F.lit(None).cast("timestamp_ntz"), "started_at": F.lit(None).cast("timestamp_ntz")}), 2, 1, F.lit("2026-06-01").cast("timestamp_ntz")).select("id", "status", "started_at")
)
CORE.query("registry_priority_rule", f"WITH {_UT} SELECT id, CASE WHEN type = 'system' THEN priority = 9 ELSE priority BETWEEN 0 AND 8 END AS valid FROM ut")(lambda s, d: _ut(s, d).select("id", catalog.priority_is_valid(F.col("type"), F.col("priority")).alias("valid")))
CORE.query("registry_counts_by_state", f"WITH {_UT} SELECT status, type, count(*) AS n FROM ut GROUP BY status, type")(lambda s, d: catalog.counts_by(_ut(s, d), "status", "type"))
