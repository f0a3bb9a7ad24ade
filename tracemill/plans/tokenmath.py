"""Queries on token batches: advantages, rewards, losses, masks and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.functions import tokens as tk
from tracemill.operators import advantage as adv
from tracemill.operators import loss
from tracemill.plans.adapters import TOKENS, long, token_batch
from tracemill.plans.registry import CORE

_T = "WITH " + TOKENS
_S = _T + ", s AS (SELECT _row, uid, sum(r) AS s, sum(m) AS len, sum(r * m) AS sm FROM t GROUP BY _row, uid)"
_R6 = "round({0}, 6) + 0.0"


def _outcome(value: str, more: str = "") -> str:
    """Oracle of an estimator that gives each row one value, on its valid places."""
    return f"{_S}{more}, o AS (SELECT _row, {value} AS val FROM s) SELECT t._row, t.pos, round(o.val * t.m, 6) + 0.0 AS advantages FROM t JOIN o ON t._row = o._row"


_CNT, _AVG, _STD = "count(*) OVER (PARTITION BY uid)", "avg(s) OVER (PARTITION BY uid)", "stddev_samp(s) OVER (PARTITION BY uid)"


def _whitened(rows: str, col: str = "a", mask: bool = False) -> str:
    """Whitens rows (_row, pos, m, col) as SELECT."""
    stats = f"w AS (SELECT sum({col} * m) / (sum(m) + 1e-8) AS mean, sum(m) AS n FROM {rows}), w2 AS (SELECT any_value(mean) AS mean, sum(({col} - mean) * ({col} - mean) * m) / (any_value(n) + 1e-8) * any_value(n) / (any_value(n) - 1) AS var FROM {rows}, w)"
    times = " * m" if mask else ""
    return stats, f"({col} - mean) / sqrt(var + 1e-8){times}"


def _dense(df):
    return long(df, "advantages")


CORE.query("adv_grpo", _outcome(f"(s - CASE WHEN {_CNT} = 1 THEN 0 ELSE {_AVG} END) / (CASE WHEN {_CNT} = 1 THEN 1 ELSE {_STD} END + 1e-6)"))(lambda s, d: _dense(adv.grpo(token_batch(s, d))))
CORE.query("adv_grpo_no_std", _outcome(f"s - CASE WHEN {_CNT} = 1 THEN 0 ELSE {_AVG} END"))(lambda s, d: _dense(adv.grpo(token_batch(s, d), norm_by_std=False)))
CORE.query("adv_rloo", _outcome(f"CASE WHEN {_CNT} = 1 THEN s ELSE (s - {_AVG}) * {_CNT} / ({_CNT} - 1) END"))(lambda s, d: _dense(adv.rloo(token_batch(s, d))))
CORE.query("adv_opo", _outcome(f"s - CASE WHEN {_CNT} = 1 THEN 0 ELSE sum(s * len) OVER (PARTITION BY uid) / sum(len) OVER (PARTITION BY uid) END"))(lambda s, d: _dense(adv.opo(token_batch(s, d))))
CORE.query(
    "adv_grpo_passk",
    f"""{_S}, k AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY s DESC, _row) AS rk, lead(s) OVER (PARTITION BY uid ORDER BY s DESC, _row) AS nx, {_STD} AS sd, {_CNT} AS n FROM s),
o AS (SELECT _row, CASE WHEN rk = 1 THEN (s - nx) / (sd + 1e-6) ELSE 0 END AS val FROM k WHERE n >= 2)
SELECT t._row, t.pos, round(o.val * t.m, 6) + 0.0 AS advantages FROM t JOIN o ON t._row = o._row""",
)(lambda s, d: _dense(adv.grpo_passk(_pairs(token_batch(s, d)))))


def _pairs(df):
    from pyspark.sql import Window as W

    return df.withColumn("_c", F.count("*").over(W.partitionBy("uid"))).filter("_c >= 2").drop("_c")


_G1, _G2 = _whitened("g")
CORE.query(
    "adv_gae",
    f"""{_T}, dl AS (SELECT *, r + 0.99 * coalesce(lead(v) OVER (PARTITION BY _row ORDER BY pos), 0) - v AS delta FROM t),
g AS (SELECT a._row, a.pos, any_value(a.m) AS m, any_value(a.v) AS v, sum(b.delta * power(0.99 * 0.95, b.pos - a.pos)) AS a FROM dl a JOIN dl b ON a._row = b._row AND b.pos >= a.pos GROUP BY a._row, a.pos), {_G1}
SELECT _row, pos, round({_G2}, 6) + 0.0 AS advantages, round(a + v, 6) + 0.0 AS returns FROM g, w2""",
)(lambda s, d: long(adv.gae(token_batch(s, d), gamma=0.99, lam=0.95), "advantages", "returns"))

_G3, _G4 = _whitened("g", mask=True)
CORE.query(
    "adv_reinforce_pp_baseline",
    f"""{_S}, o AS (SELECT _row, s - CASE WHEN {_CNT} = 1 THEN 0 ELSE {_AVG} END AS val FROM s), g AS (SELECT t._row, pos, m, val * m AS a FROM t JOIN o ON t._row = o._row), {_G3}
SELECT _row, pos, round({_G4}, 6) + 0.0 AS advantages FROM g, w2""",
)(lambda s, d: _dense(adv.reinforce_pp_baseline(token_batch(s, d))))
CORE.query(
    "adv_reinforce_pp",
    f"""{_T}, x AS (SELECT a._row, a.pos AS pos, b.pos AS bp, b.r, coalesce((SELECT CASE WHEN min(c.m) = 0 THEN 0.0 ELSE 1.0 END FROM t c WHERE c._row = a._row AND c.pos > a.pos AND c.pos <= b.pos), 1.0) AS open FROM t a JOIN t b ON a._row = b._row AND b.pos >= a.pos),
g AS (SELECT x._row, x.pos, any_value(t.m) AS m, sum(x.r * power(0.9, x.bp - x.pos) * x.open) AS a FROM x JOIN t ON t._row = x._row AND t.pos = x.pos GROUP BY x._row, x.pos), {_G3}
SELECT _row, pos, round({_G4}, 6) + 0.0 AS advantages, round(a, 6) + 0.0 AS returns FROM g, w2""",
)(lambda s, d: long(adv.reinforce_pp(token_batch(s, d), gamma=0.9), "advantages", "returns"))
CORE.query(
    "adv_remax",
    f"""{_T}, g AS (SELECT _row, pos, m, sum(r * m) OVER (PARTITION BY _row ORDER BY pos DESC) AS ret FROM t)
SELECT _row, pos, round(ret - 0.05 * m, 6) + 0.0 AS advantages, round(ret, 6) + 0.0 AS returns FROM g""",
)(lambda s, d: long(adv.remax(token_batch(s, d).withColumn("baseline", F.lit(0.05))), "advantages", "returns"))
CORE.query(
    "adv_prime_rloo",
    f"""{_S}, b AS (SELECT _row, floor(_row / 4) AS g, sm / len AS mm, CASE WHEN s > 0.2 THEN 1.0 ELSE 0.0 END AS acc, len FROM s),
bb AS (SELECT *, sum(mm) OVER (PARTITION BY g) / 3 AS b1, sum(acc) OVER (PARTITION BY g) / 3 AS b2 FROM b),
p AS (SELECT t._row, pos, m, (CASE WHEN m > 0 THEN (r * 4 / 3 - b1) * 5.0 ELSE 0 END + CASE WHEN pos = len - 1 THEN (acc * 4 / 3 - b2) * 2.0 ELSE 0 END) * m AS f FROM t JOIN bb ON t._row = bb._row),
g AS (SELECT _row, pos, m, sum(f) OVER (PARTITION BY _row ORDER BY pos DESC) AS a FROM p), {_G1}
SELECT _row, pos, round({_G2}, 6) + 0.0 AS advantages, round(a, 6) + 0.0 AS returns FROM g, w2""",
)(
    lambda s, d: long(
        adv.prime_rloo(token_batch(s, d).withColumn("acc_at_last", F.when(adv.score() > 0.2, 1.0).otherwise(0.0)), 4, {"rewards": 5.0, "acc_at_last": 2.0}), "advantages", "returns"
    )
)
CORE.query("adv_sppo", f"{_S}, sm AS (SELECT (ln(avg(exp(s * 2 - mx))) + any_value(mx)) / 2 AS soft FROM s, (SELECT max(s * 2) AS mx FROM s)) SELECT _row, round(s - soft, 6) + 0.0 AS seq_level_rewards FROM s, sm")(
    lambda s, d: adv.sppo(token_batch(s, d), beta=2.0).select("_row", (F.round("seq_level_rewards", 6) + 0.0).alias("seq_level_rewards"))
)
CORE.query(
    "online_dpo_preference",
    f"{_S}, p AS (SELECT *, count(*) OVER (PARTITION BY floor(_row / 2)) AS n, row_number() OVER (PARTITION BY floor(_row / 2) ORDER BY round(sm, 9) DESC, _row) AS rk FROM s) SELECT _row, rk = 1 AS chosen FROM p WHERE n = 2",
)(lambda s, d: adv.preference_mask(_even(token_batch(s, d)).withColumn("rewards", F.array(F.round(tk.masked_sum("rewards", "mask"), 9))).withColumn("mask", F.array(F.lit(1.0)))).select("_row", "chosen"))


def _even(df):
    from pyspark.sql import Window as W

    return df.withColumn("_c", F.count("*").over(W.partitionBy(F.floor(F.col("_row") / 2)))).filter("_c = 2").drop("_c")


@CORE.query(
    "flagship_grpo_summary",
    f"""{_S}, o AS (SELECT *, (s - CASE WHEN {_CNT} = 1 THEN 0 ELSE {_AVG} END) / (CASE WHEN {_CNT} = 1 THEN 1 ELSE {_STD} END + 1e-6) AS adv FROM s)
SELECT uid, count(*) AS n_rows, round(avg(s), 6) + 0.0 AS mean_score, round(max(adv), 6) + 0.0 AS max_advantage, round(min(adv), 6) + 0.0 AS min_advantage, CAST(sum(len) AS BIGINT) AS n_tokens FROM o GROUP BY uid""",
)
def flagship_grpo_summary(spark, d):
    """Group-relative advantages of every row, summarised per group."""
    b = adv.grpo(token_batch(spark, d).withColumn("one", F.lit(1)))
    # the first place of every row is valid, so it holds the row's advantage
    rows = b.select("uid", adv.score().alias("s"), F.get("advantages", F.lit(0)).alias("a"), tk.total("mask").alias("len"))
    return rows.groupBy("uid").agg(
        F.count("*").alias("n_rows"), (F.round(F.avg("s"), 6) + 0.0).alias("mean_score"), (F.round(F.max("a"), 6) + 0.0).alias("max_advantage"),
        (F.round(F.min("a"), 6) + 0.0).alias("min_advantage"), F.sum("len").cast("long").alias("n_tokens"),
    )


# KL and reward shaping ----------------------------------------------------------------

_KL = {"kl": "op - rf", "abs": "abs(op - rf)", "mse": "0.5 * (op - rf) * (op - rf)", "low_var_kl": "least(greatest(exp(least(greatest(rf - op, -20), 20)) - least(greatest(rf - op, -20), 20) - 1, -10), 10)"}
for _k, _e in _KL.items():
    CORE.query(f"kl_{_k}", f"{_T} SELECT _row, pos, round({_e}, 6) + 0.0 AS kl FROM t")(lambda s, d, k=_k: long(token_batch(s, d).withColumn("kl", tk.kl("old_logp", "ref_logp", k)), "kl"))
CORE.query("kl_penalised_reward", f"{_T} SELECT _row, pos, round(r - 0.1 * (op - rf) * m, 6) + 0.0 AS rewards FROM t")(lambda s, d: long(adv.kl_penalised(token_batch(s, d), 0.1), "rewards"))
CORE.query("batch_kl", f"{_T}, k AS (SELECT _row, sum((op - rf) * m) / (sum(m) + 1e-8) AS kl FROM t GROUP BY _row) SELECT round(avg(kl), 6) AS kl FROM k")(
    lambda s, d: adv.kl_penalised(token_batch(s, d), 0.1).agg(F.round(F.avg("_kl"), 6).alias("kl"))
)
CORE.query("reward_cumulative_norm", f"{_T}, c AS (SELECT _row, pos, r, sum(r) OVER (PARTITION BY _row ORDER BY pos DESC) AS g FROM t) SELECT _row, pos, round(r / ((SELECT max(abs(g)) FROM c) + 1e-6), 6) + 0.0 AS rewards FROM c")(
    lambda s, d: long(adv.cumulative_norm(token_batch(s, d)), "rewards")
)
CORE.query("overlong_penalty", "SELECT o_orderkey, round(least(-((o_orderkey % 100) - (80 - 20)) / 20.0 * 1.5, 0.0), 6) + 0.0 AS penalty FROM orders")(
    lambda s, d: s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", (F.round(adv.overlong_penalty(F.col("o_orderkey") % 100, 80, 20, 1.5), 6) + 0.0).alias("penalty"))
)
CORE.query("place_score_at_last", f"{_S} SELECT t._row, t.pos, CASE WHEN t.pos = s.len - 1 THEN round(s.s, 6) ELSE 0.0 END + 0.0 AS scores FROM t JOIN s ON t._row = s._row")(
    lambda s, d: long(token_batch(s, d).withColumn("scores", tk.place_last("mask", adv.score())), "scores")
)
CORE.query(
    "expand_score_to_tokens",
    f"{_S}, p AS (SELECT *, row_number() OVER (PARTITION BY _row ORDER BY pos * m DESC, pos) AS rk FROM t) SELECT p._row, p.pos, CASE WHEN rk = 1 THEN round(s.s, 6) ELSE 0.0 END + 0.0 AS scores FROM p JOIN s ON p._row = s._row",
)(lambda s, d: long(_expanded(token_batch(s, d)), "scores"))


def _expanded(b):
    each = b.withColumn("ids", F.transform("mask", lambda m, i: i)).withColumn("scores", adv.expand_to_tokens(adv.score(), "ids", "mask", F.size("mask")))
    return each


# losses ---------------------------------------------------------------------------------

_PPO = "exp(least(greatest(lp - op, -20), 20))"
_MM = "sum(({0}) * m) / (sum(m) + 1e-8)"
_L1, _L2 = f"(-a * {_PPO})", f"(-a * least(greatest({_PPO}, 0.8), 1.2))"
_PG = f"CASE WHEN a < 0 THEN least(-a * 3.0, greatest({_L1}, {_L2})) ELSE greatest({_L1}, {_L2}) END"


def _rounded(df):
    return df.select(*[(F.round(c, 6) + 0.0).alias(c) for c in df.columns])


CORE.query(
    "loss_ppo",
    f"""{_T} SELECT round({_MM.format(_PG)}, 6) + 0.0 AS pg_loss, round({_MM.format(f'CASE WHEN {_L2} > {_L1} THEN 1 ELSE 0 END')}, 6) + 0.0 AS pg_clipfrac, round({_MM.format('op - lp')}, 6) + 0.0 AS ppo_kl,
round({_MM.format(f'CASE WHEN a < 0 AND greatest({_L1}, {_L2}) > -a * 3.0 THEN 1 ELSE 0 END')}, 6) + 0.0 AS pg_clipfrac_lower FROM t""",
)(lambda s, d: _rounded(loss.ppo(token_batch(s, d))))
CORE.query("loss_ppo_importance_weighted", f"{_T} SELECT round({_MM.format(f'least(exp(op - ro), 1.0) * ({_PG})')}, 6) + 0.0 AS pg_loss FROM t")(lambda s, d: _rounded(loss.ppo(token_batch(s, d), rollout="rollout_logp").select("pg_loss")))
CORE.query(
    "loss_gspo",
    f"""{_T}, q AS (SELECT _row, exp(least(sum((lp - op) * m) / greatest(sum(m), 1), 10)) AS r FROM t GROUP BY _row), z AS (SELECT t._row, m, greatest(-a * r.r, -a * least(greatest(r.r, 0.8), 1.2)) AS l FROM t JOIN q r ON t._row = r._row),
s AS (SELECT _row, sum(l * m) / sum(m) AS l FROM z GROUP BY _row) SELECT round(avg(l), 6) + 0.0 AS pg_loss FROM s""",
)(lambda s, d: _rounded(loss.gspo(token_batch(s, d)).select("pg_loss")))
for _m, _e in {
    "token-mean": "sum(x * m) / (sum(m) + 1e-8) FROM z",
    "seq-mean-token-sum": "avg(s) FROM (SELECT sum(x * m) AS s FROM z GROUP BY _row)",
    "seq-mean-token-mean": "avg(s) FROM (SELECT sum(x * m) / sum(m) AS s FROM z GROUP BY _row)",
    "seq-mean-token-sum-norm": "sum(s) / max(n) FROM (SELECT sum(x * m) AS s, count(*) AS n FROM z GROUP BY _row)",
}.items():
    _e0, _, _f = _e.partition(" FROM ")
    CORE.query(f"agg_loss_{_m.replace('-', '_')}", f"{_T}, z AS (SELECT _row, m, r AS x FROM t) SELECT round({_e0}, 6) + 0.0 AS loss FROM {_f}")(
        lambda s, d, m=_m: token_batch(s, d).agg((F.round(loss.aggregate("rewards", "mask", m), 6) + 0.0).alias("loss"))
    )
CORE.query(
    "loss_kl_cov",
    f"""{_T}, z AS (SELECT *, (a - avg(a) OVER ()) * (lp - avg(lp) OVER ()) AS cov FROM t WHERE m > 0), k AS (SELECT *, row_number() OVER (ORDER BY cov DESC, _row, pos) AS rk, count(*) OVER () AS n FROM z)
SELECT round(avg(-a * exp(lp - op) + CASE WHEN rk <= greatest(1, CAST(floor(n * 0.01) AS BIGINT)) THEN abs(lp - op) ELSE 0 END), 6) + 0.0 AS pg_loss, round(avg(abs(lp - op)), 6) + 0.0 AS ppo_kl FROM k""",
)(lambda s, d: _rounded(loss.kl_cov(token_batch(s, d), ratio=0.01)))
CORE.query(
    "loss_clip_cov",
    f"""{_T}, z AS (SELECT *, (a - avg(a) OVER ()) * (lp - avg(lp) OVER ()) AS cov, -a * exp(lp - op) AS l1, -a * least(greatest(exp(lp - op), 0.8), 1.2) AS l2, count(*) OVER () AS n FROM t WHERE m > 0),
k AS (SELECT _row, pos, row_number() OVER (ORDER BY md5('0|' || _row || '|' || pos), _row, pos) AS rk FROM z WHERE cov > 0.0001 AND cov < 5.0 AND l2 <= l1),
j AS (SELECT z.*, CASE WHEN k.rk <= greatest(1, CAST(floor(n * 0.01) AS BIGINT)) THEN 0.0 ELSE 1.0 END AS keep FROM z LEFT JOIN k ON z._row = k._row AND z.pos = k.pos)
SELECT round(sum(greatest(l1, l2) * keep) / count(*), 6) + 0.0 AS pg_loss, round(avg(CASE WHEN keep = 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS pg_clipfrac, round(avg(op - lp), 6) + 0.0 AS ppo_kl FROM j""",
)(lambda s, d: _rounded(loss.clip_cov(token_batch(s, d), ratio=0.01, lower=0.0001, upper=5.0)))
_V2 = "(least(greatest(rf, v - 0.2), v + 0.2) - r) * (least(greatest(rf, v - 0.2), v + 0.2) - r)"
CORE.query("loss_value", f"{_T} SELECT round(0.5 * {_MM.format(f'greatest((rf - r) * (rf - r), {_V2})')}, 6) + 0.0 AS vf_loss, round({_MM.format(f'CASE WHEN {_V2} > (rf - r) * (rf - r) THEN 1 ELSE 0 END')}, 6) + 0.0 AS vf_clipfrac FROM t")(
    lambda s, d: _rounded(loss.value_loss(token_batch(s, d).withColumnsRenamed({"ref_logp": "vpreds", "rewards": "returns"}), 0.2))
)
CORE.query("loss_entropy", f"{_T}, e AS (SELECT m, [r, v, 0.0] AS l FROM t), z AS (SELECT m, exp(l[1]) + exp(l[2]) + exp(l[3]) AS z, l FROM e) SELECT round({_MM.format('ln(z) - (l[1] * exp(l[1]) + l[2] * exp(l[2]) + l[3] * exp(l[3])) / z')}, 6) + 0.0 AS loss FROM z")(
    lambda s, d: token_batch(s, d)
    .withColumn("e", loss.entropy(F.zip_with("rewards", "values", lambda a, b: F.array(a, b, F.lit(0.0)))))
    .agg((F.round(loss.aggregate("e", "mask", "token-mean"), 6) + 0.0).alias("loss"))
)
CORE.query("logp_from_logits", f"{_T} SELECT _row, pos, round(CASE pos % 3 WHEN 0 THEN r WHEN 1 THEN v ELSE 0.0 END - ln(exp(r) + exp(v) + 1), 6) + 0.0 AS logp FROM t")(
    lambda s, d: long(token_batch(s, d).withColumn("logp", loss.gather_logp(F.zip_with("rewards", "values", lambda a, b: F.array(a, b, F.lit(0.0))), F.transform("rewards", lambda x, i: i % 3))), "logp")
)
CORE.query("dpo_batch_logps", f"{_T} SELECT _row, round(sum(CASE WHEN pos > 0 THEN lp ELSE 0 END), 6) + 0.0 AS logps FROM t GROUP BY _row")(
    lambda s, d: token_batch(s, d).select("_row", (F.round(loss.batch_logps(F.col("logp"), F.transform("logp", lambda x, i: F.when(i == 0, -100).otherwise(i))), 6) + 0.0).alias("logps"))
)
_H = "((sc - sr) - (0.5 * sc - 0.2 * sr))"
for _kind, _e in {"sigmoid": f"0.9 * ln(1 + exp(-0.5 * {_H})) + 0.1 * ln(1 + exp(0.5 * {_H}))", "ipo": f"({_H} - 1.0) * ({_H} - 1.0)"}.items():
    CORE.query(
        f"loss_dpo_{_kind}",
        f"{_S}, p AS (SELECT a.sm AS sc, b.sm AS sr FROM s a JOIN s b ON floor(a._row / 2) = floor(b._row / 2) AND a._row % 2 = 0 AND b._row % 2 = 1) SELECT round(avg({_e}), 6) + 0.0 AS loss FROM p",
    )(lambda s, d, k=_kind: _dpo(token_batch(s, d), k))


def _dpo(df, kind):
    s = df.select("_row", tk.masked_sum("rewards", "mask").alias("s"))
    pair = s.groupBy(F.floor(F.col("_row") / 2)).agg(F.max(F.when(F.col("_row") % 2 == 0, F.col("s"))).alias("c"), F.max(F.when(F.col("_row") % 2 == 1, F.col("s"))).alias("r")).filter("c is not null and r is not null")
    return pair.agg((F.round(F.avg(loss.dpo(F.col("c"), F.col("r"), 0.5 * F.col("c"), 0.2 * F.col("r"), 0.5, kind, 0.1)), 6) + 0.0).alias("loss"))


CORE.query("loss_sppo", f"{_T}, z AS (SELECT _row, sum((lp - op) * m) AS lr, max(m) AS some FROM t GROUP BY _row), s AS (SELECT _row, sum(r) AS s FROM t GROUP BY _row) SELECT round(sum((lr - s) * (lr - s)) / (count(*) + 1e-8), 6) + 0.0 AS loss FROM z JOIN s ON z._row = s._row")(
    lambda s, d: _rounded(loss.sppo(token_batch(s, d).withColumn("seq_level_rewards", adv.score())).select("loss"))
)
CORE.query("loss_ce_reward_model", f"{_S} SELECT round(avg(CASE WHEN s > 0.2 THEN ln(1 + exp(-2 * sm)) ELSE ln(1 + exp(2 * sm)) END), 6) + 0.0 AS loss FROM s")(
    lambda s, d: _rounded(loss.ce_reward(token_batch(s, d).withColumn("acc", F.when(adv.score() > 0.2, 1.0).otherwise(0.0)), 2.0))
)
_DET = f"""{_S}, b AS (SELECT uid, CASE WHEN s > 0.2 THEN 1.0 ELSE 0.0 END AS acc, sm * 2 AS q FROM s),
o AS (SELECT b.*, coalesce(CASE WHEN acc > 0 THEN avg(CASE WHEN acc = 0 THEN q END) OVER (PARTITION BY uid) ELSE avg(CASE WHEN acc > 0 THEN q END) OVER (PARTITION BY uid) END, 0) AS other FROM b),
l AS (SELECT *, ln(1 + exp(-(q - other) * CASE WHEN acc > 0 THEN 1 ELSE -1 END)) AS l FROM o) """
_acc = lambda s, d: token_batch(s, d).withColumn("acc", F.when(adv.score() > 0.2, 1.0).otherwise(0.0))
CORE.query("loss_detached_dpo", _DET + "SELECT round(avg(l), 6) + 0.0 AS loss FROM l")(lambda s, d: _rounded(loss.detached_pairs(_acc(s, d), 2.0)))
CORE.query("loss_detached_dpo_bon_acc", _DET + "SELECT round(sum(n * power(sh, n - 1) * l), 4) + 0.0 AS loss FROM (SELECT l, count(*) OVER (PARTITION BY uid) AS n, cume_dist() OVER (PARTITION BY uid ORDER BY acc) AS sh FROM l)")(
    lambda s, d: loss.detached_pairs(_acc(s, d), 2.0, best_of="bon_acc").select((F.round("loss", 4) + 0.0).alias("loss"))
)

# masks and arrays -------------------------------------------------------------------------

CORE.query("position_ids", f"{_T} SELECT _row, pos, greatest(CAST(sum(m) OVER (PARTITION BY _row ORDER BY pos) AS INTEGER) - 1, 0) AS ids FROM t")(
    lambda s, d: token_batch(s, d).select("_row", F.posexplode(tk.positions("mask")).alias("pos", "ids"))
)
CORE.query("masked_position_ids", f"{_T} SELECT _row, pos, CAST(pos * m AS INTEGER) AS ids FROM t")(lambda s, d: token_batch(s, d).select("_row", F.posexplode(F.transform("mask", lambda m, i: (i * m).cast("int"))).alias("pos", "ids")))
CORE.query(
    "eos_mask",
    f"{_T}, e AS (SELECT _row, min(pos) AS p FROM t WHERE CAST(round(r * 100) AS INTEGER) IN (3, 7) GROUP BY _row) SELECT t._row, t.pos, CASE WHEN t.pos <= coalesce(e.p, 1000000) THEN 1 ELSE 0 END AS mask FROM t LEFT JOIN e ON t._row = e._row",
)(lambda s, d: token_batch(s, d).select("_row", F.posexplode(tk.eos_mask(F.transform("rewards", lambda r: F.round(r * 100).cast("int")), 3, 7)).alias("pos", "mask")))
_ARR = ", g AS (SELECT _row, list(CAST(round(r * 100) AS INTEGER) ORDER BY pos) AS a FROM t GROUP BY _row)"
_ints = lambda s, d: token_batch(s, d).select("_row", "mask", F.transform("rewards", lambda r: F.round(r * 100).cast("int")).alias("a"))
CORE.query("pad_right", f"{_T}{_ARR} SELECT _row, array_to_string(list_concat(a, list_transform(range(greatest(0, 6 - len(a))), lambda x: 0)), ',') AS a FROM g")(lambda s, d: _ints(s, d).select("_row", F.array_join(tk.pad("a", 6, 0), ",").alias("a")))
CORE.query("pad_left", f"{_T}{_ARR} SELECT _row, array_to_string(list_concat(list_transform(range(greatest(0, 6 - len(a))), lambda x: 0), a), ',') AS a FROM g")(
    lambda s, d: _ints(s, d).select("_row", F.array_join(tk.pad("a", 6, 0, left=True), ",").alias("a"))
)
for _how, _e in {"right": "a[1:3]", "left": "a[greatest(len(a) - 2, 1):]", "middle": "CASE WHEN len(a) > 3 THEN list_concat(a[1:1], a[len(a) - 1:]) ELSE a END"}.items():
    CORE.query(f"truncate_{_how}", f"{_T}{_ARR} SELECT _row, array_to_string({_e}, ',') AS a FROM g")(lambda s, d, h=_how: _ints(s, d).select("_row", F.array_join(tk.truncate("a", 3, h), ",").alias("a")))
CORE.query("strip_left_padding", f"{_T}{_ARR} SELECT _row, array_to_string(coalesce(a[(SELECT min(i) FROM unnest(range(1, len(a) + 1)) u(i) WHERE a[i] <> 0):], []), ',') AS a FROM g WHERE len(list_filter(a, lambda x: x <> 0)) > 0")(
    lambda s, d: _ints(s, d).filter(F.exists("a", lambda x: x != 0)).select("_row", F.array_join(tk.strip_left_pad("a", 0), ",").alias("a"))
)
CORE.query("response_mask_tail", f"{_T}, n AS (SELECT _row, pos, m, count(*) OVER (PARTITION BY _row) AS c FROM t) SELECT _row, CAST(pos - (c - 2) AS INTEGER) AS pos, m FROM n WHERE pos >= c - 2 AND c >= 2")(
    lambda s, d: token_batch(s, d).filter(F.size("mask") >= 2).select("_row", F.posexplode(tk.response_mask("mask", 2)).alias("pos", "m"))
)
CORE.query("window_mask", f"{_S}, r AS (SELECT unnest(range(12)) AS pos) SELECT s._row, CAST(r.pos AS INTEGER) AS pos, CASE WHEN r.pos >= 4 AND r.pos < 4 + s.len THEN 1 ELSE 0 END AS m FROM s, r")(
    lambda s, d: token_batch(s, d).select("_row", F.posexplode(tk.window_mask(12, 4, tk.total("mask"))).alias("pos", "m"))
)
CORE.query("sft_loss_mask", f"{_T}, n AS (SELECT *, count(*) OVER (PARTITION BY _row) AS c, sum(m) OVER (PARTITION BY _row) AS len FROM t) SELECT _row, pos, CAST(CASE WHEN pos < least(2, c) - 1 OR pos = len - 1 THEN 0 ELSE m END AS INTEGER) AS m FROM n")(
    lambda s, d: token_batch(s, d).select("_row", F.posexplode(tk.sft_loss_mask("mask", F.lit(2))).alias("pos", "m"))
)
CORE.query("subsequence_positions", f"{_T}, n AS (SELECT *, lead(CAST(round(r * 100) AS INTEGER)) OVER (PARTITION BY _row ORDER BY pos) AS nx FROM t) SELECT _row, pos AS at FROM n WHERE CAST(round(r * 100) AS INTEGER) = 3 AND nx = 5")(
    lambda s, d: _ints(s, d).select("_row", F.explode(tk.subsequence_positions("a", F.array(F.lit(3), F.lit(5)))).alias("at"))
)
CORE.query("masked_whiten", f"{_T}, g AS (SELECT _row, pos, m, r AS a FROM t), {_G1} SELECT _row, pos, round({_G2}, 6) + 0.0 AS rewards FROM g, w2")(lambda s, d: long(adv.whiten(token_batch(s, d), "rewards"), "rewards"))
CORE.query("masked_mean_var", f"{_T}, n AS (SELECT _row, sum(m) AS n, sum(r * m) / (sum(m) + 1e-8) AS mean FROM t GROUP BY _row HAVING sum(m) > 1) SELECT n._row, round(any_value(mean), 6) + 0.0 AS mean, round(sum((r - mean) * (r - mean) * m) / (any_value(n) + 1e-8) * any_value(n) / (any_value(n) - 1), 6) + 0.0 AS var FROM t JOIN n ON t._row = n._row GROUP BY n._row")(
    lambda s, d: token_batch(s, d).filter(tk.total("mask") > 1).select("_row", (F.round(tk.masked_mean("rewards", "mask"), 6) + 0.0).alias("mean"), (F.round(tk.masked_var("rewards", "mask"), 6) + 0.0).alias("var"))
)

# metrics ----------------------------------------------------------------------------------

CORE.query(
    "batch_data_metrics",
    f"""{_S}, k AS (SELECT round(avg(s), 6) AS score_mean, round(max(s), 6) AS score_max, round(min(s), 6) AS score_min, round(avg(len), 6) AS length_mean, max(len) AS length_max, min(len) AS length_min, round(avg(CASE WHEN len = 4 THEN 1.0 ELSE 0 END), 6) AS clip_ratio FROM s),
v AS (SELECT round(avg(a), 6) + 0.0 AS adv_mean, max(round(a, 6)) + 0.0 AS adv_max, min(round(a, 6)) + 0.0 AS adv_min, round(avg(v), 6) AS values_mean, round(1 - var_samp(r - v) / (var_samp(r) + 1e-5), 6) AS explained_var FROM t WHERE m > 0)
SELECT * FROM k, v""",
)(lambda s, d: _metrics(token_batch(s, d)))


def _metrics(b):
    from tracemill.operators import metrics

    return metrics.batch_metrics(b, max_length=4)


CORE.query(
    "rollout_actor_prob_diff",
    f"{_T} SELECT round(max(d), 6) + 0.0 AS diff_max, round(avg(d), 6) + 0.0 AS diff_mean, round(stddev_samp(d), 6) + 0.0 AS diff_std FROM (SELECT abs(exp(op) - exp(ro)) AS d FROM t WHERE m > 0)",
)(lambda s, d: _rounded(_prob_diff(token_batch(s, d))))


def _prob_diff(b):
    from tracemill.operators import metrics

    return metrics.prob_diff(b)
