"""Loss values over a token batch (no gradients).

Batches have ``mask`` and per-token arrays ``logp``, ``old_logp``, ``advantages`` and so
on. Per-token terms are array expressions in the row; a loss is one aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions import tokens as t

LOSSES: dict[str, Callable[..., DataFrame]] = {}


def register(name: str) -> Callable:
    def add(f):
        if LOSSES.get(name, f) is not f:
            raise ValueError(f"loss {name} is already registered")
        LOSSES[name] = f
        return f

    return add


def aggregate(loss: Column | str, mask: Column | str, mode: str) -> Column:
    """An aggregate column: token-mean, seq-mean-token-sum, seq-mean-token-mean or seq-mean-token-sum-norm.

    token-mean has 1e-8 in its divisor; a row without valid tokens makes
    seq-mean-token-mean NaN, as 0 / 0.
    """
    s, n = t.masked_sum(loss, mask), t.total(mask)
    if mode == "token-mean":
        return F.sum(s) / (F.sum(n) + 1e-8)
    if mode == "seq-mean-token-sum":
        return F.avg(s)
    if mode == "seq-mean-token-mean":
        return F.avg(F.when(n > 0, s / F.nullif(n, F.lit(0.0))).otherwise(float("nan")))
    if mode == "seq-mean-token-sum-norm":
        return F.sum(s) / F.max(F.size(mask if not isinstance(mask, str) else F.col(mask)))
    raise ValueError(f"unknown mode {mode}")


def _masked_mean(a: Column | str) -> Column:
    return F.sum(t.masked_sum(a, "mask")) / (F.sum(t.total("mask")) + 1e-8)


def _ratio(df: DataFrame, clamp: float | None = 20.0) -> DataFrame:
    diff = F.zip_with("logp", "old_logp", lambda a, b: F.least(F.greatest(a - b, F.lit(-clamp)), F.lit(clamp)) if clamp else a - b)
    return df.withColumn("_d", diff).withColumn("_r", F.transform("_d", F.exp))


def _terms(df: DataFrame, low: float, high: float) -> DataFrame:
    """Per token (a, r) with the unclipped and clipped terms l1 and l2."""
    clip = lambda r: F.least(F.greatest(r, F.lit(1 - low)), F.lit(1 + high))
    one = lambda a, r: F.struct(a.alias("a"), (-a * r).alias("l1"), (-a * clip(r)).alias("l2"))
    return df.withColumn("_p", F.zip_with("advantages", "_r", one))


def importance_weights(df: DataFrame, rollout: str = "rollout_logp") -> DataFrame:
    """Adds ``_w`` = min(exp(old - rollout), 1) and ``ratio_iv_mean``; all-zero rollout rows count as old."""
    zero = F.forall(rollout, lambda x: F.abs(x) < 1e-9)
    iv = F.when(zero, F.transform("old_logp", lambda x: F.lit(1.0))).otherwise(F.zip_with("old_logp", rollout, lambda o, v: F.exp(o - v)))
    out = df.withColumn("_iv", iv)
    return out.withColumn("_w", F.transform("_iv", lambda x: F.least(x, F.lit(1.0)))).withColumn("ratio_iv_mean", t.masked_sum("_iv", "mask") / F.nullif(t.total("mask"), F.lit(0.0)))


@register("ppo")
def ppo(df: DataFrame, clip: float = 0.2, low: float | None = None, high: float | None = None, dual: float = 3.0, mode: str = "token-mean", rollout: str | None = None) -> DataFrame:
    """Dual-clip policy loss, one row: pg_loss, pg_clipfrac, ppo_kl, pg_clipfrac_lower."""
    if dual <= 1:
        raise ValueError("the dual clip must exceed 1")
    b = _terms(_ratio(df), clip if low is None else low, clip if high is None else high)
    best = lambda p: F.greatest(p["l1"], p["l2"])
    loss = F.transform("_p", lambda p: F.when(p["a"] < 0, F.least(-p["a"] * dual, best(p))).otherwise(best(p)))
    b = b.withColumn("_l", loss)
    if rollout:
        b = importance_weights(b, rollout).withColumn("_l", F.zip_with("_w", "_l", lambda w, x: w * x))
    frac = F.transform("_p", lambda p: (p["l2"] > p["l1"]).cast("double"))
    lower = F.transform("_p", lambda p: ((best(p) > -p["a"] * dual) & (p["a"] < 0)).cast("double"))
    return b.agg(aggregate("_l", "mask", mode).alias("pg_loss"), _masked_mean(frac).alias("pg_clipfrac"), _masked_mean(F.transform("_d", lambda x: -x)).alias("ppo_kl"), _masked_mean(lower).alias("pg_clipfrac_lower"))


@register("gspo")
def gspo(df: DataFrame, clip: float = 0.2, low: float | None = None, high: float | None = None, rollout: str | None = None) -> DataFrame:
    """Sequence-level ratios; always seq-mean-token-mean."""
    b = df.withColumn("_d", F.zip_with("logp", "old_logp", lambda a, o: a - o))
    seq = F.exp(F.least(t.masked_sum("_d", "mask") / F.greatest(t.total("mask"), F.lit(1.0)), F.lit(10.0)))
    b = b.withColumn("_q", seq).withColumn("_r", F.transform("_d", lambda x: F.col("_q")))
    b = _terms(b, clip if low is None else low, clip if high is None else high)
    b = b.withColumn("_l", F.transform("_p", lambda p: F.greatest(p["l1"], p["l2"])))
    if rollout:
        b = importance_weights(b, rollout).withColumn("_l", F.zip_with("_w", "_l", lambda w, x: w * x))
    frac = F.transform("_p", lambda p: (p["l2"] > p["l1"]).cast("double"))
    return b.agg(aggregate("_l", "mask", "seq-mean-token-mean").alias("pg_loss"), _masked_mean(frac).alias("pg_clipfrac"), _masked_mean(F.transform("_d", lambda x: -x)).alias("ppo_kl"))


def _covariance(df: DataFrame) -> DataFrame:
    """Long rows (_row, pos, m, a, d, lp, cov) of valid tokens."""
    z = F.arrays_zip(F.col("advantages").alias("a"), F.col("logp").alias("lp"), F.col("old_logp").alias("op"), F.col("mask").alias("m"))
    long = df.select("_row", F.posexplode(z).alias("pos", "z")).select("_row", "pos", "z.*").filter("m > 0")
    mean = long.agg(F.struct(F.avg("a").alias("a"), F.avg("lp").alias("lp"))).scalar()
    return long.withColumn("_m", mean).withColumn("cov", (F.col("a") - F.col("_m.a")) * (F.col("lp") - F.col("_m.lp"))).withColumn("d", F.col("lp") - F.col("op")).drop("_m")


def _first(long: DataFrame, n: int, key: Column) -> DataFrame:
    """The first n tokens by key, then row and place; their number grows with the data, so no sorted limit."""
    from tracemill.operators.batch import first_rows

    return first_rows(long.withColumnRenamed("_row", "_r"), n, key, F.col("_r"), F.col("pos")).withColumnRenamed("_r", "_row")


def _greatest(long: DataFrame, n: int, key: str, low: float | None, high: float | None, bins: int = 65536) -> DataFrame:
    """The n tokens of the greatest key, then of the first rows and places; low and high are the key's least and greatest value.

    A histogram tells the bin where the n-th token lies: tokens above it are taken as they are, and only
    those of that bin are sorted.
    """
    if low is None or not (math.isfinite(low) and math.isfinite(high)) or not low < high:
        return _first(long, n, F.col(key).desc())
    # a key falls into the bin of its distance from the top
    at = F.least(F.floor((F.lit(high) - F.col(key)) / ((high - low) / bins)), F.lit(bins - 1))
    counts = {r.b: (r.n, r.x, r.y) for r in long.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("x"), F.max(key).alias("y")).collect()}
    above = 0
    for b in sorted(counts):
        c, x, y = counts[b]
        if above + c >= n:
            between = _first(long.filter((F.col(key) <= y) & (F.col(key) >= x)), n - above, F.col(key).desc())
            return long.filter(F.col(key) > y).unionByName(between.select(*long.columns))
        above += c
    return long


@register("clip_cov")
def clip_cov(df: DataFrame, clip: float = 0.2, ratio: float = 0.0002, lower: float = 1.0, upper: float = 5.0, seed: int = 0) -> DataFrame:
    """token-mean loss without the clip_num tokens, picked by hash, whose covariance lies in (lower, upper)."""
    long = _covariance(df).withColumn("r", F.exp("d"))
    l1, l2 = -F.col("a") * F.col("r"), -F.col("a") * F.least(F.greatest(F.col("r"), F.lit(1 - clip)), F.lit(1 + clip))
    long = long.withColumns({"l1": l1, "l2": l2})
    n = long.agg(F.greatest((F.count("*") * ratio).cast("long"), F.lit(1))).first()[0]
    able = long.filter((F.col("cov") > lower) & (F.col("cov") < upper) & (F.col("l2") <= F.col("l1")))
    gone = _first(able.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "_row", "pos"))), n, F.col("_h")).select("_row", "pos", F.lit(0.0).alias("keep"))
    kept = long.join(gone, ["_row", "pos"], "left").withColumn("keep", F.coalesce("keep", F.lit(1.0)))
    return kept.agg((F.sum(F.greatest("l1", "l2") * F.col("keep")) / F.count("*")).alias("pg_loss"), F.avg((F.col("keep") == 0).cast("int")).alias("pg_clipfrac"), F.avg(-F.col("d")).alias("ppo_kl"))


@register("kl_cov")
def kl_cov(df: DataFrame, ratio: float = 0.0002, coef: float = 1.0) -> DataFrame:
    """token-mean loss in which the max(1, n * ratio) tokens of greatest covariance also pay coef * abs(kl)."""
    long = _covariance(df)
    n, low, high = long.agg(F.greatest((F.count("*") * ratio).cast("long"), F.lit(1)), F.min("cov"), F.max("cov")).first()
    top = _greatest(long, n, "cov", low, high).select("_row", "pos", F.lit(coef).alias("c"))
    each = long.join(top, ["_row", "pos"], "left")
    loss = -F.col("a") * F.exp("d") + F.coalesce("c", F.lit(0.0)) * F.abs("d")
    return each.agg((F.sum(loss) / F.count("*")).alias("pg_loss"), F.avg(F.abs("d")).alias("ppo_kl"))


def value_loss(df: DataFrame, clip: float, mode: str = "token-mean") -> DataFrame:
    """Clipped value loss from ``vpreds``, ``values`` and ``returns``: vf_loss, vf_clipfrac."""
    z = F.arrays_zip(F.col("vpreds").alias("p"), F.col("values").alias("v"), F.col("returns").alias("r"))
    sq = lambda x, r: (x - r) * (x - r)
    terms = F.transform(z, lambda s: F.struct(sq(s["p"], s["r"]).alias("l1"), sq(F.least(F.greatest(s["p"], s["v"] - clip), s["v"] + clip), s["r"]).alias("l2")))
    b = df.withColumn("_t", terms)
    loss = F.transform("_t", lambda s: F.greatest(s["l1"], s["l2"]))
    frac = F.transform("_t", lambda s: (s["l2"] > s["l1"]).cast("double"))
    return b.agg((0.5 * aggregate(loss, "mask", mode)).alias("vf_loss"), _masked_mean(frac).alias("vf_clipfrac"))


def entropy(logits: Column | str) -> Column:
    """Entropy of each place from an array of logit arrays, by a stable log-sum-exp (small vocabularies)."""
    c = F.col(logits) if isinstance(logits, str) else logits

    def one(l: Column) -> Column:
        top = F.array_max(l)
        z = F.aggregate(l, F.lit(0.0), lambda s, x: s + F.exp(x - top))
        return top + F.log(z) - F.aggregate(l, F.lit(0.0), lambda s, x: s + x * F.exp(x - top)) / z

    return F.transform(c, one)


def gather_logp(logits: Column | str, labels: Column | str) -> Column:
    """Log-probability of each place's label."""
    lse = lambda l: F.array_max(l) + F.log(F.aggregate(l, F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max(l))))
    c = F.col(logits) if isinstance(logits, str) else logits
    y = F.col(labels) if isinstance(labels, str) else labels
    return F.zip_with(c, y, lambda l, i: F.get(l, i.cast("int")) - lse(l))


def batch_logps(logps: Column | str, labels: Column | str, average: bool = False) -> Column:
    """Sum (or mean) of the log-probabilities of labels other than -100."""
    valid = F.transform(F.col(labels) if isinstance(labels, str) else labels, lambda y: (y != -100).cast("double"))
    s = t.masked_sum(logps, valid)
    return s / F.nullif(t.total(valid), F.lit(0.0)) if average else s


def log_sigmoid(x: Column) -> Column:
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def dpo(chosen: Column, rejected: Column, ref_chosen: Column, ref_rejected: Column, beta: float, kind: str = "sigmoid", smoothing: float = 0.0, reference_free: bool = False) -> Column:
    """Per-pair loss, sigmoid (with label smoothing) or ipo."""
    h = (chosen - rejected) - (F.lit(0.0) if reference_free else ref_chosen - ref_rejected)
    if kind == "sigmoid":
        return -log_sigmoid(beta * h) * (1 - smoothing) - log_sigmoid(-beta * h) * smoothing
    if kind == "ipo":
        return (h - 1 / (2 * beta)) * (h - 1 / (2 * beta))
    raise ValueError(kind)


def sppo(df: DataFrame, eta: float = 1.0, reward: str = "seq_level_rewards", mode: str = "token-mean") -> DataFrame:
    if mode != "token-mean":
        raise ValueError("only token-mean is defined")
    ratio = t.masked_sum("logp", "mask") - t.masked_sum("old_logp", "mask")
    term = (ratio - eta * F.col(reward)) * (ratio - eta * F.col(reward))
    some = F.exists("mask", lambda m: m > 0).cast("double")
    return df.agg((F.sum(term * some) / (F.sum(some) + 1e-8)).alias("loss"), F.avg(ratio).alias("log_ratio"))


def ce_reward(df: DataFrame, beta: float, scores: str = "rewards", acc: str = "acc") -> DataFrame:
    """Binary cross-entropy of sigmoid(beta * masked score sum) against acc, in its stable form."""
    x = t.masked_sum(scores, "mask") * beta
    return df.agg(F.avg(-(F.col(acc) * log_sigmoid(x) + (1 - F.col(acc)) * log_sigmoid(-x))).alias("loss"))


def detached_pairs(df: DataFrame, beta: float, group: str = "uid", scores: str = "rewards", acc: str = "acc", best_of: str = "none") -> DataFrame:
    """Preference loss of each row against the mean score of the group's rows of the other outcome.

    best_of weights rows by n * (share of the group not better) ** (n - 1), by score
    (``bon_rm``) or accuracy (``bon_acc``), and sums; without, the mean is taken. A row of
    a group is compared with aggregates over accuracy, kept per group.
    """
    from pyspark.sql import Window as W

    g, same = W.partitionBy("g"), W.partitionBy("g", "acc")
    upto = g.orderBy("acc")  # its default frame takes in all rows of equal acc
    b = df.select(F.col(group).alias("g"), F.col(acc).alias("acc"), (t.masked_sum(scores, "mask") * beta).alias("q"))
    one = F.lit(1)
    below = lambda x: F.sum(x).over(upto) - F.sum(x).over(same)
    above = lambda x: F.sum(x).over(g) - F.sum(x).over(upto)
    q = F.col("q")
    other = F.when(F.col("acc") > 0, below(q) / F.nullif(below(one), F.lit(0))).otherwise(above(q) / F.nullif(above(one), F.lit(0)))
    b = b.withColumn("other", F.coalesce(other, F.lit(0.0)))
    loss = -log_sigmoid((F.col("q") - F.col("other")) * F.when(F.col("acc") > 0, 1.0).otherwise(-1.0))
    if best_of == "none":
        return b.agg(F.avg(loss).alias("loss"))
    by = {"bon_rm": "q", "bon_acc": "acc"}[best_of]
    n = F.count("*").over(g)
    share = F.cume_dist().over(g.orderBy(by))
    return b.withColumn("w", n * F.pow(share, n - 1)).withColumn("l", loss).agg(F.sum(F.col("w") * F.col("l")).alias("loss"))
