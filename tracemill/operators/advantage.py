"""Advantages over a token batch.

A batch has ``_row``, ``uid`` (the prompt's group), ``rewards`` and ``mask`` (arrays of
one length per row), and ``values`` for GAE. Every estimator adds ``advantages`` and
``returns`` (arrays). Within-row recurrences are array folds; group statistics are
aggregates of one number per row, joined back on uid; whitening statistics are one aggregated row,
read as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.functions import tokens as t

EPS = 1e-6
ESTIMATORS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str) -> Callable:
    """Registers an estimator; a name taken by another function raises ValueError."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if ESTIMATORS.get(name, f) is not f:
            raise ValueError(f"estimator {name} is already registered")
        ESTIMATORS[name] = f
        return f

    return add


def compute(df: DataFrame, estimator: str, **options) -> DataFrame:
    if estimator not in ESTIMATORS:
        raise ValueError(f"unknown estimator {estimator}")
    return ESTIMATORS[estimator](df, **options)


def response_mask(df: DataFrame, attention: str = "attention_mask") -> DataFrame:
    """Adds ``mask``, the part of the attention mask that belongs to the response, where there is none yet."""
    return df if "mask" in df.columns else df.withColumn("mask", F.slice(attention, F.size(attention) - F.size("rewards") + 1, F.size("rewards")))


def dispatch(df: DataFrame, estimator: str, multi_turn: bool = False, effective: str = "mask_eff", loss_mask: str = "loss_mask", attention: str = "attention_mask", **options) -> DataFrame:
    """:func:`compute` on the mask that the estimator is meant for; the batch keeps its own mask.

    grpo counts the places of the effective mask, if the batch has one, and in multi-turn batches the last
    places of the loss mask; all other estimators count those of the response.
    """
    df = response_mask(df, attention)
    if estimator != "grpo" or not (multi_turn or effective in df.columns):
        return compute(df, estimator, **options)
    other = F.slice(loss_mask, F.size(loss_mask) - F.size("mask") + 1, F.size("mask")) if multi_turn else F.col(effective)
    swapped = df.withColumn("_own_mask", F.col("mask")).withColumn("mask", other)
    return compute(swapped, estimator, **options).withColumn("mask", F.col("_own_mask")).drop("_own_mask")


def score() -> Column:
    return t.total("rewards")


def whiten(df: DataFrame, column: str, shift_mean: bool = True) -> DataFrame:
    """Masked whitening over the whole batch, with Bessel's correction."""
    n, s1 = F.sum(t.total("mask")), F.sum(t.masked_sum(column, "mask"))
    s2 = F.sum(t.total(F.zip_with(column, "mask", lambda x, m: x * x * m)))
    mean = s1 / (n + 1e-8)
    var = (s2 - 2 * mean * s1 + mean * mean * n) / (n + 1e-8) * n / (n - 1)
    stats = df.agg(F.struct(mean.alias("mean"), var.alias("var")).alias("s")).scalar()
    scaled = df.withColumn("_w", stats)
    value = F.transform(column, lambda x: (x - F.col("_w.mean")) / F.sqrt(F.col("_w.var") + 1e-8) + (F.lit(0.0) if shift_mean else F.col("_w.mean")))
    return scaled.withColumn(column, value).drop("_w")


def _spread(df: DataFrame, value: Column) -> DataFrame:
    """The row's value on every valid place."""
    adv = F.transform("mask", lambda m: value * m)
    return df.withColumn("advantages", adv).withColumn("returns", F.col("advantages"))


def _grouped(df: DataFrame, **stats: Column) -> DataFrame:
    """Adds statistics of the row's uid, from columns ``_s`` (score) and ``_l`` (length).

    Scores are aggregated before the shuffle and joined back, so that a uid with a large
    share of all rows is split by the skew join instead of filling one window task.
    """
    one = df.select("uid", score().alias("_s"), t.total("mask").alias("_l")).groupBy("uid").agg(*[c.alias(n) for n, c in stats.items()])
    return df.withColumn("_s", score()).join(one, "uid")


@register("gae")
def gae(df: DataFrame, gamma: float = 1.0, lam: float = 1.0) -> DataFrame:
    out = df.withColumn("advantages", t.gae("rewards", "values", gamma, lam))
    out = out.withColumn("returns", F.zip_with("advantages", "values", lambda a, v: a + v))
    return whiten(out, "advantages")


@register("grpo")
def grpo(df: DataFrame, norm_by_std: bool = True, eps: float = EPS) -> DataFrame:
    """(score - mean) / (sample std + eps); a group of one has mean 0 and std 1."""
    s = _grouped(df, _n=F.count("*"), _m=F.avg("_s"), _d=F.stddev_samp("_s"))
    mean, std = F.when(F.col("_n") == 1, 0.0).otherwise(F.col("_m")), F.when(F.col("_n") == 1, 1.0).otherwise(F.col("_d"))
    value = (F.col("_s") - mean) / (std + eps) if norm_by_std else F.col("_s") - mean
    return _spread(s.withColumn("_v", value), F.col("_v")).drop("_s", "_n", "_m", "_d", "_v")


@register("grpo_passk")
def grpo_passk(df: DataFrame, norm_by_std: bool = True, eps: float = EPS) -> DataFrame:
    """Only the best of a group gets (best - second) / (std + eps); ties go to the lowest row; groups of one raise."""
    top = df.select("uid", "_row", score().alias("_s"))
    # two rows per uid are left before the shuffle
    two = top.withColumn("_rk", F.row_number().over(W.partitionBy("uid").orderBy(F.col("_s").desc(), "_row"))).filter("_rk <= 2")
    best = two.groupBy("uid").agg(F.max(F.when(F.col("_rk") == 1, F.col("_row"))).alias("_best"), (F.max("_s") - F.min("_s")).alias("_gap"))
    s = _grouped(df, _n=F.count("*"), _d=F.stddev_samp("_s")).join(best, "uid")
    gain = F.col("_gap") / (F.col("_d") + eps) if norm_by_std else F.col("_gap")
    value = F.when(F.col("_n") < 2, F.raise_error(F.lit("pass@k needs groups of two or more")).cast("double")).when(F.col("_row") == F.col("_best"), gain).otherwise(0.0)
    return _spread(s.withColumn("_v", value), F.col("_v")).drop("_s", "_n", "_d", "_best", "_gap", "_v")


@register("reinforce_plus_plus_baseline")
def reinforce_pp_baseline(df: DataFrame) -> DataFrame:
    s = _grouped(df, _n=F.count("*"), _m=F.avg("_s"))
    out = _spread(s.withColumn("_v", F.col("_s") - F.when(F.col("_n") == 1, 0.0).otherwise(F.col("_m"))), F.col("_v"))
    out = whiten(out.drop("_s", "_n", "_m", "_v"), "advantages").withColumn("advantages", t.masked("advantages", "mask"))
    return out.withColumn("returns", F.col("advantages"))


@register("rloo")
def rloo(df: DataFrame) -> DataFrame:
    """score * n/(n-1) - mean * n/(n-1); a group of one keeps its score."""
    s = _grouped(df, _n=F.count("*"), _m=F.avg("_s"))
    value = F.when(F.col("_n") == 1, F.col("_s")).otherwise((F.col("_s") - F.col("_m")) * F.col("_n") / F.nullif(F.col("_n") - 1, F.lit(0)))
    return _spread(s.withColumn("_v", value), F.col("_v")).drop("_s", "_n", "_m", "_v")


@register("opo")
def opo(df: DataFrame) -> DataFrame:
    """score minus the group's length-weighted mean; baseline 0 for a group of one."""
    s = _grouped(df, _n=F.count("*"), _sl=F.sum(F.col("_s") * F.col("_l")), _len=F.sum("_l"))
    base = F.when(F.col("_n") == 1, 0.0).otherwise(F.col("_sl") / F.col("_len"))
    return _spread(s.withColumn("_v", F.col("_s") - base), F.col("_v")).drop("_s", "_n", "_sl", "_len", "_v")


@register("reinforce_plus_plus")
def reinforce_pp(df: DataFrame, gamma: float = 1.0) -> DataFrame:
    out = df.withColumn("returns", t.discounted("rewards", gamma, reset="mask")).withColumn("advantages", F.col("returns"))
    return whiten(out, "advantages").withColumn("advantages", t.masked("advantages", "mask"))


@register("remax")
def remax(df: DataFrame, baseline: str = "baseline") -> DataFrame:
    out = df.withColumn("returns", t.reverse_cumsum(t.masked("rewards", "mask")))
    return out.withColumn("advantages", F.zip_with("returns", "mask", lambda r, m: r - F.col(baseline) * m))


@register("prime_rloo")
def prime_rloo(df: DataFrame, n_samples: int, sources: dict[str, float]) -> DataFrame:
    """Leave-one-out over several per-token reward sources with coefficients.

    Groups are runs of n_samples rows by ``_row``. A source's baseline is the sum of
    its rows' masked means over n - 1. Names ending in ``_at_last`` hold one number per
    row that stands at the last valid place only.
    """
    g = W.partitionBy(F.floor(F.col("_row") / n_samples))
    scale = n_samples / (n_samples - 1)

    def part(name: str, base: Column, coef: float) -> Column:
        if name.endswith("_at_last"):
            return t.place_last("mask", (F.col(name) * scale - base) * coef)
        return F.zip_with(name, "mask", lambda x, m: F.when(m > 0, (x * scale - base) * coef).otherwise(0.0))

    out, total = df, None
    for i, (name, coef) in enumerate(sources.items()):
        own = F.col(name) if name.endswith("_at_last") else t.masked_sum(name, "mask") / t.total("mask")
        out = out.withColumn(f"_b{i}", F.sum(own).over(g) / (n_samples - 1))
        p = part(name, F.col(f"_b{i}"), coef)
        total = p if total is None else F.zip_with(total, p, lambda a, b: a + b)
    out = out.withColumn("_t", total).withColumn("returns", t.reverse_cumsum(t.masked("_t", "mask"))).withColumn("advantages", F.col("returns"))
    return whiten(out.drop("_t", *[f"_b{i}" for i in range(len(sources))]), "advantages")


@register("sppo")
def sppo(df: DataFrame, beta: float = 1.0) -> DataFrame:
    """score minus the soft mean over the whole batch; adds ``seq_level_rewards``."""
    s = df.withColumn("_s", score())
    if beta == 0:
        soft = s.agg(F.avg("_s")).scalar()
    else:
        top = s.agg(F.max(F.col("_s") * beta)).scalar()
        soft = s.agg((F.log(F.avg(F.exp(F.col("_s") * beta - top))) + F.max(F.col("_s") * beta)) / beta).scalar()
    return s.withColumn("seq_level_rewards", F.col("_s") - soft).drop("_s")


def preference_mask(df: DataFrame) -> DataFrame:
    """Adds ``chosen``: the better of each pair of neighbouring rows (0,1), (2,3)...; a tie goes to the first; an odd batch raises."""
    w = W.partitionBy(F.floor(F.col("_row") / 2))
    s = df.withColumn("_s", t.masked_sum("rewards", "mask")).withColumns({"_n": F.count("*").over(w), "_rk": F.row_number().over(w.orderBy(F.col("_s").desc(), "_row"))})
    chosen = F.when(F.col("_n") != 2, F.raise_error(F.lit("pairs need an even batch")).cast("boolean")).otherwise(F.col("_rk") == 1)
    return s.withColumn("chosen", chosen).drop("_s", "_n", "_rk")


def kl_penalised(df: DataFrame, beta: float, kind: str = "kl", logp: str = "old_logp", ref: str = "ref_logp") -> DataFrame:
    """``rewards`` less beta times the masked KL per token; adds ``_kl`` = masked mean KL of the row."""
    k = t.masked(t.kl(logp, ref, kind), "mask")
    out = df.withColumn("_k", k).withColumn("rewards", F.zip_with("rewards", "_k", lambda r, x: r - beta * x))
    return out.withColumn("_kl", t.total("_k") / (t.total("mask") + 1e-8)).drop("_k")


class FixedKL:
    def __init__(self, value: float):
        self.value = value

    def update(self, current: float, n_steps: int) -> None:
        pass


class AdaptiveKL(FixedKL):
    """``value *= 1 + clip(kl / target - 1, -0.2, 0.2) * n_steps / horizon``."""

    def __init__(self, value: float, target: float, horizon: int):
        super().__init__(value)
        self.target, self.horizon = target, horizon

    def update(self, current: float, n_steps: int) -> None:
        error = min(max(current / self.target - 1, -0.2), 0.2)
        self.value *= 1 + error * n_steps / self.horizon


def cumulative_norm(df: DataFrame, column: str = "rewards") -> DataFrame:
    """Divides by the batch's greatest absolute reverse running sum (+1e-6)."""
    top = df.agg(F.max(F.array_max(F.transform(t.reverse_cumsum(column), lambda x: F.abs(x))))).scalar()
    return df.withColumn("_top", top).withColumn(column, F.transform(column, lambda x: x / (F.col("_top") + 1e-6))).drop("_top")


def expand_to_tokens(score: Column, position_ids: str, attention: str, length: int | Column) -> Column:
    """The score at the place of the greatest position * mask; the last ``length`` places are kept."""
    p = F.zip_with(position_ids, attention, lambda a, m: a * m)
    at = F.array_position(p, F.array_max(p)) - 1
    full = F.transform(p, lambda x, i: F.when(i == at, score.cast("double")).otherwise(0.0))
    return F.slice(full, F.size(full) - length + 1, length)


def overlong_penalty(length: Column, most: int, buffer: int, factor: float) -> Column:
    return F.least(-(length - (most - buffer)) / buffer * factor, F.lit(0.0))
