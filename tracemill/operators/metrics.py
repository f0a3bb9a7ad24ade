"""Metrics of batches, validation runs, experiments and latency logs."""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.functions import tokens as t
from tracemill.session import by_key, ship_by_value

ship_by_value(sys.modules[__name__])


def batch_metrics(b: DataFrame, max_length: int) -> DataFrame:
    """One row: score, length, advantage and value statistics over rows and valid tokens."""
    r6 = lambda c, name: F.round(c, 6).alias(name)
    n = t.total("mask")
    rows = b.select(t.total("rewards").alias("s"), n.alias("n")).agg(
        r6(F.avg("s"), "score_mean"), r6(F.max("s"), "score_max"), r6(F.min("s"), "score_min"), r6(F.avg("n"), "length_mean"), F.max("n").alias("length_max"), F.min("n").alias("length_min"),
        r6(F.avg((F.col("n") == max_length).cast("int")), "clip_ratio"),
    )
    z = F.arrays_zip(F.col("advantages").alias("a"), F.col("values").alias("v"), F.col("rewards").alias("r"), F.col("mask").alias("m"))
    valid = b.select(F.explode(z).alias("z")).select("z.*").filter("m > 0")
    toks = valid.agg(
        (F.round(F.avg("a"), 6) + 0.0).alias("adv_mean"), (F.round(F.max("a"), 6) + 0.0).alias("adv_max"), (F.round(F.min("a"), 6) + 0.0).alias("adv_min"), r6(F.avg("v"), "values_mean"),
        r6(1 - F.var_samp(F.col("r") - F.col("v")) / (F.var_samp("r") + 1e-5), "explained_var"),
    )
    one = lambda df: df.select(F.struct("*").alias("s")).scalar()
    return rows.withColumn("s", one(toks)).select("*", "s.*").drop("s")


def prob_diff(b: DataFrame, actor: str = "old_logp", rollout: str = "rollout_logp") -> DataFrame:
    z = F.arrays_zip(F.col(actor).alias("a"), F.col(rollout).alias("b"), F.col("mask").alias("m"))
    d = b.select(F.explode(z).alias("z")).filter("z.m > 0").select(F.abs(F.exp("z.a") - F.exp("z.b")).alias("d"))
    return d.agg(F.max("d").alias("diff_max"), F.avg("d").alias("diff_mean"), F.stddev_samp("d").alias("diff_std"))


def reduce_by_name(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Names with ``max`` take the maximum, else those with ``min`` the minimum, else the mean."""
    k = F.col(key)
    picked = F.when(k.contains("max"), F.max(value)).when(k.contains("min"), F.min(value)).otherwise(F.avg(value))
    return df.groupBy(key).agg(picked.alias(value))


def timing(timings: DataFrame, n_prompt: int, n_response: int) -> DataFrame:
    """Seconds by name with milliseconds per token; ``gen`` counts only response tokens."""
    n = F.when(F.col("name") == "gen", F.lit(n_response)).otherwise(F.lit(n_prompt + n_response))
    per = F.when(F.col("name").isin("ref", "values", "adv", "update_critic", "update_actor", "gen"), F.col("seconds") * 1000 / n)
    return timings.select("name", "seconds", per.alias("ms_per_token"))


def throughput(total_tokens: Column, seconds: Column, n_gpus: int) -> Column:
    return total_tokens / (seconds * n_gpus)


#: Places of a draw block, and of draws that are kept for other lists of the same length.
BLOCK, KEPT_PLACES = 1_000_000, 200_000


@functools.lru_cache(maxsize=256)
def draw_places(n: int, size: int, draws: int, seed: int) -> np.ndarray:
    """Places of each draw with replacement, by the legacy generator; the same for all lists of n values."""
    return np.random.RandomState(seed).randint(0, n, size=(draws, size))


def place_blocks(n: int, size: int, draws: int, seed: int) -> Iterator[np.ndarray]:
    """The rows of :func:`draw_places`, about BLOCK places at a time, so that memory grows with n alone.

    Drawing many rows at once gives the places that one call of ``choice`` after the other does.
    """
    if size * draws <= KEPT_PLACES:
        yield draw_places(n, size, draws, seed)
        return
    rng, step = np.random.RandomState(seed), max(BLOCK // size, 1)
    for a in range(0, draws, step):
        yield rng.randint(0, n, size=(min(step, draws - a), size))


def bootstrap(values: Sequence, size: int, reducers: Sequence[Callable], draws: int = 1000, seed: int = 42) -> list[tuple[float, float]]:
    """(mean, population std) of each reducer over draws with replacement."""
    if not len(values):
        raise ValueError("no values to draw from")
    reduced: list[list] = [[] for _ in reducers]
    for places in place_blocks(len(values), size, draws, seed):
        for f, out in zip(reducers, reduced):
            if f in (max, min):
                out.extend((np.max if f is max else np.min)(np.asarray(values)[places], axis=1))
            else:
                out.extend(f([values[i] for i in row]) for row in places)
    return [(float(np.mean(out)), float(np.std(out))) for out in reduced]


def bootstrap_majority(votes: Sequence, values: Sequence[float], size: int, draws: int = 1000, seed: int = 42) -> tuple[float, float]:
    """What :func:`bootstrap` gives for :func:`majority`, by counting the votes of many draws at once."""
    codes, names = pd.factorize(np.asarray(votes, dtype=object))
    of, n_votes, out = np.asarray(values, dtype=np.float64), len(names), []
    for block in place_blocks(len(of), size, draws, seed):
        step = max(BLOCK // (n_votes + size), 1)
        for a in range(0, len(block), step):
            places = block[a : a + step]
            row = np.arange(len(places))[:, None]
            drawn = codes[places]
            counts = np.bincount((row * n_votes + drawn).ravel(), minlength=len(places) * n_votes).reshape(-1, n_votes)
            # the first place whose vote is as frequent as any
            first = (counts[row, drawn] == counts.max(axis=1)[:, None]).argmax(axis=1)
            out.extend(of[places[row[:, 0], first]])
    return float(np.mean(out)), float(np.std(out))


def majority(pairs: Sequence[tuple[object, float]]) -> float:
    """The first value of the most frequent vote; of equally frequent ones the first seen."""
    counts: dict = {}
    first: dict = {}
    for vote, value in pairs:
        counts[vote] = counts.get(vote, 0) + 1
        first.setdefault(vote, value)
    return first[max(counts, key=lambda v: counts[v])]


def majority_value(df: DataFrame, group: Sequence[str], vote: str, value: str, order: str) -> DataFrame:
    """``group..., value`` by :func:`majority`, as two aggregations."""
    per = df.groupBy(*group, vote).agg(F.count("*").alias("n"), F.min(F.struct(order, value)).alias("f"))
    return per.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("f"))).alias("b")).select(*group, F.col(f"b.f.{value}").alias(value))


def ks(n: int) -> list[int]:
    """2, 4, 8, ... below n, then n."""
    out, k = [], 2
    while k < n:
        out.append(k)
        k *= 2
    return [*out, n]


def prompt_metrics(values: Sequence[float], votes: Sequence | None = None, draws: int = 1000, seed: int = 42) -> dict[str, float]:
    """mean@N, std@N (population) and, for N > 1, best, worst and majority at each k."""
    n = len(values)
    out = {f"mean@{n}": float(np.mean(values))}
    if n > 1:
        out[f"std@{n}"] = float(np.std(values))
        for k in ks(n):
            (bm, bs), (wm, ws) = bootstrap(values, k, [max, min], draws, seed)
            out |= {f"best@{k}/mean": bm, f"best@{k}/std": bs, f"worst@{k}/mean": wm, f"worst@{k}/std": ws}
            if votes is not None:
                mm, ms = bootstrap_majority(votes, values, k, draws, seed)
                out |= {f"maj@{k}/mean": mm, f"maj@{k}/std": ms}
    return out


def validation(df: DataFrame, draws: int = 1000, seed: int = 42) -> DataFrame:
    """``source, var, metric, value``: the mean over prompts of each prompt's metrics.

    df: source, prompt, var, value (double), vote (string or null), order. A prompt's
    samples, of any number, are one group and one task's work: about 2 x draws places are
    drawn a sample, a block at a time.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        votes = pdf["vote"].tolist() if pdf["vote"].notna().all() else None
        m = prompt_metrics(pdf["value"].tolist(), votes, draws, seed)
        return pd.DataFrame({"source": pdf["source"].iloc[0], "var": pdf["var"].iloc[0], "metric": list(m), "value": list(m.values())})

    keyed = by_key(df.select("source", "prompt", "var", "value", "vote", "order"), "source", "prompt", "var")
    per = keyed.groupBy("source", "prompt", "var").applyInPandas(one, "source string, var string, metric string, value double")
    return per.groupBy("source", "var", "metric").agg(F.avg("value").alias("value"))


def validation_section(var: Column, metric: Column, n_max: int, core: str = "acc") -> Column:
    """``val-core`` for mean, maj or best of the core variable at the greatest N, else ``val-aux``."""
    at_max = metric.contains(f"@{n_max}") & (metric.startswith("mean") | metric.startswith("maj") | metric.startswith("best"))
    return F.when((var == core) & at_max, "val-core").otherwise("val-aux")


def mean_of_means(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """Mean per inner group, then mean of these per outer group."""
    return df.groupBy(outer, inner).agg(F.avg(value).alias(value)).groupBy(outer).agg(F.avg(value).alias(value))


def domain_rates(df: DataFrame, domain: str = "domain", reward: str = "reward") -> DataFrame:
    """Runs, successes and rate per domain and in total (domain null); negative rewards are skipped."""
    ok = df.filter(F.col(reward) >= 0)
    rolled = ok.rollup(domain).agg(F.count("*").alias("n_runs"), F.sum(reward).alias("success"), F.grouping(domain).alias("is_total"))
    return rolled.withColumn("rate", F.when(F.col("n_runs") > 0, F.col("success") / F.col("n_runs")).otherwise(0.0))


def experiment_summary(df: DataFrame, experiment: str, task: str, reward: str) -> DataFrame:
    """Mean reward, mean of per-task means and share of tasks solved at least once, per experiment."""
    per = df.groupBy(experiment, task).agg(F.sum(reward).alias("s"), F.count(reward).alias("n"), F.max(reward).alias("best"))
    return per.groupBy(experiment).agg((F.sum("s") / F.sum("n")).alias("mean_reward"), F.avg(F.col("s") / F.col("n")).alias("mean_task_reward"), F.avg("best").alias("any_correct"), F.count("*").alias("n_tasks"))


def task_statistics(df: DataFrame, task: str, steps: str, success: Column, run: str) -> DataFrame:
    good = F.when(success, F.col(steps))
    return df.groupBy(task).agg(
        F.count("*").alias("n"), F.avg(steps).alias("steps_mean"), F.stddev_pop(steps).alias("steps_std"), F.min(steps).alias("steps_min"), F.max(steps).alias("steps_max"),
        F.avg(success.cast("int")).alias("success_rate"), F.avg(good).alias("success_steps_mean"), F.countDistinct(run).alias("n_runs"),
    )


def latency(df: DataFrame, *parts: str) -> tuple[DataFrame, DataFrame]:
    """(overall means, means per step), rounded to 4 places."""
    means = [F.round(F.avg(c), 4).alias(c) for c in parts]
    return df.agg(F.count("*").alias("n"), *means), df.groupBy("step").agg(F.count("*").alias("n"), *means)


def rate(ok: Column, total: Column) -> Column:
    """ok / total, 0 for none."""
    return F.when(total > 0, ok / total).otherwise(F.lit(0.0))


def pair_accuracy(df: DataFrame, group: Column, score: str, acc: str, position: str) -> DataFrame:
    """Mean over groups of the pairwise accuracy, weighted by the difference of acc; 0.5 where all acc are equal.

    Pairs (i < j) are formed inside a group, whose size is the number of samples
    per prompt.
    """
    g = df.select(group.alias("g"), F.struct(F.col(position).alias("p"), F.col(score).alias("s"), F.col(acc).alias("a")).alias("x")).groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("l"))

    def against(x, i):
        rest = F.slice("l", i + 2, F.size("l"))
        d = lambda y: F.abs(x["a"] - y["a"])
        right = F.aggregate(rest, F.lit(0.0), lambda s, y: s + F.when(((x["s"] - y["s"]) > 0) == ((x["a"] - y["a"]) > 0), d(y)).otherwise(0.0))
        return F.struct(right.alias("ok"), F.aggregate(rest, F.lit(0.0), lambda s, y: s + d(y)).alias("w"))

    per = g.select(F.transform("l", against).alias("c")).select(F.aggregate("c", F.lit(0.0), lambda s, x: s + x["ok"]).alias("ok"), F.aggregate("c", F.lit(0.0), lambda s, x: s + x["w"]).alias("w"))
    return per.agg(F.avg(F.when(F.col("w") == 0, 0.5).otherwise(F.col("ok") / F.nullif(F.col("w"), F.lit(0.0)))).alias("dpo_acc"))


def absolute_accuracy(score: Column, acc: Column) -> Column:
    return F.avg((F.signum(score) == F.signum(acc * 2 - 1)).cast("int"))


def imbalance(df: DataFrame, part: str, length: str, batch: str | None = None, k: int | None = None) -> DataFrame:
    """min, max, max - min and mean of the parts' summed lengths, of each batch if one is named.

    Of k parts, those without a row sum to 0.
    """
    by = [batch] if batch else []
    s = df.groupBy(*by, part).agg(F.sum(length).alias("s"))
    low, mean = (F.min("s"), F.avg("s")) if k is None else (F.when(F.count("*") < k, F.least(F.min("s"), F.lit(0))).otherwise(F.min("s")), F.sum("s") / k)
    return s.groupBy(*by).agg(low.alias("min"), F.max("s").alias("max"), (F.max("s") - low).alias("minmax_diff"), mean.alias("mean"))


def category_rates(df: DataFrame, categories: dict[str, str], domain: str = "domain", reward: str = "reward") -> DataFrame:
    """Success in percent per category of domains; categories without runs have 0."""
    kinds = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    per = df.withColumn("category", F.element_at(kinds, F.col(domain))).filter("category is not null").groupBy("category").agg(F.sum(reward).alias("s"), F.count(reward).alias("n_runs"))
    names = df.sparkSession.createDataFrame([(c,) for c in sorted(set(categories.values()))], "category string")
    full = F.broadcast(names).join(per, "category", "left")
    return full.select("category", F.coalesce("n_runs", F.lit(0)).alias("n_runs"), (F.coalesce("s", F.lit(0.0)) / F.greatest(F.coalesce("n_runs", F.lit(0)), F.lit(1)) * 100).alias("success_percent"))


def done_rates(lines: DataFrame, domain: str, example: str, done: str) -> DataFrame:
    """An example succeeds if any of its log lines says done; rate per domain."""
    per = lines.groupBy(domain, example).agg(F.bool_or(F.coalesce(F.col(done), F.lit(False))).alias("ok"))
    return per.groupBy(domain).agg(F.count("*").alias("n"), F.count_if("ok").alias("n_done"), F.avg(F.col("ok").cast("int")).alias("rate"))


def best_reward(lines: DataFrame, text: str, pattern: str = r"reward[:=]\s*(-?\d+(?:\.\d+)?)") -> DataFrame:
    """The greatest reward that any log line names."""
    return lines.agg(F.max(F.regexp_extract(text, pattern, 1).try_cast("double")).alias("best_reward"))


def preference_metrics(df: DataFrame, score: str, length: str, chosen: str, logp: str) -> DataFrame:
    """Score and length statistics, and mean log-probabilities of chosen and rejected rows."""
    c = F.col(chosen)
    return df.agg(
        F.avg(score).alias("score_mean"), F.max(score).alias("score_max"), F.min(score).alias("score_min"), F.avg(length).alias("length_mean"), F.max(length).alias("length_max"),
        F.min(length).alias("length_min"), F.avg(F.when(c, F.col(logp))).alias("chosen_logps"), F.avg(F.when(~c, F.col(logp))).alias("rejected_logps"),
    )


def spread(df: DataFrame, value: str) -> DataFrame:
    """mean, max, min and population std over all rows of all partitions."""
    return df.agg(F.avg(value).alias("mean"), F.max(value).alias("max"), F.min(value).alias("min"), F.stddev_pop(value).alias("std"))


def regressions(df: DataFrame, run: str, task: str, reward: str, order: str) -> DataFrame:
    """``task, run_a, run_b``: tasks whose last row was solved in one run and failed in a later one."""
    last = df.filter(F.col(reward).isNotNull()).groupBy(run, task).agg(F.max_by(reward, order).alias("_r"))
    a, b = last.filter("_r = 1").select(task, F.col(run).alias("run_a")), last.filter("_r = 0").select(task, F.col(run).alias("run_b"))
    return a.join(b, task).filter("run_a < run_b").select(task, "run_a", "run_b")


def rates_compared(a: DataFrame, b: DataFrame, domain: str, reward: str) -> DataFrame:
    """``domain, rate_a, rate_b, delta``: mean rewards of two sets per domain, 0 where a set has none."""
    per = lambda df, n: df.groupBy(domain).agg(F.avg(reward).alias(n))
    both = per(a, "rate_a").join(per(b, "rate_b"), domain, "full_outer").fillna(0.0, ["rate_a", "rate_b"])
    return both.withColumn("delta", F.col("rate_b") - F.col("rate_a"))


def group_sizes(df: DataFrame, group: str, member: str, name: str = "n_members") -> DataFrame:
    """``name, n_groups``: how many groups have how many different members."""
    return df.groupBy(group).agg(F.countDistinct(member).alias(name)).groupBy(name).agg(F.count("*").alias("n_groups"))


def composition(df: DataFrame, by: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(by).agg(F.count("*").alias("n"))


def merged(parts: DataFrame, n: str = "n", ok: str = "ok") -> DataFrame:
    """Totals and rate of workers' counts."""
    return parts.agg(F.sum(n).alias("n"), F.sum(ok).alias("ok")).withColumn("rate", rate(F.col("ok"), F.col("n")))


def listed(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``key, values``: each key's values as a list, in order."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("values"))


def rank_timings(df: DataFrame, name: str = "name", rank: str = "rank", seconds: str = "seconds") -> DataFrame:
    """Accumulated seconds per rank, then their mean over ranks."""
    return df.groupBy(name, rank).agg(F.sum(seconds).alias("s")).groupBy(name).agg(F.avg("s").alias("seconds"))


def judge_votes(df: DataFrame, trajectory: str, window: str, score: str) -> tuple[DataFrame, DataFrame]:
    """(mean score per window of images, mean over all completions per trajectory). Missing judgements stay null."""
    return df.groupBy(trajectory, window).agg(F.avg(score).alias("score")), df.groupBy(trajectory).agg(F.avg(score).alias("score"))
