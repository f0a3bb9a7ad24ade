"""Validation metrics on real prompts, against the plain bootstrap."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracemill.operators import metrics
from tracemill.plans import core
from tracemill.plans.adapters import catalog

DATA = "/root/testdata/sf0.001"


def plain(data, size, reduce, draws=1000):
    """One draw after the other by the legacy generator."""
    rng = np.random.RandomState(42)
    out = [reduce([data[i] for i in rng.choice(len(data), size=size, replace=True)]) for _ in range(draws)]
    return np.mean(out), np.std(out)


def test_query_has_1000_draws_of_the_rollouts_of_a_task(spark):
    prompts = defaultdict(list)
    for r in catalog(spark, DATA).filter("reward is not null").orderBy("id").collect():
        prompts[r.run_id, r.task_id].append(r.reward)
    want = defaultdict(list)
    for values in prompts.values():
        n = len(values)
        want[f"mean@{n}"].append(np.mean(values))
        if n > 1:
            want[f"std@{n}"].append(np.std(values))
            pairs = [(str(v), v) for v in values]
            for k in metrics.ks(n):
                for name, data, f in [("best", values, max), ("worst", values, min), ("maj", pairs, metrics.majority)]:
                    mean, std = plain(data, k, f)
                    want[f"{name}@{k}/mean"].append(mean)
                    want[f"{name}@{k}/std"].append(std)
    got = {r.metric: r.value for r in core().runs["validation_metrics"](spark, DATA).collect()}
    assert got == pytest.approx({m: np.mean(v) for m, v in want.items()}, abs=1e-9)


def test_majority_of_many_draws_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    votes, values = rng.integers(0, 4, 37).astype(str).tolist(), rng.random(37).round(3).tolist()
    for block, kept in [(metrics.BLOCK, metrics.KEPT_PLACES), (100, 0)]:
        monkeypatch.setattr(metrics, "BLOCK", block)
        monkeypatch.setattr(metrics, "KEPT_PLACES", kept)
        for k in (1, 2, 16, 37):
            assert metrics.bootstrap_majority(votes, values, k) == pytest.approx(plain(list(zip(votes, values)), k, metrics.majority))
            assert metrics.bootstrap(values, k, [max, min]) == [pytest.approx(plain(values, k, f)) for f in (max, min)]


def test_prompt_of_many_samples(spark):
    df = spark.range(5000).select(F.lit("s").alias("source"), F.lit("p").alias("prompt"), F.lit("acc").alias("var"), (F.col("id") % 3).cast("double").alias("value"), (F.col("id") % 3).cast("string").alias("vote"), F.col("id").alias("order"))
    got = {r.metric: r.value for r in metrics.validation(df, draws=20).collect()}
    values = [float(i % 3) for i in range(5000)]
    assert got["mean@5000"] == pytest.approx(np.mean(values)) and got["best@2/mean"] == pytest.approx(plain(values, 2, max, 20)[0])
    assert got["maj@4096/mean"] == pytest.approx(plain([(str(int(v)), v) for v in values], 4096, metrics.majority, 20)[0])
