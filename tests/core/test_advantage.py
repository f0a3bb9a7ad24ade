import numpy as np
import pytest
from pyspark.errors import PySparkException

from tracemill.functions import tokens as t
from tracemill.operators import advantage as adv
from tracemill.operators import loss
from tracemill.operators import metrics
from pyspark.sql import functions as F

ROWS = [
    (0, "a", [0.0, 0.0, 1.0], [1.0, 1.0, 1.0], [0.1, 0.2, 0.3]),
    (1, "a", [0.0, 0.5, 0.0], [1.0, 1.0, 0.0], [0.0, 0.1, 0.2]),
    (2, "a", [0.0, 1.0, 0.0], [1.0, 1.0, 0.0], [0.3, 0.1, 0.0]),
    (3, "b", [0.7, 0.0, 0.0], [1.0, 0.0, 0.0], [0.1, 0.1, 0.1]),
    (4, "c", [0.2, 0.0, 0.0], [1.0, 1.0, 1.0], [0.0, 0.0, 0.0]),
    (5, "c", [0.2, 0.0, 0.0], [1.0, 1.0, 1.0], [0.0, 0.0, 0.0]),
]


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(ROWS, "_row long, uid string, rewards array<double>, mask array<double>, values array<double>").cache()


def out(df, c="advantages"):
    return np.array([r[c] for r in df.orderBy("_row").collect()])


R, M, V = (np.array([r[i] for r in ROWS]) for i in (2, 3, 4))
S, UID = R.sum(1), [r[1] for r in ROWS]


def groups(f):
    return np.array([f(i, [j for j in range(len(UID)) if UID[j] == UID[i]]) for i in range(len(UID))])


def white(x):
    mean = (x * M).sum() / (M.sum() + 1e-8)
    var = ((x - mean) ** 2 * M).sum() / (M.sum() + 1e-8) * M.sum() / (M.sum() - 1)
    return (x - mean) / np.sqrt(var + 1e-8)


def test_group_estimators(batch):
    grpo = groups(lambda i, g: S[i] / (1 + 1e-6) if len(g) == 1 else (S[i] - S[g].mean()) / (S[g].std(ddof=1) + 1e-6))
    assert np.allclose(out(adv.grpo(batch)), grpo[:, None] * M)
    rloo = groups(lambda i, g: S[i] if len(g) == 1 else S[i] * len(g) / (len(g) - 1) - S[g].mean() * len(g) / (len(g) - 1))
    assert np.allclose(out(adv.rloo(batch)), rloo[:, None] * M)
    n = M.sum(1)
    opo = groups(lambda i, g: S[i] if len(g) == 1 else S[i] - (n[g] * S[g]).sum() / n[g].sum())
    assert np.allclose(out(adv.opo(batch)), opo[:, None] * M)
    base = groups(lambda i, g: S[i] - (0 if len(g) == 1 else S[g].mean()))[:, None] * M
    assert np.allclose(out(adv.reinforce_pp_baseline(batch)), white(base) * M)


def test_passk(batch):
    got = out(adv.grpo_passk(batch.filter("uid <> 'b'")))
    sd = S[:3].std(ddof=1)
    assert np.allclose(got[:3, 0], [0, 0, 0]) and sd > 0  # rows 0 and 2 tie, so the gap is 0
    with pytest.raises(PySparkException, match="two or more"):
        adv.grpo_passk(batch).collect()


def test_recurrences(batch):
    a = np.zeros_like(R)
    last = np.zeros(len(R))
    for i in (2, 1, 0):
        nxt = V[:, i + 1] if i < 2 else 0
        last = R[:, i] + 0.9 * nxt - V[:, i] + 0.9 * 0.8 * last
        a[:, i] = last
    got = adv.gae(batch, 0.9, 0.8)
    assert np.allclose(out(got), white(a)) and np.allclose(out(got, "returns"), a + V)
    g, run = np.zeros_like(R), np.zeros(len(R))
    for i in (2, 1, 0):
        run = R[:, i] + 0.5 * run
        g[:, i] = run
        run = run * M[:, i]
    got = adv.reinforce_pp(batch, 0.5)
    assert np.allclose(out(got, "returns"), g) and np.allclose(out(got), white(g) * M)
    rev = np.cumsum((R * M)[:, ::-1], 1)[:, ::-1]
    assert np.allclose(out(adv.remax(batch.withColumn("baseline", F.lit(0.1)))), rev - 0.1 * M)


def test_registries():
    with pytest.raises(ValueError):
        adv.register("gae")(lambda df: df)
    with pytest.raises(ValueError):
        loss.register("ppo")(lambda df: df)
    with pytest.raises(ValueError):
        adv.compute(None, "GAE")


def test_eos_and_padding(spark):
    rows = [([5, 1, 3, 1],), ([1, 2, 2, 2],), ([4, 4, 4, 4],), ([3, 2, 1, 0],)]
    df = spark.createDataFrame(rows, "t array<int>")
    assert [r[0] for r in df.select(t.eos_mask("t", 1)).collect()] == [[1, 1, 0, 0], [1, 0, 0, 0], [1, 1, 1, 1], [1, 1, 1, 0]]
    assert [r[0] for r in df.select(t.eos_mask("t", 1, 2)).collect()] == [[1, 1, 0, 0], [1, 0, 0, 0], [1, 1, 1, 1], [1, 1, 0, 0]]
    empty = spark.createDataFrame([([],), ([7],)], "t array<int>")
    assert [r[0] for r in empty.select(t.pad("t", 2, 0)).collect()] == [[0, 0], [7, 0]]
    assert [r[0] for r in empty.select(t.subsequence_positions("t", F.array(F.lit(7)))).collect()] == [[], [0]]
    assert [r[0] for r in empty.select(t.discounted("t", 1.0)).collect()] == [[], [7.0]]


def test_controllers():
    k = adv.AdaptiveKL(0.2, 6.0, 10000)
    k.update(12.0, 256)
    assert np.isclose(k.value, 0.2 * (1 + 0.2 * 256 / 10000))
    f = adv.FixedKL(0.1)
    f.update(9, 9)
    assert f.value == 0.1


def test_bootstrap_and_majority():
    [(mean, std), (top, _)] = metrics.bootstrap([1, 2, 3, 4, 5], 3, [np.mean, np.max], 100, 42)
    assert abs(mean - 3) < 0.3 and 3.5 < top < 5
    with pytest.raises(ValueError):
        metrics.bootstrap([], 3, [np.mean])
    assert metrics.majority([("A", 0.9), ("B", 0.8), ("A", 0.7)]) == 0.9
    assert metrics.majority([("A", 0.9), ("B", 0.8)]) == 0.9
    assert metrics.prompt_metrics([0.8, 0.9])["mean@2"] == pytest.approx(0.85)
    assert metrics.ks(10) == [2, 4, 8, 10] and metrics.ks(8) == [2, 4, 8]


def test_reduce_by_name(spark):
    rows = [("loss", x) for x in (1.0, 2.0, 3.0)] + [("accuracy", x) for x in (0.8, 0.9, 0.7)] + [("max_reward", x) for x in (5.0, 8.0, 6.0)] + [("min_error", x) for x in (0.1, 0.05, 0.2)]
    got = {r.key: r.value for r in metrics.reduce_by_name(spark.createDataFrame(rows, "key string, value double")).collect()}
    assert got == pytest.approx({"loss": 2.0, "accuracy": 0.8, "max_reward": 8.0, "min_error": 0.05})
