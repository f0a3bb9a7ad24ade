import random

import pytest
from pyspark.sql import functions as F

from tracemill.functions import actions, mathscore
from tracemill.operators import balance, catalog, curation
from tracemill.operators import trajectory as tr

CAT = "id long, run_id string, task_id string, model_version string, used int, reward double, create_at int"


def rows(spark, data):
    return spark.createDataFrame(data, CAT)


def test_priority_fixture(spark):
    df = rows(spark, [(1, "r", "t", "v1", 0, 0.8, 1), (2, "r", "t", "v2", 1, 0.9, 2), (3, "r", "t", "v2", 0, 0.7, 3), (4, "r", "t", "v1", 2, 0.95, 4)])
    assert [r.id for r in catalog.top_per_task(df, 4).orderBy("rank").collect()] == [3, 2, 1, 4]


def test_versions_are_numeric(spark):
    df = spark.createDataFrame([(1, "v2", "train"), (2, "v10", "train"), (3, "final", "train"), (4, "v99", "manual")], "id long, version string, source string")
    assert [r.version for r in catalog.latest_checkpoints(df, 2).collect()] == ["v99", "v10"]
    assert catalog.next_version(df).first()[0] == "v11" and catalog.next_version(df.limit(0)).first()[0] == "v0"


def test_replacement_and_trim(spark):
    zero = [(i, "r", "z", "v1", 0, 0.0, i) for i in range(4)]
    df = rows(spark, zero + [(9, "r", "z", "v0", 3, 1.0, 0), (10, "r", "q", "v1", 0, 0.0, 1), (11, "r", "q", "v1", 0, 0.0, 2)])
    versions = spark.createDataFrame([("v1",)], "model_version string")
    assert sorted(r.id for r in curation.trainable(df, versions, per_task=2).filter("task_id = 'z'").collect())[-1] == 9
    assert curation.trainable(df, versions.limit(0), per_task=2).count() == 0
    assert curation.trainable(df, versions, per_task=2).filter("task_id = 'q'").count() == 0
    big = rows(spark, [(i, "r", "t", "v1", 0, 1.0 if i == 7 else 0.0, i) for i in range(12)])
    for seed in range(5):
        kept = curation.trim_random(big, 3, seed, F.col("reward") > 0).collect()
        assert len(kept) == 3 and 7 in {r.id for r in kept}
    assert sorted(r.id for r in curation.trim_newest(big, 3, F.col("reward") == 1).collect()) == [7, 10, 11]


def test_resample_keeps_the_count_and_follows_weights(spark):
    df = spark.range(400).select(F.col("id").alias("_row"), F.when(F.col("id") < 40, 3.0).otherwise(1.0).alias("s"))
    got = curation.resample(df, "s")
    assert abs(got.count() - 400) <= 1
    share = got.filter("source_row < 40").count() / got.count()
    assert abs(share - 40 * 9 / (40 * 9 + 360)) < 0.02


def test_uniqueness_and_usage(spark):
    df = spark.createDataFrame([("r", "a", 1), ("r", "b", None)], "run_id string, trajectory_id string, used int")
    with pytest.raises(Exception, match="duplicate key"):
        catalog.insert(df, df.limit(1)).collect()
    used = {r.trajectory_id: r.used for r in catalog.add_usage(df, spark.createDataFrame([("r", "b"), ("r", "b"), ("r", "zz")], "run_id string, trajectory_id string")).collect()}
    assert used == {"a": 1, "b": 2}


@pytest.mark.parametrize("seed", range(4))
def test_partitions(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 500) for _ in range(64)]
    kk = balance.balanced(lengths, 8)
    sums = [sum(lengths[i] for i in p) for p in kk]
    assert {len(p) for p in kk} == {8} and max(sums) - min(sums) <= 60
    free = balance.balanced(lengths, 8, equal_size=False)
    sums = [sum(lengths[i] for i in p) for p in free]
    assert max(sums) - min(sums) <= 60
    assert balance.balanced(lengths, 8, method="greedy")
    order = [i for p in free for i in p]
    back = balance.reverse_index(order)
    assert [order[b] for b in back] == list(range(64))
    assert balance.n_micro_batches([10, 10, 10], 15, multiple=2) == 2
    with pytest.raises(ValueError):
        balance.n_micro_batches([20], 10)
    with pytest.raises(ValueError):
        balance.balanced([1, 2, 3], 2)


def test_boxes_and_answers():
    assert mathscore.last_boxed(r"a \boxed{1} b \boxed{\frac{1}{2}}") == r"\boxed{\frac{1}{2}}"
    assert mathscore.last_boxed("none") is None and mathscore.last_boxed(r"\boxed{open") is None
    assert mathscore.equivalent(r"\tfrac12", "1/2") and mathscore.equivalent("x=0.5", r"\dfrac{1}{2}")
    assert mathscore.equivalent(r"\sqrt3", r"\sqrt{3}") and not mathscore.equivalent("3", "4")
    assert mathscore.final_answer(r"x = \text{12,000} dollars") == "12000"
    assert mathscore.minerva("Answer: 4\nAnswer: 5", "5") == (True, "5")
    assert mathscore.strict_box(r"so \boxed{7}", "7") == (1, "7")
    assert mathscore.math_equal("50%", "0.5") and mathscore.math_equal("[1, 2]", "[1,2.0]") and not mathscore.math_equal("(1, 2)", "[1,2]")
    assert mathscore.grade("1,000", "1000") and mathscore.grade("(1, 2)", "(1,2)") and not mathscore.grade("2/4", "1/2")
    assert mathscore.repetitive("ab" * 50) and not mathscore.repetitive("The quick brown fox") and not mathscore.repetitive("")
    assert mathscore.boxed_report(r"\boxed{3}", ["2", "3"])["acc"] and mathscore.boxed_report("none", ["1"])["format_score"] == 0.0
    assert mathscore.math_score(None, "1") == 0.0 and mathscore.prime_score(r"\boxed{3}", None) == 0.0


def test_actions():
    got = actions.structured("Reflection: bad Action_Summary: retry\nAction: click(start_box='(100,200)')\n\ntype(content='it's')")
    assert [g["action_type"] for g in got] == ["click", "type"] and got[0]["reflection"] == "bad" and got[0]["thought"] == "retry"
    assert "0.1, 0.2, 0.1, 0.2" in got[0]["action_inputs"]
    assert actions.parse_call("__import__('os').system('x')")["function"] == "system"  # read, never run
    assert actions.parse_call("1 +") is None and actions.parse_call(None) is None
    assert actions.to_code("click", {"start_box": "[0.5, 0.5, 0.5, 0.5]"}, 100, 200) == "pyautogui.click(50.0, 100.0, button='left')"


def test_log_spaced(spark):
    df = spark.createDataFrame([(0,), (3,), (5,), (6,), (20,), (100,)], "n int")
    got = {r.n: r.k for r in df.select("n", tr.log_spaced(F.col("n"), 5).alias("k")).collect()}
    assert got[0] == [] and got[3] == [0, 1, 2] and len(got[6]) == 5 and len(got[20]) == 5 and got[100][-1] == 99 and got[100][0] == 0
