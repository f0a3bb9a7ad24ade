import random

import pytest
from pyspark.sql import functions as F

from tracemill.operators import merkle


def brute(cur, old):
    a, b = dict(cur), dict(old)
    return {(k, "added") for k in a if k not in b} | {(k, "removed") for k in b if k not in a} | {(k, "changed") for k in a if k in b and a[k] != b[k]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    val = lambda: (rng.choice([None, 0, 1, 2]), rng.choice([None, "x", "y"]))
    old = {rng.randint(-500, 40_000): val() for _ in range(700)}
    cur = {k: (val() if rng.random() < 0.1 else v) for k, v in old.items() if rng.random() > 0.05} | {rng.randint(-500, 60_000): val() for _ in range(30)}
    df = lambda d: merkle.records(spark.createDataFrame([(k, *v) for k, v in d.items()] + [(k, *v) for k, v in list(d.items())[:40]] + [(None, 1, "z")], "id long, used int, at string"), "id", ["used", "at"])
    assert {(r.k, r.change) for r in merkle.diff(df(cur), df(old)).collect()} == brute(cur.items(), old.items())
    assert merkle.diff(df(cur), df(cur)).count() == 0


def test_only_differing_leaves(spark):
    df = merkle.records(spark.range(10_000).select("id", (F.col("id") % 7).alias("v")), "id", ["v"])
    other = df.withColumn("v0", F.when(F.col("k") == 4711, 99).otherwise(F.col("v0")))
    leaves = merkle.changed_leaves(merkle.tree(df), merkle.tree(other)).collect()
    assert [r.node for r in leaves] == [4711 >> merkle.LEAF_BITS]


def scanned(df):
    """Rows that the scans of an executed plan gave out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif hasattr(p, "plan") and p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        elif p.getClass().getSimpleName() == "FileSourceScanExec" and "v0#" in p.toString():
            total += p.metrics().apply("numOutputRows").value()
        for i in range(p.children().size()):
            todo.append(p.children().apply(i))
    return total


def test_rows_read_fall_with_the_share_of_changed_ranges(spark, tmp_path):
    log = merkle.ChangeLog(spark, str(tmp_path / "state"), "id", ["v"])
    n = 400_000
    base = spark.range(n).select("id", (F.col("id") % 7).cast("int").alias("v"))
    log.run(base, lambda df: df.limit(0))
    edit = lambda share: base.withColumn("v", F.when(F.col("id") >= int(n * (1 - share)), 99).otherwise(F.col("v")))
    read = {}
    for share in (1.0, 0.02):
        changes = log.pending(edit(share))
        assert changes.count() == n - int(n * (1 - share))
        read[share] = scanned(changes)
    assert read[1.0] == 2 * n and read[0.02] < 0.6 * n
    assert log.pending(base).count() == 0 and scanned(log.pending(base)) == 0


def test_versions_that_nobody_needs_go(spark, tmp_path):
    log = merkle.ChangeLog(spark, str(tmp_path / "state"), "id", ["v"])
    for i in range(2):
        log.run(spark.range(5).select("id", F.lit(i).alias("v")), lambda df: df)
        log.pending(spark.range(3).select("id", F.lit(i).alias("v")))
    last = log.run(spark.range(5).select("id", F.lit(9).alias("v")), lambda df: df)
    assert len(log._versions()) == 2 and log.version() == last


def test_differing_rows_of_a_key_are_one_whole_row(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, None, "c")], "id long, used int, at string")
    (r,) = merkle.records(df, "id", ["used", "at"]).collect()
    assert (r.v0, r.v1) in {(1, "b"), (2, "a"), (None, "c")}
    assert merkle.key_ranges(spark.createDataFrame([(0,), (1,), (9,)], "node long"), 6) == [(0, 127), (576, 639)]
    assert merkle.key_ranges(spark.createDataFrame([], "node long")) == []


def test_trees_of_other_heights(spark):
    low = merkle.records(spark.range(100).select("id", F.lit(1).alias("v")), "id", ["v"])
    high = low.unionByName(low.filter("k = 5").withColumn("k", F.lit(10**12).cast("long")))
    assert len(merkle.tree(high)) > len(merkle.tree(low))
    assert [(r.k, r.change) for r in merkle.diff(high, low).collect()] == [(10**12, "added")]


def test_empty_tables(spark):
    df = merkle.records(spark.range(5).select("id", F.lit(1).alias("v")), "id", ["v"])
    none = df.limit(0)
    assert {r.change for r in merkle.diff(df, none).collect()} == {"added"}
    assert {r.change for r in merkle.diff(none, df).collect()} == {"removed"}
    assert merkle.diff(none, none).count() == 0


def test_change_log_survives_failures(spark, tmp_path):
    log = merkle.ChangeLog(spark, str(tmp_path / "state"), "id", ["used"])
    (tmp_path / "state").mkdir()
    first = spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (2, 0, "b")], "id long, used int, k string")
    log.run(first, lambda df: df)
    assert sorted(r.id for r in log.output().distinct().collect()) == [1, 2]
    second = spark.createDataFrame([(1, 0, "a"), (2, 1, "b"), (3, 0, "c")], "id long, used int, k string")

    def fails(df):
        df.count()
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        log.run(second, fails)
    assert sorted(r.id for r in log.output().distinct().collect()) == [1, 2]  # nothing was published
    assert {(r.k, r.change) for r in log.pending(second).collect()} == {(2, "changed"), (3, "added")}
    log.run(second, lambda df: df)
    assert sorted(r.id for r in log.output().collect()) == [2, 3]
    log.run(second, lambda df: df)
    assert log.output().count() == 0


def test_only_successful_runs_count(spark):
    seen = spark.createDataFrame([(1, 7, 0), (2, 7, 5), (3, 7, 9), (1, 8, None)], "sync_no int, rollout_id long, used int").withColumn("create_at", F.lit(None).cast("timestamp_ntz"))
    runs = spark.createDataFrame([(1, "COMPLETED"), (2, "COMPLETED"), (3, "FAILED"), (4, None)], "sync_no int, status string")
    assert {r.k: r.v0 for r in merkle.last_seen(seen, runs).collect()} == {7: 5, 8: None}
