"""Feed loop, dispatch, reward managers, scripts, loaders and other operators against small expected results."""

import json

import pytest
from pyspark.sql import functions as F

from tracemill.functions import actions, mathscore
from tracemill.operators import advantage, batch, catalog, curation, dispatch, loss, reward
from tracemill.sources import readers, recipes, writers
from tracemill.streaming import monitor

ROLLOUT = "id long, task_id string, reward double, used int, create_at int"


def test_feed_rotates_waits_and_keeps_the_rest(spark, tmp_path):
    src, now = tmp_path / "in", [0.0]

    def drop(name, rows):
        spark.createDataFrame(rows, ROLLOUT).coalesce(1).write.mode("append").parquet(str(src / name))
        stream = readers.catalog_stream(spark, str(src), ROLLOUT, 100)
        monitor.feed(stream, str(tmp_path / "out"), lambda df: df, 2, 1, str(tmp_path / "cp"), 2, True, 10.0, lambda: now[0]).awaitTermination()

    def got(no):
        path = tmp_path / f"out/batches/batch={no}"
        return [r.task_id for r in spark.read.parquet(str(path)).orderBy("place").collect()] if path.exists() else None

    drop("a", [(1, "a", 0.0, 0, 1), (2, "b", 0.0, 0, 2), (3, "c", 0.0, 0, 3)])
    assert got(0) == ["a", "b"] and spark.read.parquet(str(tmp_path / "out/pending/batch=0")).count() == 1
    drop("b", [(4, "a", 0.0, 0, 4)])
    assert got(1) == ["c", "a"]  # the ring goes on after b
    drop("c", [(5, "b", 0.0, 0, 5)])
    assert got(2) is None  # too few, and not waited long enough
    now[0] = 11.0
    drop("d", [])
    assert got(3) in (["b"], None)
    if got(3) is None:  # an empty file starts no micro-batch
        drop("e", [(6, "b", 0.0, 0, 6)])
        assert got(3) == ["b", "b"]


def test_monitor_keeps_the_newest_row_of_an_id(spark):
    df = spark.createDataFrame([(1, "t", 0.0, 0, 5), (1, "t", 1.0, 0, 9), (1, "t", 0.5, 0, None)], ROLLOUT)
    assert [(r.id, r.reward) for r in monitor.newest_rows(df).collect()] == [(1, 1.0)]


def test_dispatch_modes(spark):
    df = batch.number_rows(spark.range(10).withColumnRenamed("id", "k"), "k")
    assert dispatch.to_all(df, 3).count() == 30 and dispatch.of_rank(dispatch.to_all(df, 3), 2).count() == 10
    with pytest.raises(batch.BatchError):
        dispatch.split(df, 4)
    s = dispatch.split(df, 4, pad=True)
    assert sorted((r["rank"], r["count"]) for r in s.groupBy("rank").count().collect()) == [(0, 3), (1, 3), (2, 3), (3, 3)]
    assert sorted(r.k for r in dispatch.collect(s).collect()) == list(range(10))
    few = dispatch.split(df.filter("_row < 2"), 7, pad=True)
    assert few.count() == 7 and dispatch.collect(few).count() == 2
    out = dispatch.run(df, 4, lambda pdf: pdf.assign(k=pdf["k"] * 2), "k long, _row long, _pad boolean")
    assert sorted(r.k for r in out.collect()) == [2 * k for k in range(10)]
    parts = dispatch.to_each([df.filter("k < 3"), df.filter("k >= 3")])
    assert {(r["rank"], r["count"]) for r in parts.groupBy("rank").count().collect()} == {(0, 3), (1, 7)}


def test_reward_managers(spark):
    df = spark.createDataFrame([("a", "0.5", [1.0, 1.0, 0.0]), ("b", None, [1.0, 1.0, 1.0]), ("c", "x", [1.0, 0.0, 0.0])], "key string, cached string, mask array<double>")
    votes = spark.createDataFrame([("a", "Score: 1"), ("b", "Thought: y Score: 1"), ("b", "Score: 0"), ("b", "none"), ("c", "no number")], "key string, reply string")
    got = {r.key: r.rewards for r in reward.apply(df, "judge", replies=votes, key="key").collect()}
    assert got == {"a": [0.0, 0.5, 0.0], "b": [0.0, 0.0, 0.5], "c": [None, 0.0, 0.0]}
    long = {r.key: r.rewards for r in reward.apply(df, "overlong", score=F.lit(1.0), most=3, buffer=1).collect()}
    assert long["b"] == [0.0, 0.0, 0.0] and long["c"] == [1.0, 0.0, 0.0]
    assert reward.names() == ["judge", "overlong", "rule"]
    with pytest.raises(ValueError):
        reward.apply(df, "nobody")
    with pytest.raises(ValueError):
        reward.register("rule")(lambda d: d)


def test_advantages_on_the_mask_that_fits(spark):
    rows = [(0, "u", [0.0, 1.0, 0.0], [1, 1, 1, 1, 0], [0, 0, 0, 1, 1], [1.0, 0.0, 0.0]), (1, "u", [0.0, 0.0, 0.0], [1, 1, 1, 1, 1], [0, 0, 1, 1, 0], [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "_row long, uid string, rewards array<double>, attention_mask array<int>, loss_mask array<int>, mask_eff array<double>")
    plain = {r._row: (r.mask, r.advantages) for r in advantage.dispatch(df.drop("mask_eff"), "grpo").collect()}
    assert plain[0][0] == [1, 1, 0] and plain[1][0] == [1, 1, 1] and plain[0][1][2] == 0.0 and plain[0][1][0] > 0
    multi = {r._row: (r.mask, [x != 0 for x in r.advantages]) for r in advantage.dispatch(df, "grpo", multi_turn=True).collect()}
    assert multi == {0: ([1, 1, 0], [False, True, True]), 1: ([1, 1, 1], [True, True, False])}
    eff = {r._row: [x != 0 for x in r.advantages] for r in advantage.dispatch(df, "grpo").collect()}
    assert eff == {0: [True, False, False], 1: [False, True, False]}


def test_rounds_add_up_to_a_batch(spark):
    def one(base):
        return batch.number_rows(spark.range(8).select((F.col("id") + base).alias("k"), (F.floor(F.col("id") / 2) + base).alias("uid"), F.when(F.col("id") < 4, F.col("id") % 2).otherwise(1).cast("double").alias("acc")), "k")

    got = curation.accumulate((one(b) for b in (0, 100, 200)), "acc", prompts=3, per_prompt=2).collect()
    assert sorted({r.uid for r in got}) == [0, 1, 100] and len(got) == 6
    with pytest.raises(ValueError):
        curation.accumulate((one(b) for b in (0, 100, 200)), "acc", 5, 2, most_rounds=2)


def test_served_rows_count_as_used_before_the_next_batch(spark):
    df = spark.createDataFrame([("r", "1", 1, "a", 0.0, 0, "v1"), ("r", "2", 2, "b", 0.0, 1, "v1"), ("r", "3", 3, "c", 0.0, 2, "v1")], "run_id string, trajectory_id string, id long, task_id string, reward double, used int, model_version string")
    served, after = catalog.serve(df, batches=2, batch=2, per_task=1)
    assert [sorted(r.task_id for r in s.collect()) for s in served] == [["a", "b"], ["a", "b"]]
    assert {r.task_id: r.used for r in after.collect()} == {"a": 2, "b": 3, "c": 2}


def test_scripts_of_actions():
    box = "(500, 250, 500, 250)"
    s = actions.script([{"thought": "t", "action_type": "left_double", "action_inputs": {"start_box": "[0.5, 0.25, 0.5, 0.25]"}}, {"action_type": "hotkey", "action_inputs": {"key": "arrowleft"}}, {"action_type": "hotkey", "action_inputs": {"hotkey": "ctrl space"}}], 1000, 400)
    assert s == "import pyautogui\nimport time\n'''\nObservation:\n\n\nThought:\nt\n'''\n\npyautogui.doubleClick(500.0, 100.0, button='left')\ntime.sleep(1)\n\npyautogui.hotkey('left')\ntime.sleep(1)\n\npyautogui.hotkey('ctrl', ' ')"
    one = lambda kind, **inputs: actions.script([{"action_type": kind, "action_inputs": inputs}], 1000, 1000, paste=False).partition("'''\n\n")[2]
    assert one("scroll", direction="down", start_box="[0.1, 0.2]") == "pyautogui.scroll(-5, x=100.0, y=200.0)"
    assert one("press", key="arrowup") == "pyautogui.press('up')" and one("keydown", key="a") == "pyautogui.keyDown('a')"
    assert one("type", content="it's\n") == "pyautogui.write('it\\'s', interval=0.1)\ntime.sleep(0.5)\n\npyautogui.press('enter')"
    assert one("nothing") == "# Unrecognized action type: nothing"
    assert actions.script([{"action_type": "click", "action_inputs": {"start_box": "[0.1, 0.2]"}}, {"action_type": "finished"}], 10, 10) == "DONE"
    assert actions.script([{"action_type": "click", "action_inputs": {}}], 10, 10) is None and box


def test_algebra_without_evaluation():
    for a, b in [("2x+x", "3x"), ("(x+1)^2", "x^2+2x+1"), ("1/2", "0.5"), ("(a-b)(a+b)", "a^2-b^2"), ("x/(2y)", "0.5x/y"), ("-(x)", "0-x"), ("2^-1", "1/2"), ("a+b+c", "c+b+a")]:
        assert mathscore.symbolic(a, b), (a, b)
    for a, b in [("x", "y"), ("9^9^9^9", "1"), ("x^999", "x^999"), ("1/0", "1/0"), ("__import__('os')", "x"), ("((((", "x"), ("", ""), ("(a+b+c+d+e+f+g+h)^60", "1"), ("x+", "x")]:
        assert not mathscore.symbolic(a, b), (a, b)
    assert mathscore.math_equal(r"\begin{pmatrix}1 & 2\\3 & x+x\end{pmatrix}", r"\begin{pmatrix}1 & 2.0\\3 & 2x\end{pmatrix}")
    assert not mathscore.math_equal(r"\begin{pmatrix}1 & 2\\3 & 5\end{pmatrix}", r"\begin{pmatrix}1 & 2\\3 & 4\end{pmatrix}")


def test_domains_loaders_search_and_episodes(spark, tmp_path):
    configs = [{"id": "1", "app": "gimp"}, {"id": "2", "domain": "os", "app": "x"}, {"id": "3", "raw": {"category": "web"}}, {"id": "4"}, {"id": "5", "domain": "", "raw": {"app": "y"}}, {"domain": "z"}]
    df = spark.createDataFrame([(json.dumps(c), 1.0) for c in configs] + [("{", 1.0), (json.dumps({"id": "9", "app": "gimp"}), 0.0)], "config string, reward double")
    assert {tuple(r) for r in recipes.tasks_by_domain(df, "config", "reward").collect()} == {("gimp", "1"), ("os", "2"), ("web", "3"), ("unknown", "4"), ("y", "5")}
    readers.loader("ten")(ten)
    assert readers.load(spark, "ten", "id", n=10).count() == 10
    for bad in (lambda: readers.load(spark, "ten", "no", n=1), lambda: readers.load(spark, "none"), lambda: readers.loader("ten")(lambda s: s)):
        with pytest.raises(ValueError):
            bad()
    q = spark.createDataFrame([("a",), (None,), ("bb",)], "q string")
    hits = {r.q: len(r.hits) for r in readers.searched(q, "q", lambda qs, k: [[{"title": x, "text": x, "score": 1.0}] * 5 for x in qs], 2).collect()}
    assert hits == {"a": 2, None: 0, "bb": 2}
    ep = spark.createDataFrame([("r1", "t", "{}", "[]", 1.0, [b"x", b"y"]), ("r2", "t", "{}", "[]", None, None)], "run_id string, trajectory_id string, config string, messages string, reward double, frames array<binary>")
    for _ in range(2):
        writers.episodes(ep, str(tmp_path / "ep"))
    sizes = [spark.read.parquet(str(tmp_path / "ep" / t)).count() for t in ("episodes", "rewards", "frames")]
    assert sizes == [2, 1, 2]


def ten(spark, n):
    return spark.range(n)


def test_names_of_finished_folders(spark):
    tasks = spark.createDataFrame([("a_b", "t"), ("a", "t"), ("c", "t"), ("a_b", "u")], "task_id string, task_type string")
    results = spark.createDataFrame([("a_b_1", "t", 1.0), ("c", "t", None), (None, "t", 1.0)], "folder string, task_type string, reward double")
    assert {tuple(r) for r in recipes.unfinished(tasks, results).select("task_id", "task_type").collect()} == {("c", "t"), ("a_b", "u")}


def test_keys_are_checked_at_once(spark):
    df = spark.createDataFrame([("r", "1", 0.5)], "run_id string, trajectory_id string, reward double")
    with pytest.raises(ValueError):
        catalog.insert(df, df)
    with pytest.raises(ValueError):
        catalog.insert(df.limit(0), df.union(df))
    assert catalog.insert(df, df.withColumn("trajectory_id", F.lit("2"))).select("reward").count() == 2


def test_running_totals_over_partition_borders(spark):
    rows = [(i, "hot" if i % 3 else None, i % 5 if i % 4 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    got = {r.id: r.total for r in batch.running_total(df, "v", ["g"], "id").collect()}
    sums, want = {}, {}
    for i, g, v in rows:
        sums[g] = sums.get(g, 0) + (v or 0)
        want[i] = sums[g]
    assert got == want and batch.running_total(df.limit(0), "v", ["g"], "id").count() == 0


def test_greatest_tokens_by_thresholds(spark):
    df = spark.range(3000).select(F.col("id").alias("_row"), F.lit(0).alias("pos"), F.when(F.col("id") % 7 == 0, 5.0).otherwise((F.col("id") * 37 % 1000) / 100).alias("cov"))
    for n in (1, 40, 2999, 5000):
        got = {r._row for r in loss._greatest(df, n, "cov", 0.0, 9.99, 50).collect()}
        want = {r._row for r in df.orderBy(F.col("cov").desc(), "_row").limit(n).collect()}
        assert got == want


def test_store_writes_only_parts_that_change(spark, tmp_path):
    from tracemill.sources.store import TableStore

    st = TableStore(spark, str(tmp_path / "st"))
    for base in (0, 10, 20):
        st.insert("t", spark.range(base, base + 3).withColumn("v", F.lit(0)))
    before = st.tables()["t"]
    assert len(before) == 3 and st.read("t").count() == 9
    assert st.update("t", F.col("id") == 11, {"v": F.lit(7)}) == 1
    after = st.tables()["t"]
    assert [a == b for a, b in zip(before, after)] == [True, False, True]
    assert st.delete("t", F.col("id") >= 20) == 3 and st.delete("t", F.col("id") > 99) == 0
    assert {r.id: r.v for r in st.read("t").collect()} == {0: 0, 1: 0, 2: 0, 10: 0, 11: 7, 12: 0}
    st.compact("t")
    st.compact("t")
    assert len(st.tables()["t"]) == 1 and len([p for p in (tmp_path / "st").iterdir() if p.name.startswith("t-")]) == 2
    assert st.query("SELECT sum(v) AS s FROM {t} WHERE id < :n", n=12).first().s == 7
