import json

from tracemill.sources import readers, writers


def test_trajectory_folders(spark, tmp_path):
    for t, reward in (("t1", "1.0\n"), ("t2", None)):
        f = tmp_path / "run" / "task" / t
        f.mkdir(parents=True)
        (f / "task_config.json").write_text(json.dumps({"id": t}))
        (f / "image_0001.png").write_bytes(b"x")
        if reward:
            (f / "reward.txt").write_text(reward)
            (f / "final_messages.json").write_text(json.dumps([{"role": "user", "content": "plain"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "image_url", "image_url": "u"}]}]))
    got = {r.trajectory_id: r for r in readers.trajectories(spark, str(tmp_path)).collect()}
    assert got["t1"].reward == 1.0 and got["t2"].reward is None and got["t2"].messages is None
    m = got["t1"].messages
    assert m[0].content[0].text == "plain" and (m[1].content[1].type, m[1].content[1].image) == ("image", "u")
    tree = {(r.run, r.task, r.trajectory): (r.reward, r.n_images) for r in readers.trajectory_tree(spark, str(tmp_path)).collect()}
    assert tree == {("run", "task", "t1"): (1.0, 1), ("run", "task", "t2"): (None, 1)}
    assert readers.file_hashes(spark, str(tmp_path / "run/task/t1"), "*.txt").count() == 1
    assert readers.newest_file(spark, str(tmp_path / "run/task/t1")).first().path


def test_manifest_and_report(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"os": ["a", "a"], "web": ["b"]}))
    assert sorted((r.task_type, r.task_id) for r in readers.manifest(spark, str(tmp_path / "m.json")).collect()) == [("os", "a"), ("os", "a"), ("web", "b")]
    df = spark.createDataFrame([(0, "x"), (1, "y")], "_row long, text string")
    writers.generations(df, str(tmp_path / "gen"), 3, {"score": ["1", "2"], "short": ["1"]})
    back = spark.read.json(str(tmp_path / "gen"))
    assert "score" in back.columns and "short" not in back.columns and back.filter("step = 3").count() == 2
    writers.track(writers.metrics_long({"a": {"b": 1}}, 1, spark), str(tmp_path / "m"), ["parquet", "json"])
    assert spark.read.json(str(tmp_path / "m/json")).first().key == "a/b"
    assert writers.sample_view(df, 1, "text") == [{"text": "x"}]
