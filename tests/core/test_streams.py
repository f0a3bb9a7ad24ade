from pyspark.sql import functions as F

from tracemill.operators import curation
from tracemill.streaming import monitor

SCHEMA = "id long, task_id string, reward double, used int, create_at int"


def drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / name))


def test_monitor_counts_each_poll(spark, tmp_path):
    src = tmp_path / "in"
    start = lambda: monitor.monitor(spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(src)), str(tmp_path / "out"), F.col("reward") == 1, str(tmp_path / "cp")).awaitTermination()
    drop(spark, src, "a", [(1, "t", 0.0, 0, 1), (2, "t", 1.0, 0, 1)])
    start()
    drop(spark, src, "b", [(1, "t", 1.0, 1, 2), (3, "t", 1.0, 0, 2), (2, "t", 1.0, 0, 1)])
    start()
    got = {r.batch_id: r for r in spark.read.json(str(tmp_path / "out/counters")).collect()}
    assert got[0].total_rows == 2 and got[0].new_rollouts == 0
    assert (got[1].new_rollouts, got[1].changed_rollouts, got[1].new_trainables, got[1].newly_passing) == (1, 1, 1, 1)


def test_feed_waits_for_enough_rows(spark, tmp_path):
    src = tmp_path / "in"
    curate = lambda df: curation.trim_newest(df, 2, F.col("reward") == 1)
    start = lambda: monitor.feed(spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(src)), str(tmp_path / "out"), curate, 1, 2, str(tmp_path / "cp")).awaitTermination()
    drop(spark, src, "a", [(1, "t", 0.0, 0, 1)])
    start()
    assert not (tmp_path / "out/batches").exists()
    drop(spark, src, "b", [(2, "t", 1.0, 0, 2)])
    start()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out/batches/batch=1")).collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "out/pending/batch=1")).count() == 0


def test_late_rows_and_sessions(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 00:00:00' + make_interval(0,0,0,0,0,i) AS ts, 'x' AS event_type, 1.0D AS value, 7L AS user_id FROM VALUES (0),(1),(2),(30),(31) t(i)")
    assert sorted(r.n for r in monitor.sessions(df).collect()) == [2, 3]
    assert sorted(r.n for r in monitor.windowed_completions(df).collect()) == [2, 3]
