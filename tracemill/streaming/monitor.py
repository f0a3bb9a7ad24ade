"""Monitoring and feeding jobs on Structured Streaming.

The poll loop of a monitor is a stream of catalog rows with ``foreachBatch``: each
micro-batch is compared with a state table of known ids, their row hashes and whether
they pass. State is written per batch id before the metrics, so a batch that is run
again replaces its own output and counts nothing twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.text import row_md5


def new_ids(now: DataFrame, seen: DataFrame) -> DataFrame:
    return now.select("id").distinct().join(seen.select("id"), "id", "left_anti")


def changed_ids(now: DataFrame, seen: DataFrame) -> DataFrame:
    """Known ids whose ``row_hash`` differs."""
    old = seen.select("id", F.col("row_hash").alias("_old"))
    return now.join(old, "id").filter("row_hash <> _old").select("id").distinct()


def newly_passing(passing: DataFrame, seen_passing: DataFrame, added: DataFrame) -> DataFrame:
    """Passing ids that neither passed before nor are new."""
    return passing.select("id").join(seen_passing.select("id"), "id", "left_anti").join(added.select("id"), "id", "left_anti")


def tick(rows: DataFrame, state: DataFrame | None, passes) -> tuple[DataFrame, DataFrame]:
    """(counters as one row, new state) of one poll; the first poll is a baseline with zeros.

    rows: id and the catalog's columns, one row per id. state: id, row_hash, passes.
    """
    cols = [c for c in ("reward", "used", "model_version", "task_id") if c in rows.columns]
    now = rows.select("id", row_md5(*cols).alias("row_hash"), F.coalesce(passes, F.lit(False)).alias("passes"))
    if state is None:
        zero = [F.lit(0).cast("long").alias(c) for c in ("new_rollouts", "changed_rollouts", "new_trainables", "newly_passing")]
        return now.agg(F.count("*").alias("total_rows"), F.count_if("passes").alias("current_trainable"), *zero), now
    old = state.select("id", F.col("row_hash").alias("h"), F.col("passes").alias("p"))
    both = now.join(old, "id", "left")
    fresh = F.col("h").isNull()
    counters = both.agg(
        F.count("*").alias("total_rows"), F.count_if("passes").alias("current_trainable"), F.count_if(fresh).alias("new_rollouts"), F.count_if(~fresh & (F.col("row_hash") != F.col("h"))).alias("changed_rollouts"),
        F.count_if(fresh & F.col("passes")).alias("new_trainables"), F.count_if(~fresh & F.col("passes") & ~F.col("p")).alias("newly_passing"),
    )
    return counters, now


def _done(spark: SparkSession, folder: str, before: int) -> list[int]:
    """Numbers of the batches below ``before`` that were written to their end, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = sorted(int(f.getPath().getName()[6:]) for f in fs.listStatus(path) if f.getPath().getName().startswith("batch=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")))
    return [b for b in done if b < before]


def _latest(spark: SparkSession, folder: str, before: int) -> DataFrame | None:
    done = _done(spark, folder, before)
    return spark.read.parquet(f"{folder}/batch={done[-1]}") if done else None


#: every so many batches the whole state is written, between them only what changed
WHOLE = 16


def _state(spark: SparkSession, folder: str, before: int) -> DataFrame | None:
    """The newest row of each id since the last batch that wrote the whole state."""
    done = _done(spark, folder, before)
    if not done:
        return None
    since = [b for b in done if b >= max((x for x in done if x % WHOLE == 0), default=done[0])]
    rows = None
    for b in since:  # at most WHOLE
        one = spark.read.parquet(f"{folder}/batch={b}").withColumn("_b", F.lit(b))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("id").agg(F.max_by("row_hash", "_b").alias("row_hash"), F.max_by("passes", "_b").alias("passes"))


def newest_rows(df: DataFrame) -> DataFrame:
    """One row per id: the latest by create_at, then of the greatest use, then of the greatest hash."""
    cols = [c for c in df.columns if c != "id"]
    order = F.struct(*[F.col(c) for c in ("create_at", "used") if c in cols], row_md5(*cols).alias("_h"))
    return df.groupBy("id").agg(F.max_by(F.struct(*cols), order).alias("r")).select("id", "r.*")


def monitor(stream: DataFrame, folder: str, passes, checkpoint: str):
    """Starts the monitor on a stream of catalog rows; counters go to folder/counters, state to folder/state.

    A row of an id that comes again replaces the known one. A micro-batch writes the state of its own rows; every
    ``WHOLE`` batches the whole state is written.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _state(spark, f"{folder}/state", batch_id)
        counters, now = tick(newest_rows(batch), state, passes)
        if state is not None and batch_id % WHOLE == 0:
            now = now.unionByName(state.join(now.select("id"), "id", "left_anti"))
        now.write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")
        counters.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").json(f"{folder}/counters/batch={batch_id}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def feed(
    stream: DataFrame, folder: str, curate: Callable[[DataFrame], DataFrame], batch_min: int, per_task: int, checkpoint: str,
    batch_max: int | None = None, rotate_tasks: bool = False, max_wait: float = float("inf"), clock: Callable[[], float] = time.time,
):
    """Curated training batches: a micro-batch's pending rows are curated and, once there are enough, written with their usage.

    A batch goes with batch_min * per_task rows, or with fewer once rows have waited max_wait seconds. Tasks come in
    order of their oldest row; with rotate_tasks the ring starts after the last task of the batch before. At most
    batch_max * per_task rows are taken. Rows that don't go stay pending for the next batch. Output, usage and state of
    a batch id are overwritten when it is run again. ``place`` is the task's place.
    """
    from tracemill.operators.batch import first_rows
    from tracemill.operators.curation import ready, rotate

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pending, state = _latest(spark, f"{folder}/pending", batch_id), _latest(spark, f"{folder}/ring", batch_id)
        last, since = state.first() if state is not None else (None, None)
        rows = batch if pending is None else batch.unionByName(pending)
        picked = curate(rows).persist()
        n, now = picked.count(), clock()
        since = (now if since is None else since) if n else None
        if ready(n, batch_min, per_task, now - since if since is not None else 0.0, max_wait):
            groups = picked.groupBy("task_id").agg(F.min("create_at").alias("group_at"))
            placed = picked.join(rotate(groups, last if rotate_tasks else None), "task_id")
            if batch_max is not None:
                placed = first_rows(placed, batch_max * per_task, "place", "create_at", "id")
            out = f"{folder}/batches/batch={batch_id}"
            placed.write.mode("overwrite").parquet(out)
            gone = spark.read.parquet(out)
            gone.select("id", F.lit(1).alias("used_delta"), F.lit(batch_id).alias("batch_id")).write.mode("overwrite").parquet(f"{folder}/usage/batch={batch_id}")
            last = gone.agg(F.max_by("task_id", "place")).first()[0]
            rows = rows.join(gone.select("id"), "id", "left_anti")
            since = None if rows.isEmpty() else now
        rows.write.mode("overwrite").parquet(f"{folder}/pending/batch={batch_id}")
        spark.createDataFrame([(last, since)], "last_task string, since double").write.mode("overwrite").parquet(f"{folder}/ring/batch={batch_id}")
        picked.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_completions(stream: DataFrame, size: str = "10 minutes", slide: str | None = None, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Completions and mean value per window and type, with a watermark for late rows (batch or stream)."""
    at = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    at = at.withWatermark("_ts", late) if stream.isStreaming else at
    w = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    return at.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean_value")).select(F.col("w.start").alias("window_start"), "event_type", "n", "mean_value")


def sessions(stream: DataFrame, gap: str = "5 minutes", late: str = "10 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Sessions per key: start, end and number of rows."""
    at = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    at = at.withWatermark("_ts", late) if stream.isStreaming else at
    return at.groupBy(F.session_window("_ts", gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
