"""Rollout catalog: upserts, usage, versions, statistics and the model registry.

Tables are DataFrames; a changing operation returns the new table (and event rows)
as a plan, to be written by the caller with an overwrite or a MERGE of a table format.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.operators.batch import number_rows
from tracemill.session import materialize

KEY = ("run_id", "trajectory_id")


class CatalogError(ValueError):
    pass


def latest_per_key(df: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    return df.withColumn("_rk", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("_rk = 1").drop("_rk")


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str] = KEY, keep: Sequence[str] = ("id", "create_at")) -> DataFrame:
    """Changed rows replace those of the same key; columns in keep stay as they were.

    changes holds one row per key. One shuffle by key on each side.
    """
    cols = [c for c in current.columns if c not in key]
    have = [c for c in changes.columns if c not in key]
    right = changes.select(*key, *[F.col(c).alias(f"_n_{c}") for c in have], F.lit(True).alias("_new"))
    both = current.withColumn("_old", F.lit(True)).join(right, list(key), "full_outer")
    new, old = F.col("_new"), F.col("_old")

    def pick(c: str) -> Column:
        if c not in have:
            return F.col(c)
        take = new & old.isNull() if c in keep else new
        return F.when(take, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*key, *[pick(c) for c in cols]).select(*current.columns)


def upsert_with_events(current: DataFrame, changes: DataFrame, key: Sequence[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """Insert, or reset ``used`` to 0 with the new values; also the INSERT and UPDATE events."""
    reset = changes.withColumn("used", F.lit(0))
    table = upsert(current, reset, key)
    known = current.select(*key).distinct().withColumn("_k", F.lit(1))
    events = changes.select(*key, "model_version").join(known, list(key), "left")
    return table, events.select(*key, "model_version", F.lit(0).alias("used_delta"), F.when(F.col("_k").isNull(), "INSERT").otherwise("UPDATE").alias("event_type"))


def insert(current: DataFrame, rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Appends rows; a key that exists already, or twice in rows, raises ValueError at once (one job over the keys)."""
    counted = rows.groupBy(*key).agg(F.count("*").alias("_n"))
    known = counted.join(current.select(*key), list(key), "left_semi")
    bad = counted.filter("_n > 1").select(*key).unionByName(known.select(*key)).first()
    if bad is not None:
        raise ValueError(f"duplicate key {bad.asDict()}")
    return current.unionByName(rows.select(*current.columns))


def add_usage(current: DataFrame, uses: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``used`` + the number of uses per key (null counts as 0); uses of unknown keys change nothing."""
    n = uses.groupBy(*key).agg(F.count("*").alias("_n"))
    return current.join(n, list(key), "left").withColumn("used", (F.coalesce("used", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int")).select(*current.columns)


def delete_runs(current: DataFrame, run_ids: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of all other runs; the ids come as a list or as a table with run_id. Rows without a run stay."""
    if isinstance(run_ids, DataFrame):
        return current.join(run_ids.select("run_id"), "run_id", "left_anti")
    return current.filter(~F.col("run_id").isin(*run_ids) | F.col("run_id").isNull())


def newest_versions(df: DataFrame, n: int = 2, by: str = "run_id") -> DataFrame:
    """The n model versions with the newest row, per run: run_id, model_version, last_at, rank."""
    last = df.filter("model_version is not null").groupBy(by, "model_version").agg(F.max("create_at").alias("last_at"))
    w = W.partitionBy(by).orderBy(F.col("last_at").desc_nulls_last(), F.col("model_version").desc())
    return last.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def nth_newest_success(df: DataFrame, n: int = 1, by: str = "run_id") -> DataFrame:
    """Of each run's n-th newest version: successes (reward >= 0, summed), rows, tasks and the average over all rows."""
    nth = newest_versions(df, n, by).filter(F.col("rank") == n).select(by, "model_version")
    rows = df.join(nth, [by, "model_version"])
    good = F.sum(F.when(F.col("reward") >= 0, F.col("reward")).otherwise(0.0))
    return rows.groupBy(by, "model_version").agg(good.alias("success"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("task_id").alias("n_tasks"), (good / F.count(F.lit(1))).alias("avg_success"))


def version_number(c: str = "version") -> Column:
    """Number of ``v<digits>``, null for other forms."""
    return F.when(F.col(c).rlike(r"^v\d+$"), F.expr(f"try_cast(substring({c}, 2) as bigint)"))


def latest_checkpoints(df: DataFrame, n: int) -> DataFrame:
    """The n rows of greatest numeric version (ties by id); other forms are left out."""
    return df.withColumn("version_no", version_number()).filter("version_no is not null").orderBy(F.col("version_no").desc(), F.col("id").desc()).limit(n)


def next_version(df: DataFrame, source: str = "train") -> DataFrame:
    """One row: 1 + the greatest number of the source's versions, v0 for none."""
    return df.filter(F.col("source") == source).agg(F.concat(F.lit("v"), F.coalesce(F.max(version_number()) + 1, F.lit(0)).cast("string")).alias("next_version"))


def task_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("task_id").agg(
        F.count("*").alias("n"), F.avg("used").alias("avg_used"), F.avg(F.coalesce("reward", F.lit(0.0))).alias("avg_reward"), F.max(version_number("model_version")).alias("max_version")
    )


def task_priority(df: DataFrame) -> DataFrame:
    """Tasks by newest version, then least use, then name: task_id, max_version, min_used, rank (from 1)."""
    per = df.groupBy("task_id").agg(F.coalesce(F.max(version_number("model_version")), F.lit(-1)).alias("max_version"), F.min(F.coalesce("used", F.lit(0))).alias("min_used"))
    return per.orderBy(F.col("max_version").desc(), "min_used", "task_id")


def top_per_task(df: DataFrame, n: int) -> DataFrame:
    """The n best rows of each task: newest version, least used, best reward (null as 0), lowest id."""
    w = W.partitionBy("task_id").orderBy(F.coalesce(version_number("model_version"), F.lit(-1)).desc(), F.coalesce("used", F.lit(0)), F.coalesce("reward", F.lit(0.0)).desc(), "id")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def serve(df: DataFrame, batches: int, batch: int, per_task: int, key: Sequence[str] = KEY) -> tuple[list[DataFrame], DataFrame]:
    """(rows of each batch with ``slot``, catalog after) of reads in order: X5.

    At the start of a batch the task queue is sorted anew by what was used so far; read i of a batch serves the
    queue's place i, from the front again after its end, and every row that is served counts one use more.
    """
    out, now = [], df
    for _ in range(batches):
        queue = materialize(task_priority(now).limit(batch), "queue").select("task_id", "max_version", "min_used")
        slots = number_rows(queue, F.col("max_version").desc(), "min_used", "task_id", name="_place")
        n = slots.count()
        reads = slots.withColumn("slot", F.explode(F.sequence(F.col("_place"), F.lit(batch - 1).cast("long"), F.lit(max(n, 1)).cast("long")))).select("task_id", "slot")
        # a task that is read again within the batch has its uses counted by then
        served = top_per_task(now.join(reads.select("task_id").distinct(), "task_id", "left_semi"), per_task).join(reads, "task_id")
        served = materialize(served, "served")
        out.append(served)
        now = materialize(add_usage(now, served.select(*key), key), "catalog")
    return out, now


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of states."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def queue_slot(index: Column, batch: int, queue_length: int) -> Column:
    """Place in the task queue that a read of this index serves."""
    return F.pmod(F.pmod(index, F.lit(batch)), F.lit(queue_length))


# model registry -------------------------------------------------------------------------


def alive(df: DataFrame) -> DataFrame:
    return df.filter("deleted_at is null")


def lookup(df: DataFrame, **where) -> DataFrame:
    out = alive(df)
    for c, v in where.items():
        out = out.filter(F.col(c) == v)
    return out


def listing(df: DataFrame, status=None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Newest update first (ties by id), paged."""
    out = alive(df) if status is None else alive(df).filter(F.col("status") == status)
    return out.orderBy(F.col("updated_at").desc_nulls_last(), F.col("id").desc()).offset(offset).limit(limit)


def partial_update(df: DataFrame, id_: int, values: Mapping[str, object], allowed: Sequence[str], now: Column) -> tuple[DataFrame, bool]:
    """Sets the allowed fields of a row that isn't deleted and its updated_at; (table, whether there was a field)."""
    fields = {k: v for k, v in values.items() if k in allowed}
    if not fields:
        return df, False
    hit = (F.col("id") == id_) & F.col("deleted_at").isNull()
    sets = {k: F.when(hit, F.lit(v).cast(df.schema[k].dataType)).otherwise(F.col(k)) for k, v in fields.items()}
    return df.withColumns({**sets, "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}), True


def soft_delete(df: DataFrame, id_: int, now: Column) -> DataFrame:
    hit = (F.col("id") == id_) & F.col("deleted_at").isNull()
    return df.withColumn("deleted_at", F.when(hit, now).otherwise(F.col("deleted_at")))


def hard_delete(df: DataFrame, id_: int) -> DataFrame:
    return df.filter(F.col("id") != id_)


def count_rows(df: DataFrame, **where) -> DataFrame:
    return lookup(df, **where).agg(F.count("*").alias("n"))


def search_name(df: DataFrame, text: str) -> DataFrame:
    """Names like ``%text%``; wildcards in text stay wildcards."""
    return alive(df).filter(F.col("name").like(f"%{text}%"))


def newest(df: DataFrame, by: str = "created_at") -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), F.col("id").desc()).limit(1)


def activate(current: DataFrame, row: Mapping[str, object], now: Column) -> DataFrame:
    """Appends a row with status ``starting``."""
    spark = current.sparkSession
    values = {**row, "status": "starting"}
    one = spark.range(1).select(*[(now if c in ("created_at", "updated_at") else F.lit(values.get(c))).cast(current.schema[c].dataType).alias(c) for c in current.columns])
    return current.unionByName(one)


def task_queue(df: DataFrame, limit: int = 100, offset: int = 0, **where) -> DataFrame:
    """Pending work by priority, then age (ties by id), with any equality predicates; its head is the ``latest`` task whatever its status."""
    out = df
    for c, v in where.items():
        out = out.filter(F.col(c) == v)
    return out.orderBy(F.col("priority").desc_nulls_last(), F.col("created_at").asc_nulls_last(), "id").offset(offset).limit(limit)


def move_state(df: DataFrame, id_: int, status: int, now: Column) -> DataFrame:
    """1 sets started_at, 2 and 3 set completed_at; another status than 0..3 raises."""
    if status not in (0, 1, 2, 3):
        raise CatalogError(f"status {status}")
    hit = F.col("id") == id_
    out = df.withColumns({"status": F.when(hit, status).otherwise(F.col("status")), "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))})
    if status == 1:
        return out.withColumn("started_at", F.when(hit, now).otherwise(F.col("started_at")))
    if status in (2, 3):
        return out.withColumn("completed_at", F.when(hit, now).otherwise(F.col("completed_at")))
    return out


def priority_is_valid(kind: Column, priority: Column) -> Column:
    """System tasks have priority 9, normal ones 0 to 8."""
    return F.when(kind == "system", priority == 9).when(kind == "normal", priority.between(0, 8)).otherwise(F.lit(False))


def with_checkpoint(rows: DataFrame, checkpoints: DataFrame, *order: Column, limit: int = 100, offset: int = 0) -> DataFrame:
    """Left join to the checkpoints (deleted ones too), ordered and paged."""
    cp = checkpoints.select(F.col("id").alias("checkpoint_id"), F.col("name").alias("checkpoint_name"), F.col("path").alias("checkpoint_path"))
    return rows.join(cp, "checkpoint_id", "left").orderBy(*order).offset(offset).limit(limit)
