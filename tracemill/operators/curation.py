"""Curation of rollouts into training groups.

Group statistics are aggregates joined back on the task, so that a task with a large share of
all rows is split by the skew join; ranks are only used as ``row_number() <= k``, which
limits every group before the shuffle, and windows beyond that see a few rows per task. Random choices are by hash of (seed, id), so they
repeat and are spread evenly. Ties in time go to the greater id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.operators.batch import ROW, first_rows, number_rows
from tracemill.operators.catalog import newest_versions
from tracemill.session import materialize

ZERO = 1e-12


def _newest(*by: str) -> W:
    return W.partitionBy(*by).orderBy(F.col("create_at").desc_nulls_last(), F.col("id").desc())


def _oldest(*by: str) -> W:
    return W.partitionBy(*by).orderBy(F.col("create_at").asc_nulls_first(), F.col("id").asc())


def scored(df: DataFrame) -> DataFrame:
    """Rows with a reward that is a number and not -1."""
    return df.filter(F.col("reward").isNotNull() & ~F.isnan("reward") & (F.col("reward") != -1))


def replace_all_zero(group: DataFrame, pool: DataFrame, positive: Column, task: str = "task_id") -> DataFrame:
    """In groups whose mean is 0 the oldest row gives way to the pool's newest positive row of the task; without one the group goes.

    group needs ``_mean``. A positive row that is in the group already leaves it as it is.
    """
    cols = [c for c in group.columns if not c.startswith("_")]
    newest = F.struct(F.col("create_at").isNotNull().alias("some"), "create_at", "id")
    best = pool.filter(positive).groupBy(task).agg(F.max_by(F.struct(*[F.col(c) for c in cols if c != task]), newest).alias("_new"))
    zero = group.filter(F.abs("_mean") <= ZERO)
    # the oldest row's id, with null times first, and whether the newest positive row is in the group
    oldest = zero.groupBy(task).agg(F.min(F.struct(F.col("create_at").isNotNull().alias("some"), "create_at", "id")).alias("_o"))
    inside = best.select(task, F.col("_new.id").alias("id")).join(zero.select(task, "id"), [task, "id"], "left_semi").select(task, F.lit(True).alias("_in"))
    plan = oldest.select(task, F.col("_o.id").alias("_oldest")).join(best, task).join(inside, task, "left")
    kept = group.filter(F.abs("_mean") > ZERO).select(*cols)
    swap = (F.col("id") == F.col("_oldest")) & F.col("_in").isNull()
    changed = zero.join(plan, task).withColumn("_swap", swap)
    pick = lambda c: F.col(c) if c == task else F.when(F.col("_swap"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return kept.unionByName(changed.select(*[pick(c) for c in cols]))


def trim_random(df: DataFrame, limit: int, seed: int, positive: Column, task: str = "task_id") -> DataFrame:
    """At most limit rows per task by hash; of larger groups one positive and one other row stay, if there are any."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")))
    # a kept row is among the first limit of its kind, so at most 2 * limit rows per task are left here
    few = df.withColumns({"_pos": positive, "_h": h}).withColumn("_c", F.row_number().over(W.partitionBy(task, "_pos").orderBy("_h", "id"))).filter(F.col("_c") <= limit)
    rank = F.row_number().over(W.partitionBy(task).orderBy((F.col("_c") > 1).cast("int"), "_h", "id"))
    return few.withColumn("_rk", rank).filter(F.col("_rk") <= limit).drop("_pos", "_h", "_c", "_rk")


def trim_newest(df: DataFrame, limit: int, positive: Column, task: str = "task_id") -> DataFrame:
    """The newest limit rows per task; if none of them is positive, the newest positive one takes the last place."""
    newest = df.withColumn("_rk", F.row_number().over(_newest(task))).filter(F.col("_rk") <= limit)
    first = df.filter(positive).withColumn("_rk", F.row_number().over(_newest(task))).filter("_rk = 1").drop("_rk")
    has = newest.filter(positive).select(task).distinct()
    late = first.join(has, task, "left_anti")
    shorter = late.select(task, F.lit(limit - 1).alias("_most"))
    kept = newest.join(shorter, task, "left").filter(F.col("_rk") <= F.coalesce("_most", F.lit(limit)))
    return kept.select(*df.columns).unionByName(late.select(*df.columns))


def eligible(df: DataFrame, limit: int, acc_max: float, task: str = "task_id") -> DataFrame:
    """Rows of tasks with at least limit rows and a mean in [0, acc_max), with ``_mean``."""
    per = df.groupBy(task).agg(F.count("*").alias("_n"), F.avg("reward").alias("_mean"))
    good = per.filter((F.col("_n") >= limit) & (F.col("_mean") >= 0) & (F.col("_mean") < acc_max)).drop("_n")
    return df.join(good, task)


def trainable(df: DataFrame, versions: DataFrame | None = None, per_task: int = 8, acc_max: float = 1.0, seed: int = 42) -> DataFrame:
    """Trainable rows of one run (C1): unused rows of the given model versions, in eligible tasks, balanced and trimmed.

    versions: ``(model_version)``; empty gives no rows. The pool of positive rows is
    the whole input, used rows and other versions included.
    """
    versions = newest_versions(df).select("model_version") if versions is None else versions
    fresh = scored(df.filter("used = 0").join(versions.distinct(), "model_version", "left_semi"))
    swapped = replace_all_zero(eligible(fresh, per_task, acc_max), scored(df), F.col("reward") > 0)
    return trim_random(swapped, per_task, seed, F.col("reward") > 0)


def monitor_trainable(df: DataFrame, per_task: int = 8, acc_max: float = 1.0) -> DataFrame:
    """Trainable rows as the monitor counts them (C2): the two newest versions, positive means 1, newest rows stay."""
    df = materialize(df, "catalog")  # read four times
    versions = newest_versions(df).select("run_id", "model_version")
    fresh = scored(df.join(versions, ["run_id", "model_version"], "left_semi"))
    return trim_newest(replace_all_zero(eligible(fresh, per_task, acc_max), scored(df), F.col("reward") == 1), per_task, F.col("reward") == 1)


def training_groups(df: DataFrame, n: int = 8, task: str = "task_id") -> DataFrame:
    """The newest n rows of each task (exactly n), mean of coalesce(reward, 0) in [0, 1); of all-zero groups the oldest
    row is replaced by the newest row with reward 1, or the group goes (C3). Adds ``group_at``, the group's oldest time."""
    w = W.partitionBy(task)
    top = df.withColumn("_rk", F.row_number().over(_newest(task))).filter(F.col("_rk") <= n)
    m = top.withColumns({"_n": F.count("*").over(w), "_mean": F.avg(F.coalesce("reward", F.lit(0.0))).over(w)}).filter((F.col("_n") == n) & (F.col("_mean") >= 0) & (F.col("_mean") < 1))
    swapped = replace_all_zero(m.drop("_n", "_rk"), df, F.col("reward") == 1)
    return swapped.withColumn("group_at", F.min("create_at").over(w))


def newest_full_groups(df: DataFrame, n: int, task: str = "task_id") -> DataFrame:
    """The newest n rows of each task that has at least n.

    A count beside the rank would keep Spark from limiting a task's rows before the shuffle, so
    tasks are counted by those n rows.
    """
    top = df.withColumn("_rk", F.row_number().over(_newest(task))).filter(F.col("_rk") <= n)
    full = top.filter(F.col("_rk") == n).select(F.col(task).alias("_full"))
    return top.join(full, top[task].eqNullSafe(F.col("_full")), "left_semi").drop("_rk")


def newest_positive(df: DataFrame, positive: Column, task: str = "task_id") -> DataFrame:
    """The newest positive row of each task."""
    return df.filter(positive).withColumn("_rk", F.row_number().over(_newest(task))).filter("_rk = 1").drop("_rk")


def best_gap(df: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """``group, gap``: the best value less the second best, of groups of two or more."""
    two = df.withColumn("_rk", F.row_number().over(W.partitionBy(group).orderBy(F.col(value).desc(), order))).filter(F.col("_rk") <= 2)
    per = two.groupBy(group).agg(F.count("*").alias("_n"), (F.max(F.when(F.col("_rk") == 1, F.col(value))) - F.max(F.when(F.col("_rk") == 2, F.col(value)))).alias("gap"))
    return per.filter("_n = 2").drop("_n")


def rotate(groups: DataFrame, last_task: str | None, task: str = "task_id") -> DataFrame:
    """Groups by ``group_at`` in a ring that starts after last_task: task, place (from 0)."""
    ranked = number_rows(groups.select(task, "group_at").distinct(), F.col("group_at").asc_nulls_last(), F.col(task))
    n = ranked.count()
    at = ranked.filter(F.col(task) == last_task).agg(F.max(ROW)).first()[0] if last_task is not None else None
    return ranked.select(task, F.pmod(F.col(ROW) - ((at + 1) if at is not None else 0), F.lit(max(n, 1))).alias("place"))


def proportional(df: DataFrame, most: int = 8, seed: int = 0, task: str = "task_id") -> DataFrame:
    """About ``most`` rows per task in the task's own proportion of correct (> 0.8) to wrong (0) rows (C4).

    Tasks with no correct row keep up to most wrong ones; tasks with a share of correct
    rows among all rows above 7/8 or below 1/8 go.
    """
    kind = F.when(F.col("reward") > 0.8, "correct").when(F.col("reward") == 0, "wrong")
    per = df.groupBy(task).agg(F.count("*").alias("_n"), F.count_if(F.col("reward") > 0.8).alias("_c")).withColumn("_p", F.col("_c") / F.col("_n"))
    rank = F.row_number().over(W.partitionBy(task, "_k").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"))), "id"))
    few = df.withColumn("_k", kind).filter("_k is not null").withColumn("_rk", rank).filter(F.col("_rk") <= most)
    quota = F.when(F.col("_c") == 0, F.lit(most)).when((F.col("_p") > 0.875) | (F.col("_p") < 0.125), F.lit(0))
    correct = F.least(F.ceil(F.col("_p") * most), F.col("_c"))
    quota = quota.when(F.col("_k") == "correct", correct).otherwise(most - correct)
    return few.join(per, task).filter(F.col("_rk") <= quota).drop("_k", "_n", "_c", "_p", "_rk")


def priority(df: DataFrame, most: int = 8, task: str = "task_id", order: str = "id") -> DataFrame:
    """Rows with reward 1 first, then 0, in input order, up to most per task; tasks without a 0 go."""
    mixed = df.filter("reward = 0").select(task).distinct()
    ranked = df.filter("reward in (0, 1)").withColumn("_rk", F.row_number().over(W.partitionBy(task).orderBy(F.col("reward").desc(), order)))
    return ranked.filter(F.col("_rk") <= most).join(mixed, task, "left_semi").drop("_rk")


def drop_flat_groups(df: DataFrame, metric: str, group: str = "uid") -> DataFrame:
    """Groups whose metric varies, and groups of one."""
    varied = df.groupBy(group).agg(F.stddev_pop(metric).alias("_sd"), F.count("*").alias("_n")).filter("_sd > 0 or _n = 1").select(group)
    return df.join(varied, group, "left_semi")


def accumulate(rounds: Iterable[DataFrame], metric: str, prompts: int, per_prompt: int, most_rounds: int = 0, group: str = "uid", order: str = ROW) -> DataFrame:
    """Rows of varied groups from one round of generation after the other, until there are enough prompts, cut to the batch.

    Each round's kept rows are written once; rounds go on while there are fewer than ``prompts`` groups. Too few after
    ``most_rounds`` rounds (0: no bound), or when the rounds end, raise ValueError.
    """
    kept, n, done = None, 0, 0
    for df in rounds:
        own = materialize(drop_flat_groups(df, metric, group).withColumn("_round", F.lit(done)), "round")
        n += own.select(group).distinct().count()
        kept = own if kept is None else kept.unionByName(own)
        done += 1
        if n >= prompts:
            return first_rows(kept, prompts * per_prompt, "_round", order).drop("_round")
        if most_rounds and done >= most_rounds:
            break
    raise ValueError(f"{n} of {prompts} prompts after {done} rounds")


def cut_batch(df: DataFrame, prompts: int, per_prompt: int, order: str) -> DataFrame:
    return first_rows(df, prompts * per_prompt, F.col(order))


def accuracy_filter(df: DataFrame, low: float, high: float, max_length: int, oversample: float, group: str = "uid", row: str = "_row") -> DataFrame:
    """Rows of passing groups first, then the others, cut to count // oversample.

    A group passes with a mean acc in [low, high] and no length of max_length - 1 or more.
    """
    per = df.groupBy(group).agg(F.avg("acc").alias("_acc"), F.max("length").alias("_len"))
    ok = (F.col("_acc") >= low) & (F.col("_acc") <= high) & (F.col("_len") < max_length - 1)
    m = df.join(per.select(group, ok.alias("pass")), group)
    return first_rows(m, int(df.count() // oversample), F.col("pass").desc(), F.col(group), F.col(row))


def trim_negative_prefix(steps: DataFrame, trajectory: str = "trajectory_id", step: str = "step") -> DataFrame:
    """Steps of failed trajectories count only past the average length of successful ones.

    steps: trajectory, step (from 0), reward. Failed ones that are shorter go.
    """
    sizes = steps.filter("reward > 0").groupBy(trajectory).agg(F.count("*").alias("n"))
    average = sizes.agg(F.coalesce(F.floor(F.avg("n")), F.lit(0))).scalar()
    return steps.withColumn("_a", average).filter((F.col("reward") != 0) | (F.col(step) >= F.col("_a"))).drop("_a")


def resample_weights(df: DataFrame, score: str, method: str = "pow", power: float = 2.0) -> DataFrame:
    """Adds ``weight``: abs(score) ** power, 1 for extremes (max_min), or 0.4 for the best and 0.1 (max_random), + 1e-8."""
    s = F.col(score)
    if method == "pow":
        return df.withColumn("weight", F.pow(F.abs(s), F.lit(power)) + 1e-8)
    top = df.agg(F.struct(F.max(score).alias("max"), F.min(score).alias("min"))).scalar()
    d = df.withColumn("_t", top)
    if method == "max_min":
        w = F.when((s == F.col("_t.max")) | (s == F.col("_t.min")), 1.0).otherwise(0.0)
    elif method == "max_random":
        w = F.when(s == F.col("_t.max"), 0.4).otherwise(0.1)
    else:
        raise ValueError(method)
    return d.withColumn("weight", w + 1e-8).drop("_t")


def resample(df: DataFrame, score: str, method: str = "pow", power: float = 2.0, seed: int = 0, row: str = "_row") -> DataFrame:
    """As many rows as df has, drawn with replacement in proportion to their weights.

    Each row's number of draws is the count of evenly spread points, shifted by a hash,
    in its interval of the running weight (systematic sampling): no join, and the
    running sum is one prefix per partition plus offsets.
    """
    weighted = materialize(resample_weights(df, score, method, power).repartitionByRange(row).sortWithinPartitions(row).withColumn("_pid", F.spark_partition_id()), "weights")
    sums = sorted((r[0], r[1], r[2]) for r in weighted.groupBy("_pid").agg(F.sum("weight"), F.count("*")).collect())
    offsets, upto = [], 0.0
    for pid, w, _ in sums:
        offsets.append((pid, upto))
        upto += w
    n = sum(c for _, _, c in sums)
    off = df.sparkSession.createDataFrame(offsets, "_pid int, _off double")
    run = F.sum("weight").over(W.partitionBy("_pid").orderBy(row).rowsBetween(W.unboundedPreceding, 0)) + F.col("_off")
    shift = F.lit(zlib.crc32(f"shift {seed}".encode()) % 10_000 / 10_000)
    placed = weighted.join(F.broadcast(off), "_pid").withColumn("_to", run)
    point = lambda x: F.floor(x / (upto or 1.0) * n + shift)
    draws = point(F.col("_to")) - point(F.col("_to") - F.col("weight"))
    each = placed.withColumn("_k", draws).filter("_k > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))))
    return number_rows(each.withColumnRenamed(row, "_src"), "_src", "_copy").drop("_pid", "_off", "_to", "_k", "_copy").withColumnRenamed("_src", "source_row")


def ready(n_rows: int, batch_min: int, per_task: int, waited: float, max_wait: float) -> bool:
    """Whether a batch may go: enough rows, or, with any rows, waited long enough."""
    return n_rows >= batch_min * per_task or (n_rows > 0 and waited >= max_wait)
