"""Windows over trajectories: stepwise samples, sliding windows, image and text limits.

Messages are ``array<struct<role, content: array<struct<type, text, image>>>>``. All
operators are array expressions and explodes within a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "cast(array() as array<int>)"


def _range(start, stop: Column, step: int) -> Column:
    """start, start + step, ... below stop; empty where there is none."""
    return F.when(stop > start, F.sequence(F.lit(start), stop - 1, F.lit(step))).otherwise(F.expr(EMPTY))


def n_images(message: Column) -> Column:
    return F.coalesce(F.size(F.filter(message["content"], lambda c: c["type"] == "image")), F.lit(0))


def limit_images(messages: Column, most: int) -> Column:
    """Counting images from the end, every message that brings the count over ``most`` loses its images; emptied messages go."""
    counts = F.transform(messages, n_images)
    from_here = lambda i: F.aggregate(F.slice(counts, i + 1, F.size(counts)), F.lit(0), lambda s, x: s + x)
    stripped = F.transform(
        messages,
        lambda m, i: F.struct(m["role"].alias("role"), F.when(from_here(i) > most, F.filter(m["content"], lambda c: c["type"] != "image")).otherwise(m["content"]).alias("content")),
    )
    within = F.aggregate(counts, F.lit(0), lambda s, x: s + x) <= most
    return F.when(within, messages).otherwise(F.filter(stripped, lambda m: m["content"].isNotNull() & (F.size(m["content"]) > 0)))


def stepwise(df: DataFrame, messages: str, limit_messages: int, most_images: int | None = None) -> DataFrame:
    """One row per assistant step: ``step_end`` and ``window`` = the messages before it, at most ``limit_messages`` turns.

    A window that starts late has the system message and the instruction (its first
    item only) put before it.
    """
    m = F.col(messages)
    each = df.withColumn("step_end", F.explode(_range(3, F.size(m), 2)))
    start = F.greatest(F.lit(0), F.col("step_end") - 2 * limit_messages - 1)
    body = F.slice(m, start + 1, F.col("step_end") - start)
    body = limit_images(body, most_images) if most_images is not None else body
    second = F.get(m, F.lit(1))
    head = F.array(F.get(m, F.lit(0)), F.struct(second["role"].alias("role"), F.slice(second["content"], 1, 1).alias("content")))
    return each.withColumn("window_start", start).withColumn("window", F.when(start > 0, F.concat(head, body)).otherwise(body))


def sliding(df: DataFrame, messages: str, window: int, stride: int, text_num: int) -> DataFrame:
    """One row per window: ``chunk_index`` and ``window`` of ``window`` turns, moved by ``stride`` turns from message 1.

    Assistant texts of up to ``text_num`` turns before the window are kept; from the
    first window whose user message has a single item on, the instruction is cut to its
    first item.
    """
    m, n = F.col(messages), F.size(messages)
    starts = F.when((n >= 3) & (n + 1 - 2 * window >= 1), F.sequence(F.lit(1), n + 1 - 2 * window, F.lit(2 * stride))).otherwise(F.expr(EMPTY))
    each = df.withColumn("_starts", starts).select("*", F.posexplode("_starts").alias("chunk_index", "window_start"))
    s = F.col("window_start")
    before = F.filter(F.slice(m, F.greatest(s - 2 * text_num, F.lit(0)) + 1, s - F.greatest(s - 2 * text_num, F.lit(0))), lambda x: x["role"] == "assistant")
    skip = F.when(F.col("chunk_index") == 0, 1).otherwise(0)
    body = F.slice(m, s + skip + 1, F.least(F.lit(2 * window), n - s) - skip)
    single = F.exists(F.slice("_starts", 1, F.col("chunk_index") + 1), lambda i: F.size(F.get(m, i)["content"]) == 1)
    second = F.get(m, F.lit(1))
    instruction = F.struct(second["role"].alias("role"), F.when(single, F.slice(second["content"], 1, 1)).otherwise(second["content"]).alias("content"))
    return each.withColumn("window", F.concat(F.array(F.get(m, F.lit(0)), instruction), before, body)).drop("_starts")


def step_texts(df: DataFrame, messages: str) -> DataFrame:
    """Assistant messages by ordinal: ``ordinal`` (from 0) and ``text``."""
    mine = F.filter(messages, lambda x: x["role"] == "assistant")
    text = lambda x: F.array_join(F.transform(F.filter(x["content"], lambda c: c["type"] == "text"), lambda c: F.coalesce(c["text"], F.lit(""))), "")
    return df.withColumn("_t", F.transform(mine, text)).select("*", F.posexplode("_t").alias("ordinal", "text")).drop("_t")


def newest(items: Column, most: int) -> Column:
    """The last ``most`` elements, in order."""
    return F.when(F.size(items) > most, F.slice(items, F.size(items) - most + 1, most)).otherwise(items)


def log_spaced(n: Column, k: int) -> Column:
    """Sorted places (0..n-1) to keep of n items: the newest, k - 1 at exponentially growing distance, filled up from the newest."""
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr(EMPTY))
    if k <= 1:
        return F.when(n <= k, every).otherwise(F.array(n - 1))
    far = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda j: F.greatest(F.least(n - 1 - F.bround(F.exp(j * F.log(n.cast("double")) / (k - 1)) - 1).cast("int"), n - 1), F.lit(0)))
    first = F.array_distinct(F.concat(F.array(n - 1), far))
    rest = F.reverse(F.array_except(every, first))
    filled = F.concat(first, F.slice(rest, 1, F.greatest(F.lit(k) - F.size(first), F.lit(0))))
    return F.when(n <= k, every).otherwise(F.array_sort(filled))


def spaced_places(n: Column, k: int) -> Column:
    """k equally spaced places of n items (half to even), all if there are no more."""
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr(EMPTY))
    if k == 1:
        return F.when(n > 0, F.array(n - 1)).otherwise(every)
    return F.when(n <= k, every).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (n - 1) / (k - 1)).cast("int"))))


def align_logps(steps: DataFrame, logps: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """Steps with the log-probabilities of their ordinal; steps without are skipped."""
    return steps.join(logps, [key, "ordinal"])


def fit_logps(logps: Column, length: Column, size: int) -> Column:
    """Log-probabilities padded with zeros to size; all zeros where their number isn't the response's length."""
    ok = F.size(logps) == length
    return F.when(ok, F.slice(F.concat(logps, F.array_repeat(F.lit(0.0), size)), 1, size)).otherwise(F.array_repeat(F.lit(0.0), size))


def loss_mask(roles: Column, lengths: Column, prompts: Column) -> Column:
    """Token mask of a conversation: 1 on assistant tokens past their generation prompt, 0 elsewhere."""
    z = F.arrays_zip(roles.alias("r"), lengths.alias("n"), prompts.alias("p"))
    part = lambda x: F.when(x["r"] == "assistant", F.concat(F.array_repeat(F.lit(0), F.least(x["p"], x["n"])), F.array_repeat(F.lit(1), F.greatest(x["n"] - x["p"], F.lit(0))))).otherwise(F.array_repeat(F.lit(0), x["n"]))
    return F.flatten(F.transform(z, part))


def merge_tool_turns(df: DataFrame, conversation: str, position: str, role: str = "role") -> DataFrame:
    """Adds ``turn``: neighbouring tool messages are one turn."""
    from pyspark.sql import Window as W

    w = W.partitionBy(conversation).orderBy(position)
    new = F.when((F.col(role) == "tool") & (F.lag(role).over(w) == "tool"), 0).otherwise(1)
    return df.withColumn("_n", new).withColumn("turn", F.sum("_n").over(w) - 1).drop("_n")
