"""Reward managers: how a batch's rows get their token rewards, by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions import scoring
from tracemill.functions import tokens as t
from tracemill.operators.advantage import overlong_penalty

MANAGERS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str) -> Callable:
    """Registers a manager; a name taken by another function raises ValueError."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if MANAGERS.get(name, f) is not f:
            raise ValueError(f"reward manager {name} is already registered")
        MANAGERS[name] = f
        return f

    return add


def apply(df: DataFrame, manager: str, **options) -> DataFrame:
    """Adds ``rewards``, the score at the row's last valid token, by the manager of this name."""
    if manager not in MANAGERS:
        raise ValueError(f"unknown reward manager {manager}")
    return MANAGERS[manager](df, **options)


@register("rule")
def rule(df: DataFrame, score: Column) -> DataFrame:
    """A score per row, from a column."""
    return df.withColumn("rewards", t.place_last("mask", score))


@register("overlong")
def overlong(df: DataFrame, score: Column, most: int, buffer: int, factor: float = 1.0) -> DataFrame:
    """A score per row less a penalty for responses that run into the buffer before ``most`` tokens."""
    return df.withColumn("rewards", t.place_last("mask", score + overlong_penalty(t.total("mask"), most, buffer, factor)))


def judged(df: DataFrame, replies: DataFrame, key: str, cached: str = "cached", reply: str = "reply") -> DataFrame:
    """Adds ``score``: the row's cached reward where its text is a number, else the share of judges that said 1.

    replies: ``(key, reply)``, texts of several judges. A reply without a number isn't counted; a
    row without a cached reward and without a readable reply has a null score.
    """
    votes = replies.select(key, scoring.score_number(F.col(reply)).alias("__v")).groupBy(key).agg(F.avg("__v").alias("__votes"))
    own = F.trim(F.col(cached)).try_cast("double")
    return df.join(votes, key, "left").withColumn("score", F.coalesce(own, F.col("__votes"))).drop("__votes")


@register("judge")
def judge(df: DataFrame, replies: DataFrame, key: str, cached: str = "cached") -> DataFrame:
    scored = judged(df, replies, key, cached)
    return scored.withColumn("rewards", t.place_last("mask", F.col("score"))).drop("score")


def names() -> Sequence[str]:
    return sorted(MANAGERS)
