"""Ways to hand a batch to ranks and to put their results together again.

``rank`` is a column, so every mode is one plan: ranks are partitions of it, and a
function of a rank's rows is ``groupBy("rank").applyInPandas`` or any plan that keeps it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators.batch import ROW, BatchError

PAD = "_pad"


def to_all(df: DataFrame, ranks: int) -> DataFrame:
    """Every rank gets all rows."""
    return df.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))))


def to_each(parts: Sequence[DataFrame]) -> DataFrame:
    """Rank i gets the i-th part."""
    out = None
    for i, p in enumerate(parts):
        one = p.withColumn("rank", F.lit(i))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise BatchError("no parts")
    return out


def split(df: DataFrame, ranks: int, pad: bool = False) -> DataFrame:
    """Neighbouring rows in equal shares; with pad the first rows again fill the last share up, flagged ``_pad`` (counts rows).

    Without pad a number of rows that ranks don't divide raises BatchError.
    """
    n = df.count()
    short = -n % ranks
    if short and not pad:
        raise BatchError(f"{n} rows don't divide into {ranks} ranks")
    own = df.withColumn(PAD, F.lit(False))
    if short and n:
        turns = F.explode(F.sequence(F.lit(0), F.lit((short - 1) // n)))
        more = df.withColumn("_turn", turns).withColumn("_to", F.col("_turn") * n + F.col(ROW)).filter(F.col("_to") < short)
        own = own.unionByName(more.withColumn(ROW, F.col("_to") + n).drop("_turn", "_to").withColumn(PAD, F.lit(True)))
    size = max(1, (n + short) // ranks)
    return own.withColumn("rank", F.floor(F.col(ROW) / size).cast("int"))


def collect(df: DataFrame) -> DataFrame:
    """The rows of all ranks in their order, without pads."""
    return df.filter(~F.col(PAD)).drop("rank", PAD)


def of_rank(df: DataFrame, rank: int = 0) -> DataFrame:
    """The rows of one rank alone."""
    return df.filter(F.col("rank") == rank).drop("rank")


def run(df: DataFrame, ranks: int, work: Callable, schema: str, pad: bool = True) -> DataFrame:
    """Splits, lets ``work`` map each rank's rows as a pandas frame, and collects; schema is that of its result, ``_row`` and ``_pad`` included."""
    return collect(split(df, ranks, pad).groupBy("rank").applyInPandas(lambda pdf: work(pdf), f"{schema}, rank int"))
