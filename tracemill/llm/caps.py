"""Capping records per dominant contributor, by mergeable quality histograms.

1. One pass builds a histogram per contributor: counts per quality bin. Counts
   add up, so partial histograms merge before and after the shuffle, and a
   contributor with a third of all rows is a few dozen counters per task.
2. From the top bin down, the bin in which the running count meets the cap is the
   contributor's cutoff bin; ``need`` records of it may stay.
3. Records in bins below the cutoff go. Only those in the cutoff bin are ranked. Caps of at
   most ``RANKED`` take ``row_number() <= need``: Spark limits each group to the cap before
   the shuffle, so a hot bin never comes together in one task. Greater caps and shares, for which
   Spark sets no such limit, are ranked by a range partition over contributor and order,
   which spreads a hot bin over many tasks, and counts per partition.

The bins divide the range of the scored qualities evenly. The binning need only be
monotone: any value falls into a bin, so the result is exact, and bins only decide how many
records get ranked.

Contributors whose histogram holds at least 1/HOT of all rows (at most HOT of them,
by counting) meet their cutoffs through a broadcast of at most HOT rows; all
others are joined by key, each with less than 1/HOT of the rows.

Defined cases: null, NaN and -1 qualities are unscored, last and equal among
themselves; null contributor columns form a contributor of their own; repeated
rows are removed by :func:`current_rows` first; ties are broken down to the id, so
the result is unique; an empty table gives an empty result; columns other than the
named ones are not used, and inner names begin with ``__`` so as not to meet them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.operators.batch import number_rows
from tracemill.session import materialize

#: RANKED is what Spark's spark.sql.optimizer.windowGroupLimitThreshold allows by default
BINS, HOT, RANKED = 64, 1000, 1000


def scored(q: Column) -> Column:
    """The quality, or null where it counts as unscored."""
    return F.when(F.isnan(q) | (q == -1), None).otherwise(q)


def quality_bin(q: Column, bins: int = BINS, low: float = 0.0, high: float = 1.0) -> Column:
    """0 for unscored, then 1..bins, growing with q; values outside [low, high] fall into the end bins."""
    width = (high - low) if high > low else 1.0
    inside = (F.least(F.greatest(q, F.lit(low)), F.lit(high)) - low) / width
    return F.when(q.isNull(), F.lit(0)).otherwise((F.floor(inside * (bins - 1)) + 1).cast("int"))


def current_rows(df: DataFrame, key: Sequence[str], id_col: str, *kept: str) -> DataFrame:
    """The row with the greatest id of each key; rows with equal ids are one row."""
    picked = F.max_by(F.struct(*kept), F.col(id_col)).alias("r")
    return df.filter(F.col(id_col).isNotNull()).groupBy(*key).agg(F.max(id_col).alias(id_col), picked).select(*key, id_col, "r.*")


def histograms(df: DataFrame, contributor: Sequence[str], bins: int = BINS, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """``contributor..., __bin, __n`` of rows that have a column ``__q``."""
    return df.groupBy(*contributor, quality_bin(F.col("__q"), bins, low, high).alias("__bin")).agg(F.count("*").alias("__n"))


def cutoffs(hist: DataFrame, contributor: Sequence[str], cap: Column) -> DataFrame:
    """``contributor..., __cut, __need, __total`` of contributors above their cap.

    A window over at most ``bins + 1`` rows per contributor.
    """
    w = W.partitionBy(*contributor)
    down = w.orderBy(F.col("__bin").desc()).rowsBetween(W.unboundedPreceding, 0)
    h = hist.withColumns({"__total": F.sum("__n").over(w), "__upto": F.sum("__n").over(down)}).withColumn("__cap", cap)
    met = (F.col("__upto") >= F.col("__cap")) & (F.col("__upto") - F.col("__n") < F.col("__cap"))
    return h.filter((F.col("__total") > F.col("__cap")) & met).select(*contributor, F.col("__bin").alias("__cut"), (F.col("__cap") - F.col("__upto") + F.col("__n")).alias("__need"), "__total")


def _match(df: DataFrame, cut: DataFrame, contributor: Sequence[str], *more: str) -> DataFrame:
    renamed = cut.select(*[F.col(c).alias(f"__{c}") for c in contributor], *more)
    on = F.lit(True)
    for c in contributor:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(renamed, on).drop(*[f"__{c}" for c in contributor])


def ranked(rows: DataFrame, contributor: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Adds ``__rk``, the place within the contributor from 1 on, without bringing a contributor into one task.

    Rows are numbered along a range partition over (contributor, order); a rank is the number
    less the contributor's first one.
    """
    keys = [F.col(c).asc_nulls_first() for c in contributor]
    numbered = number_rows(rows, *keys, *order, name="__no")
    first = numbered.groupBy(*contributor).agg(F.min("__no").alias("__first"), F.count("*").alias("__rows"))
    total = first.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    hot = max(1, total // HOT)
    out = None
    for part in (F.broadcast(first.filter(F.col("__rows") > hot)), first.filter(F.col("__rows") <= hot)):  # fewer than HOT rows are broadcast
        one = _match(numbered, part, contributor, "__first")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("__rk", F.col("__no") - F.col("__first") + 1).drop("__no", "__first")


def over_cap(rows: DataFrame, contributor: Sequence[str], q: str, then: Sequence[Column], id_col: str, cap: int | None = 8, share: float | None = None, bins: int = BINS) -> DataFrame:
    """Ids of the rows beyond the cap, best kept first.

    rows: unique ids. Order: q descending with unscored last, then ``then``.
    cap: the most records of a contributor; share: the most as a share of all rows
    (at least one record); the smaller of those given holds.
    """
    if cap is None and share is None:
        raise ValueError("cap or share must be given")
    base = materialize(rows.withColumn("__q", scored(F.col(q))), "caps")
    finite = F.when(F.abs("__q") < float("inf"), F.col("__q"))
    low, high = base.agg(F.coalesce(F.min(finite), F.lit(0.0)), F.coalesce(F.max(finite), F.lit(1.0))).first()
    hist = materialize(histograms(base, contributor, bins, low, high), "hist")
    n_rows = hist.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    most = min(x for x in (cap, None if share is None else max(1, int(share * n_rows))) if x is not None)
    cut = cutoffs(hist, contributor, F.lit(most).cast("long"))
    binned = base.withColumn("__bin", quality_bin(F.col("__q"), bins, low, high))
    least_hot = max(1, n_rows // HOT)
    hot = F.broadcast(cut.filter(F.col("__total") > least_hot))  # fewer than HOT rows, since each has more than n_rows / HOT
    cold = cut.filter(F.col("__total") <= least_hot)
    found = [_match(binned, part, contributor, "__cut", "__need").filter("__bin <= __cut") for part in (hot, cold)]
    met = materialize(found[0].unionByName(found[1]), "met")
    border, order = met.filter("__bin = __cut"), [F.col("__q").desc_nulls_last(), *then]
    if most <= RANKED:
        placed = border.withColumn("__rk", F.row_number().over(W.partitionBy(*contributor).orderBy(*order))).filter(F.col("__rk") <= most)
    else:
        placed = ranked(border, contributor, order)
    kept = placed.filter("__rk <= __need").select(id_col)
    return met.select(id_col).join(kept, id_col, "left_anti")
