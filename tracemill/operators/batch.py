"""Batch algebra on DataFrames with an explicit order column ``_row`` (0..n-1).

Each function returns a lazy plan unless it says that it counts rows first. Row
numbers are dense and follow the result's order. Work is per row except where a
join on ``_row`` is named; index lists come as Python sequences (their size is that of
the result on the driver) or as DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.session import materialize

ROW = "_row"


class BatchError(ValueError):
    """A batch invariant doesn't hold."""


def number_rows(df: DataFrame, *keys: str | Column, name: str = ROW) -> DataFrame:
    """Adds ``_row``, or a column of another name, by the order of keys, which should be unique, without one task holding all rows.

    Rows are range-partitioned and sorted; each partition's rows are counted and
    offsets (one number per partition) come back through a broadcast.
    """
    part = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    mono = F.monotonically_increasing_id()
    marked = materialize(part.withColumns({"__pid": F.shiftright(mono, 33), "__at": mono.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = sorted((r[0], r[1]) for r in marked.groupBy("__pid").agg(F.max("__at") + 1).collect())
    upto, offsets = 0, []
    for pid, n in sizes:
        offsets.append((pid, upto))
        upto += n
    off = df.sparkSession.createDataFrame(offsets, "__pid long, __off long")
    return marked.join(F.broadcast(off), "__pid").withColumn(name, F.col("__at") + F.col("__off")).drop("__pid", "__at", "__off")


def running_total(df: DataFrame, value: str, group: Sequence[str], *order: str, name: str = "total") -> DataFrame:
    """Adds the running sum of value (null counts as 0) within each group, without bringing a group into one task.

    Rows are range-partitioned by (group, order); a row's total is the running sum of its partition, and what
    the group has in earlier partitions, of which there is at most one group per partition border.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    mono = F.shiftright(F.monotonically_increasing_id(), 33)
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__pid", mono), "totals")
    own = F.coalesce(F.col(value), F.lit(0))
    g = F.struct(*group)
    ends = placed.groupBy("__pid").agg(F.min(g).alias("a"), F.max(g).alias("z"))
    last = ends.select("__pid", F.col("z").alias("g"))
    sums = placed.withColumn("g", g).join(F.broadcast(last), ["__pid", "g"]).groupBy("__pid", "g").agg(F.sum(own).alias("s"))
    first_of = {r["__pid"]: r.a for r in ends.collect()}  # two values per partition
    carried, before = [], None
    for r in sorted(sums.collect(), key=lambda r: r["__pid"]):
        pid = r["__pid"]
        into = before[1] if before is not None and before[0] == first_of[pid] else 0
        carried.append((pid, into))
        before = (r.g, r.s + (into if r.g == first_of[pid] else 0))
    off = df.sparkSession.createDataFrame(carried, "__pid long, __in long") if carried else df.sparkSession.createDataFrame([], "__pid long, __in long")
    w = W.partitionBy("__pid", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, 0)
    joined = placed.join(F.broadcast(off), "__pid", "left").join(F.broadcast(ends.select("__pid", "a")), "__pid")
    into = F.when(g.eqNullSafe(F.col("a")), F.coalesce("__in", F.lit(0))).otherwise(0)
    return joined.withColumn(name, (F.sum(own).over(w) + into).cast("long")).drop("__pid", "__in", "a")


def first_rows(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """The first n rows by keys. Unlike a sorted limit, n rows never come together in one task."""
    return number_rows(df, *keys).filter(F.col(ROW) < n).drop(ROW)


def from_columns(spark: SparkSession, columns: Mapping[str, Sequence], num_rows: int | None = None) -> DataFrame:
    """A batch from equally long Python lists (B1, B2); other lengths raise BatchError."""
    lengths = {k: len(v) for k, v in columns.items()}
    if len(set(lengths.values())) > 1 or (num_rows is not None and set(lengths.values()) != {num_rows}):
        raise BatchError(f"columns differ in length: {lengths}")
    rows = [(i, *vals) for i, vals in enumerate(zip(*columns.values()))]
    return spark.createDataFrame(rows, [ROW, *columns])


def select(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(ROW, *columns)


def pop(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(what is left, what was taken); both keep ``_row``."""
    return df.drop(*columns), df.select(ROW, *columns)


def rename(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    if len(old) != len(new):
        raise BatchError("as many new names as old ones are needed")
    return df.withColumnsRenamed(dict(zip(old, new)))


def gather(df: DataFrame, index: Sequence[int] | DataFrame) -> DataFrame:
    """Rows by index, in that order; repeats stay repeated, negative indices count from the end."""
    if not isinstance(index, DataFrame):
        n = df.count() if any(i < 0 for i in index) else 0
        index = df.sparkSession.createDataFrame([(p, i + n if i < 0 else i) for p, i in enumerate(index)], "_pos long, _idx long")
    return df.join(index, df[ROW] == index["_idx"]).drop(ROW, "_idx").withColumnRenamed("_pos", ROW)


def mask(df: DataFrame, keep: Column) -> DataFrame:
    """Rows where keep holds, numbered anew."""
    return number_rows(df.filter(keep), ROW) if ROW not in df.columns else _renumber(df.filter(keep))


def _renumber(df: DataFrame) -> DataFrame:
    return number_rows(df.withColumnRenamed(ROW, "_old"), "_old").drop("_old")


def slice_rows(df: DataFrame, start: int | None = None, stop: int | None = None, step: int = 1, size: int | None = None) -> DataFrame:
    """Python's slice; negative bounds need the size, counted if not given."""
    if (start or 0) < 0 or (stop is not None and stop < 0) or step < 0:
        size = df.count() if size is None else size
    a, b, s = slice(start, stop, step).indices(size if size is not None else 1 << 62)
    r = F.col(ROW)
    inside = (r >= a) & (r < b) if s > 0 else (r <= a) & (r > b)
    return df.filter(inside & (F.pmod(r - a, F.lit(abs(s))) == 0)).withColumn(ROW, ((r - a) / s).cast("long"))


def reorder(df: DataFrame, permutation: Sequence[int]) -> DataFrame:
    if sorted(permutation) != list(range(len(permutation))):
        raise BatchError("not a permutation")
    return gather(df, permutation)


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of both; shared ones must be equal (null equals null, NaN equals NaN), else this raises at once."""
    shared = [c for c in a.columns if c in b.columns and c != ROW]
    right = b.withColumnsRenamed({c: f"_b_{c}" for c in shared})
    both = a.join(right, ROW)
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    if shared:
        both.filter(~same).select(F.raise_error(F.lit("shared columns differ"))).first()
    return both.drop(*[f"_b_{c}" for c in shared])


def union_meta(a: Mapping, b: Mapping) -> dict:
    """Both dictionaries; a key with two values raises BatchError."""
    clash = [k for k in a if k in b and a[k] != b[k]]
    if clash:
        raise BatchError(f"conflicting values of {clash}")
    return {**a, **b}


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, one after the other (one job counts the parts)."""
    sizes = {}
    if len(parts) > 1:
        each = [p.groupBy().agg(F.lit(i).alias("i"), F.count("*").alias("n")) for i, p in enumerate(parts[:-1])]
        counted = each[0]
        for c in each[1:]:
            counted = counted.unionByName(c)
        sizes = {r.i: r.n for r in counted.collect()}
    out, offset = parts[0], 0
    for i, df in enumerate(parts[1:]):
        offset += sizes[i]
        out = out.unionByName(df.withColumn(ROW, F.col(ROW) + offset))
    return out


def split_fixed(df: DataFrame, size: int, name: str = "batch") -> DataFrame:
    """Adds the number of the batch of ``size`` neighbouring rows."""
    return df.withColumn(name, F.floor(F.col(ROW) / size))


def deal(df: DataFrame, workers: int, name: str = "worker") -> DataFrame:
    """Adds the worker that gets the row, in turn."""
    return df.withColumn(name, F.col(ROW) % workers)


def chunk_no(n: int, chunks: int, even: bool = True) -> Column:
    """Number of the chunk of a row; chunks hold ceil(n / chunks) rows, the last fewer."""
    if chunks < 1 or (even and n % chunks):
        raise BatchError(f"{n} rows don't divide into {chunks} chunks")
    return F.floor(F.col(ROW) / max(1, -(-n // chunks)))


def chunk(df: DataFrame, chunks: int, even: bool = True) -> list[DataFrame]:
    n = df.count()
    no, size = chunk_no(n, chunks, even), max(1, -(-n // chunks))
    return [df.filter(no == k).withColumn(ROW, F.col(ROW) - k * size) for k in range(chunks)]


def repeat(df: DataFrame, times: int, interleave: bool = True, size: int | None = None) -> DataFrame:
    """Each row ``times`` times: aabbcc, or abcabc without interleave."""
    if times < 1:
        return df.filter(F.lit(False))
    each = df.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    if interleave:
        return each.withColumn(ROW, F.col(ROW) * times + F.col("_rep")).drop("_rep")
    n = df.count() if size is None else size
    return each.withColumn(ROW, F.col("_rep") * n + F.col(ROW)).drop("_rep")


def repeat_each(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as its own count says; 0 and less drop it."""
    each = df.withColumn("_rep", F.explode(F.when(times > 0, F.sequence(F.lit(0), times.cast("int") - 1)).otherwise(F.array().cast("array<int>"))))
    return number_rows(each.withColumnRenamed(ROW, "_old"), "_old", "_rep").drop("_old", "_rep")


def pad_to_divisor(df: DataFrame, divisor: int) -> tuple[DataFrame, int]:
    """(batch padded with its first rows, again from the head if needed; rows added). Counts rows."""
    n = df.count()
    extra = -n % divisor
    if n == 0 or extra == 0:
        return df, 0
    rounds = -(-extra // n)
    more = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn(ROW, F.col(ROW) + (F.col("_k") + 1) * n).drop("_k")
    return df.unionByName(more.filter(F.col(ROW) < n + extra)), extra


def unpad(df: DataFrame, extra: int) -> DataFrame:
    return df.filter(F.col(ROW) < df.count() - extra) if extra else df


def pad_with_row(df: DataFrame, size: int, candidate: str = "first") -> DataFrame:
    """``size`` more rows, all copies of the first row, or of the last one."""
    n = df.count()
    row = df.filter(F.col(ROW) == (0 if candidate == "first" else n - 1))
    return df if size < 1 else df.unionByName(row.withColumn(ROW, F.explode(F.sequence(F.lit(n), F.lit(n + size - 1)))))


def fold(df: DataFrame, size: int) -> DataFrame:
    """Every ``size`` rows as one row of arrays."""
    cols = [c for c in df.columns if c != ROW]
    packed = F.array_sort(F.collect_list(F.struct(ROW, *cols))).alias("_s")
    g = df.groupBy(F.floor(F.col(ROW) / size).alias("_g")).agg(packed)
    pick = lambda c: F.transform("_s", lambda s: s.getField(c)).alias(c)
    return g.select(F.col("_g").alias(ROW), *[pick(c) for c in cols])


def unfold(df: DataFrame, size: int) -> DataFrame:
    cols = [c for c in df.columns if c != ROW]
    each = df.select(ROW, F.posexplode(F.arrays_zip(*cols)).alias("_p", "_s"))
    return each.select((F.col(ROW) * size + F.col("_p")).alias(ROW), *[F.col(f"_s.{c}").alias(c) for c in cols])


def unfold_column_chunks(df: DataFrame, parts: int, split: Sequence[str]) -> DataFrame:
    """Each row as ``parts`` rows; arrays in split are cut into equal slices, other columns repeat."""
    each = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    width = lambda c: (F.size(c) / parts).cast("int")
    each = each.withColumns({c: F.slice(c, F.col("_k") * width(c) + 1, width(c)) for c in split})
    return each.withColumn(ROW, F.col(ROW) * parts + F.col("_k")).drop("_k")


def minibatches(df: DataFrame, size: int, epochs: int = 1, seed: int | None = None) -> DataFrame:
    """Adds ``epoch`` and ``batch``; with a seed every epoch has its own hash order. Counts rows.

    The order within an epoch comes from a sort by hash (range-partitioned).
    """
    n = df.count()
    if n % size:
        raise BatchError(f"{n} rows don't divide into batches of {size}")
    each = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    if seed is None:
        return each.withColumn("batch", F.floor(F.col(ROW) / size))
    mixed = number_rows(each.withColumnRenamed(ROW, "_src").withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", "_src"))), "epoch", "_h", "_src")
    return mixed.withColumn("batch", F.floor(F.pmod(F.col(ROW), F.lit(n)) / size)).drop("_h").withColumnRenamed("_src", "_source_row")


def split_by_share(df: DataFrame, share: float, seed: int, *keys: str, name: str = "part", first: str = "train", rest: str = "test") -> DataFrame:
    """Adds ``name``: exactly floor(n * share) rows, those first by a hash of seed and keys, are ``first``, the others ``rest``."""
    placed = number_rows(df.withColumn("__h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))), "__h", *keys, name="__no")
    n = placed.count()
    return placed.withColumn(name, F.when(F.col("__no") < int(n * share), first).otherwise(rest)).drop("__h", "__no")


def iterate(df: DataFrame, size: int) -> Iterator[DataFrame]:
    for k in range(-(-df.count() // size)):
        yield slice_rows(df, k * size, (k + 1) * size)


def hashed(seed: int, *columns: str) -> Column:
    """Hash of seed and columns as text, for choices that repeat anywhere."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def hashed_number(seed: int, *columns: str) -> Column:
    """The first 60 bits of :func:`hashed`."""
    return F.conv(F.substring(hashed(seed, *columns), 1, 15), 16, 10).cast("long")


def upsample(df: DataFrame, multiple: int, seed: int = 0) -> DataFrame:
    """Rows added, drawn by hash with replacement, until the count is a multiple."""
    n = df.count()
    extra = -n % multiple
    if not extra or not n:
        return df
    picks = df.sparkSession.range(extra).select((F.lit(n) + F.col("id")).alias("_pos"), F.pmod(hashed_number(seed, "id"), F.lit(n)).alias("_idx"))
    return df.unionByName(gather(df, picks).select(*df.columns))


def fit_count(df: DataFrame, multiple: int, most: int = 768, seed: int = 0) -> DataFrame:
    """Unchanged if the count divides; beyond ``most`` rows a hash sample of ``most`` in order, else upsampled."""
    n = df.count()
    if n % multiple == 0:
        return df
    if n > most:
        return _renumber(df.orderBy(hashed(seed, ROW), ROW).limit(most))
    return upsample(df, multiple, seed)


def upsample_with_padding(df: DataFrame, multiple: int, uid: str = "uid", zeroed: Sequence[str] = ("reward",), seed: int = 0) -> tuple[DataFrame, float]:
    """Like :func:`upsample`, with added rows marked: uid ``padding`` and zero rewards; also target / original count."""
    n = df.count()
    if n == 0 or n % multiple == 0:
        return df, 1.0
    full = upsample(df, multiple, seed)
    added = F.col(ROW) >= n
    marks = {uid: F.when(added, "padding").otherwise(F.col(uid))} | {c: F.when(added, F.lit(0.0)).otherwise(F.col(c)) for c in zeroed}
    return full.withColumns(marks), (n + -n % multiple) / n


def sampling_audit(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    """Rows per task before and after; the task is the id up to its first ``_``."""
    per = lambda df, name: df.groupBy(F.substring_index(id_col, "_", 1).alias("task")).agg(F.count("*").alias(name))
    both = per(before, "n_original").join(per(after, "n_final"), "task", "full_outer").fillna(0, ["n_original", "n_final"])
    return both.withColumn("delta", F.col("n_final") - F.col("n_original"))


def collate(df: DataFrame, *columns: str, size: int) -> DataFrame:
    """Every ``size`` rows as one row of arrays in row order, with ``batch``."""
    s = F.array_sort(F.collect_list(F.struct(ROW, *columns)))
    pick = lambda c: F.transform("s", lambda x: x.getField(c)).alias(c)
    return df.groupBy(F.floor(F.col(ROW) / size).alias("batch")).agg(s.alias("s")).select("batch", *[pick(c) for c in columns])


def size_report(df: DataFrame) -> DataFrame:
    """Values per column (elements of arrays) and rows."""
    n = lambda f: F.coalesce(F.sum(F.size(f.name)), F.lit(0)) if f.dataType.typeName() == "array" else F.count("*")
    one = df.agg(*[n(f).cast("long").alias(f.name) for f in df.schema if f.name != ROW])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in one.columns]), F.array(*one.columns))).alias("name", "n_values"))
