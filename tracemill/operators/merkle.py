"""Processing only new or changed records, by a Merkle tree over key ranges.

A tree is a small table per level, ``(node, d1, d2, n)``. Level 0 holds the leaves:
one per range of ``2**leaf_bits`` neighbouring keys, with two 64-bit digests of
the rows in it. A node of level k covers ``2**fan_bits`` nodes of level k-1 and
digests their digests, up to a level of at most ``2**fan_bits`` nodes. Two trees are
compared from the top; a level is looked at only below nodes that differ, and rows are
compared only inside differing leaves.

:class:`ChangeLog` keeps the rows and the tree of the last successful run. The rows lie
sorted by key, and of them only the key ranges of differing leaves are read: at most
``RANGES`` ranges, which reach the scan as filters on the key.

Cost: one aggregation of the tracked columns by key on each side (partial before
the shuffle, so a key repeated in a third of the rows is one row per task after
it), and tables that shrink by ``2**fan_bits`` per level. What comes to the driver is
the span of the keys and at most ``RANGES`` ranges.

Defined cases: rows with a null key have no identity and are ignored; repeated
rows of a key are one record, and if they differ, one of the rows is the record, the same
in each run; null equals null and differs
from any value; an empty current table gives no additions or changes, an empty
saved table makes every key an addition. Other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.session import materialize

LEAF_BITS, FAN_BITS, RANGES = 6, 6, 256


def records(df: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """One row ``(k, v0, v1, ...)`` per non-null key; of several rows that with the greatest hash."""
    names = [f"v{i}" for i in range(len(tracked))]
    src = df.select(F.col(key).cast("long").alias("k"), *[F.col(c).alias(n) for c, n in zip(tracked, names)])
    marked = src.filter(F.col("k").isNotNull()).withColumn("h", _digest(names, 0))
    return marked.groupBy("k").agg(*[F.max_by(n, "h").alias(n) for n in names])


def _digest(cols: Sequence[str], salt: int) -> Column:
    # Spark's hash skips nulls, so whether a value is null is hashed as well
    parts = [F.lit(salt)]
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


def tree(rows: DataFrame, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> list[DataFrame]:
    """Levels ``(node, d1, d2, n)`` of the tree over rows of :func:`records`, leaves first."""
    cols = rows.columns
    level = (
        rows.select(F.shiftright("k", leaf_bits).alias("node"), _digest(cols, 1).alias("h1"), _digest(cols, 2).alias("h2"))
        .groupBy("node")
        .agg(F.bit_xor("h1").alias("d1"), F.bit_xor("h2").alias("d2"), F.count("*").alias("n"))
    )
    level = materialize(level, "leaves")  # the levels above are read from it, not from the rows again
    low, high = level.agg(F.min("node"), F.max("node")).first()
    out = [level]
    span = 0 if low is None else high - low
    while span >> fan_bits:
        level = (
            level.select(
                F.shiftright("node", fan_bits).alias("up"),
                F.xxhash64(F.lit(1), "node", "d1", "n").alias("h1"),
                F.xxhash64(F.lit(2), "node", "d2", "n").alias("h2"),
                "n",
            )
            .groupBy("up")
            .agg(F.bit_xor("h1").alias("d1"), F.bit_xor("h2").alias("d2"), F.sum("n").alias("n"))
            .withColumnRenamed("up", "node")
        )
        out.append(level)
        span >>= fan_bits
    return out


def changed_leaves(current: Sequence[DataFrame], saved: Sequence[DataFrame], fan_bits: int = FAN_BITS) -> DataFrame:
    """Leaves ``(node)`` whose digests differ, found by descending from the highest level that both trees have."""
    below: DataFrame | None = None
    for level in range(min(len(current), len(saved)) - 1, -1, -1):
        cur, old = current[level], saved[level]
        if below is not None:
            up = below.withColumnRenamed("node", "up")
            cur = cur.withColumn("up", F.shiftright("node", fan_bits)).join(up, "up", "left_semi").drop("up")
            old = old.withColumn("up", F.shiftright("node", fan_bits)).join(up, "up", "left_semi").drop("up")
        both = cur.alias("a").join(old.alias("b"), F.col("a.node") == F.col("b.node"), "full_outer")
        same = F.col("a.d1").eqNullSafe(F.col("b.d1")) & F.col("a.d2").eqNullSafe(F.col("b.d2")) & F.col("a.n").eqNullSafe(F.col("b.n"))
        below = both.filter(~same).select(F.coalesce("a.node", "b.node").alias("node"))
    assert below is not None
    return below


def key_ranges(leaves: DataFrame, leaf_bits: int = LEAF_BITS, most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges (first key, last key) that hold all keys of the leaves."""
    low, high = leaves.agg(F.min("node"), F.max("node")).first()
    if low is None:
        return []
    width = (high - low) // most + 1
    found = leaves.groupBy(F.floor((F.col("node") - low) / width).alias("b")).agg(F.min("node").alias("x"), F.max("node").alias("y"))
    out: list[tuple[int, int]] = []
    for r in sorted(found.select("x", "y").collect()):
        if out and r.x == out[-1][1] + 1:
            out[-1] = (out[-1][0], r.y)
        else:
            out.append((r.x, r.y))
    return [(x << leaf_bits, ((y + 1) << leaf_bits) - 1) for x, y in out]


def inside(rows: DataFrame, leaves: DataFrame, leaf_bits: int = LEAF_BITS, ranges: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Rows of the leaves. The ranges, if given, hold them all and are looked at first, in the scan."""
    if ranges is not None:
        keep = F.lit(False)
        for x, y in ranges:
            keep = keep | F.col("k").between(x, y)
        rows = rows.filter(keep)
    return rows.withColumn("node", F.shiftright("k", leaf_bits)).join(leaves, "node", "left_semi").drop("node")


def compare(current: DataFrame, saved: DataFrame) -> DataFrame:
    """``(k, change)`` from rows of both sides, change being ``added``, ``changed`` or ``removed``."""
    a, b = current.alias("a"), saved.alias("b")
    same = F.lit(True)
    for c in current.columns:
        if c != "k":
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    both = a.join(b, F.col("a.k") == F.col("b.k"), "full_outer")
    change = F.when(F.col("b.k").isNull(), "added").when(F.col("a.k").isNull(), "removed").when(~same, "changed")
    return both.select(F.coalesce("a.k", "b.k").alias("k"), change.alias("change")).filter(F.col("change").isNotNull())


def diff(current: DataFrame, saved: DataFrame, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """``(k, change)`` between two tables of :func:`records` of which neither has a tree yet.

    Their aggregated rows and leaves are written once to the shared folder, as the trees
    and the comparison of rows read them again.
    """
    current, saved = materialize(current, "current"), materialize(saved, "saved")
    leaves = changed_leaves(tree(current, leaf_bits, fan_bits), tree(saved, leaf_bits, fan_bits), fan_bits)
    return compare(inside(current, leaves, leaf_bits), inside(saved, leaves, leaf_bits))


class ChangeLog:
    """State folder of a job that processes each added or changed record once.

    A run writes its output, the rows it saw and their tree to a new version
    folder, and only then moves the name ``CURRENT`` to it, in one rename. A run
    that dies before has published nothing and the next one does its work again;
    one that dies after has published everything. Runs must not overlap. A run removes
    the versions of runs that died and, once it is published, all but the version before it.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, tracked: Sequence[str], leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS):
        self.spark, self.folder, self.key, self.tracked = spark, folder.rstrip("/"), key, list(tracked)
        self.leaf_bits, self.fan_bits = leaf_bits, fan_bits
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> str | None:
        p = self._path(f"{self.folder}/CURRENT")
        if not self._fs.exists(p):
            return None
        return json.loads("\n".join(r.value for r in self.spark.read.text(p.toString()).collect()))["version"]

    def _versions(self) -> list[str]:
        here = self._path(self.folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(here)] if self._fs.exists(here) else []
        return [n for n in names if n.startswith("v-")]

    def _clean(self, kept: Sequence[str | None]) -> None:
        for v in self._versions():
            if v not in kept:
                self._fs.delete(self._path(f"{self.folder}/{v}"), True)

    def rows(self, v: str) -> DataFrame:
        """The rows that a version saw."""
        return self.spark.read.parquet(f"{self.folder}/{v}/rows")

    def tree(self, v: str) -> list[DataFrame]:
        """The tree that a version published."""
        at, out = f"{self.folder}/{v}/tree", []
        while self._fs.exists(self._path(f"{at}/{len(out)}")):
            out.append(self.spark.read.parquet(f"{at}/{len(out)}"))
        return out

    def _write(self, df: DataFrame, v: str) -> None:
        """The rows, sorted by key so that a range of keys is read alone, and their tree."""
        at = f"{self.folder}/{v}"
        records(df, self.key, self.tracked).sortWithinPartitions("k").write.parquet(f"{at}/rows")
        for i, level in enumerate(tree(self.rows(v), self.leaf_bits, self.fan_bits)):
            level.write.parquet(f"{at}/tree/{i}")

    def _changes(self, v: str, old: str | None) -> DataFrame:
        rows = self.rows(v)
        if old is None:
            return rows.select("k", F.lit("added").alias("change"))
        leaves = materialize(changed_leaves(self.tree(v), self.tree(old), self.fan_bits), "differing")
        ranges = key_ranges(leaves, self.leaf_bits)
        return compare(*[inside(r, leaves, self.leaf_bits, ranges) for r in (rows, self.rows(old))])

    def pending(self, df: DataFrame) -> DataFrame:
        """The changes ``(k, change)`` since the last published run."""
        old = self.version()
        self._clean([old])
        v = f"v-{uuid.uuid4().hex}"
        self._write(df, v)
        return self._changes(v, old)

    def run(self, df: DataFrame, work: Callable[[DataFrame], DataFrame]) -> str:
        """Gives work the rows of df that were added or changed and publishes its result with the new tree."""
        old = self.version()
        self._clean([old, *[x for x in [self._before()] if x]])
        v = f"v-{uuid.uuid4().hex}"
        self._write(df, v)
        changed = self._changes(v, old).filter("change <> 'removed'")
        fresh = df.join(changed.select(F.col("k").alias("__k")), F.col(self.key) == F.col("__k"), "left_semi")
        work(fresh).write.parquet(f"{self.folder}/{v}/output")
        self._publish(v, old)
        self._clean([v, old])
        return v

    def _before(self) -> str | None:
        p = self._path(f"{self.folder}/CURRENT")
        return json.loads("\n".join(r.value for r in self.spark.read.text(p.toString()).collect())).get("before") if self._fs.exists(p) else None

    def _publish(self, v: str, old: str | None) -> None:
        tmp = self._path(f"{self.folder}/.CURRENT-{v}")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps({"version": v, "before": old}).encode()))
        out.close()
        options = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        array = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        array[0] = options
        context.rename(tmp, self._path(f"{self.folder}/CURRENT"), array)

    def output(self) -> DataFrame | None:
        v = self.version()
        return None if v is None else self.spark.read.parquet(f"{self.folder}/{v}/output")


def last_seen(seen: DataFrame, runs: DataFrame) -> DataFrame:
    """``(k, v0, v1)``: used and create_at as the greatest successful run saw them.

    runs is the table of monitor runs, whose size doesn't grow with the data.
    """
    good = runs.filter(F.col("status") == "COMPLETED").select("sync_no").distinct()
    rows = seen.select("sync_no", F.col("rollout_id").alias("k"), "used", "create_at").filter("k is not null").join(good, "sync_no", "left_semi")
    return rows.groupBy("k").agg(F.max_by("used", "sync_no").alias("v0"), F.max_by("create_at", "sync_no").alias("v1"))
