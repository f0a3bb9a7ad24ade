"""Queries on the batch algebra; the batch is ``orders`` numbered by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.operators import batch as b
from tracemill.plans.registry import CORE
from tracemill.session import table

_O = "WITH o AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS _row, o_orderkey, o_orderstatus, o_totalprice FROM orders), n AS (SELECT count(*) AS n FROM o) "


def _b(s, d, *cols):
    return b.number_rows(table(s, d, "orders", "o_orderkey", *cols), "o_orderkey")


def _reg(name, sql, f, *cols):
    CORE.query(name, _O.rstrip() + sql.removeprefix("{}") if sql.startswith("{}") else _O + sql)(lambda s, d: f(_b(s, d, *cols)))


_reg("batch_number_rows", "SELECT _row, o_orderkey FROM o", lambda x: x.select("_row", "o_orderkey"))
_reg("batch_select", "SELECT _row, o_orderstatus FROM o", lambda x: b.select(x, "o_orderstatus"), "o_orderstatus", "o_totalprice")
_reg("batch_pop", "SELECT _row, o_totalprice FROM o", lambda x: b.pop(x, "o_totalprice")[1], "o_orderstatus", "o_totalprice")
_reg("batch_rename", "SELECT _row, o_orderkey AS key, o_orderstatus AS status FROM o", lambda x: b.rename(x, ["o_orderkey", "o_orderstatus"], ["key", "status"]), "o_orderstatus")
_reg("batch_gather", "SELECT CAST(i.p AS BIGINT) AS _row, o_orderkey FROM (VALUES (0, 5), (1, 3), (2, 3), (3, -1)) i(p, x) JOIN n ON true JOIN o ON o._row = CASE WHEN x < 0 THEN x + n ELSE x END", lambda x: b.gather(x, [5, 3, 3, -1]).select("_row", "o_orderkey"))
_reg(
    "batch_gather_frame",
    "SELECT _row AS _row, (SELECT o2.o_orderkey FROM o o2 WHERE o2._row = (o._row * 7) % n.n) AS o_orderkey FROM o, n",
    lambda x: b.gather(x, x.select(F.col("_row").alias("_pos"), F.pmod(F.col("_row") * 7, F.lit(x.count())).alias("_idx"))).select("_row", "o_orderkey"),
)
_reg("batch_mask", "SELECT CAST(row_number() OVER (ORDER BY _row) - 1 AS BIGINT) AS _row, o_orderkey FROM o WHERE o_orderstatus = 'F'", lambda x: b.mask(x, F.col("o_orderstatus") == "F").select("_row", "o_orderkey"), "o_orderstatus")
_reg("batch_slice", "SELECT CAST((_row - (n - 100)) / 3 AS BIGINT) AS _row, o_orderkey FROM o, n WHERE _row >= n - 100 AND _row < n - 10 AND (_row - (n - 100)) % 3 = 0", lambda x: b.slice_rows(x, -100, -10, 3).select("_row", "o_orderkey"))
_reg("batch_slice_reversed", "SELECT CAST((n - 1 - _row) / 2 AS BIGINT) AS _row, o_orderkey FROM o, n WHERE (n - 1 - _row) % 2 = 0", lambda x: b.slice_rows(x, None, None, -2).select("_row", "o_orderkey"))
_reg("batch_reorder", "SELECT CAST(CASE _row WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE 5 END AS BIGINT) AS _row, o_orderkey FROM o WHERE _row < 6", lambda x: b.reorder(b.slice_rows(x, 0, 6), [3, 4, 2, 0, 1, 5]).select("_row", "o_orderkey"))
_reg("batch_union", "SELECT _row, o_orderkey, o_orderstatus, o_totalprice FROM o", lambda x: b.union(x.select("_row", "o_orderkey", "o_orderstatus"), x.select("_row", "o_orderkey", "o_totalprice")).select("_row", "o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderstatus", "o_totalprice")
_reg("batch_concat", "SELECT _row, o_orderkey FROM o UNION ALL SELECT _row + n, o_orderkey FROM o, n WHERE _row < 10", lambda x: b.concat([x, b.slice_rows(x, 0, 10)]).select("_row", "o_orderkey"))
_reg("batch_chunk_no", "SELECT _row, CAST(floor(_row / ceil(n / 7.0)) AS BIGINT) AS chunk FROM o, n", lambda x: x.select("_row", b.chunk_no(x.count(), 7, even=False).alias("chunk")))
_reg("batch_chunk_second", "SELECT CAST(_row - ceil(n / 7.0) AS BIGINT) AS _row, o_orderkey FROM o, n WHERE floor(_row / ceil(n / 7.0)) = 1", lambda x: b.chunk(x, 7, even=False)[1].select("_row", "o_orderkey"))
_reg("batch_repeat_interleaved", "SELECT _row * 3 + r.i AS _row, o_orderkey FROM o, (VALUES (0), (1), (2)) r(i)", lambda x: b.repeat(x, 3).select("_row", "o_orderkey"))
_reg("batch_repeat_tiled", "SELECT r.i * n + _row AS _row, o_orderkey FROM o, n, (VALUES (0), (1), (2)) r(i)", lambda x: b.repeat(x, 3, interleave=False).select("_row", "o_orderkey"))
_reg(
    "batch_repeat_each",
    "SELECT CAST(row_number() OVER (ORDER BY _row, i) - 1 AS BIGINT) AS _row, o_orderkey FROM (SELECT _row, o_orderkey, unnest(range(o_orderkey % 3)) AS i FROM o)",
    lambda x: b.repeat_each(x, F.col("o_orderkey") % 3).select("_row", "o_orderkey"),
)
_reg("batch_pad_to_divisor", "SELECT _row, o_orderkey FROM o UNION ALL SELECT _row + n, o_orderkey FROM o, n WHERE _row < (128 - n % 128) % 128", lambda x: b.pad_to_divisor(x, 128)[0].select("_row", "o_orderkey"))
_reg("batch_unpad", "SELECT _row, o_orderkey FROM o", lambda x: b.unpad(*b.pad_to_divisor(x, 128)).select("_row", "o_orderkey"))
_reg("batch_pad_with_last", "SELECT _row, o_orderkey FROM o UNION ALL SELECT n + i, o_orderkey FROM o, n, (VALUES (0), (1), (2)) r(i) WHERE _row = n - 1", lambda x: b.pad_with_row(x, 3, "last").select("_row", "o_orderkey"))
_reg("batch_fold", "SELECT CAST(floor(_row / 4) AS BIGINT) AS _row, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY _row) AS keys FROM o GROUP BY 1", lambda x: b.fold(x, 4).select("_row", F.array_join("o_orderkey", ",").alias("keys")))
_reg("batch_unfold", "SELECT _row, o_orderkey FROM o", lambda x: b.unfold(b.fold(x, 4), 4).select("_row", "o_orderkey"))
_reg(
    "batch_unfold_column_chunks",
    "SELECT _row * 2 + k.i AS _row, o_orderkey, (o_orderkey + k.i * 2) || ',' || (o_orderkey + k.i * 2 + 1) AS part FROM o, (VALUES (0), (1)) k(i)",
    lambda x: b.unfold_column_chunks(x.withColumn("a", F.sequence("o_orderkey", F.col("o_orderkey") + 3)), 2, ["a"]).select("_row", "o_orderkey", F.array_join("a", ",").alias("part")),
)
_reg("batch_minibatches", "SELECT _row, o_orderkey, CAST(e.i AS INTEGER) AS epoch, CAST(floor(_row / 100) AS BIGINT) AS batch FROM o, (VALUES (0), (1)) e(i)", lambda x: b.minibatches(x, 100, 2).select("_row", "o_orderkey", "epoch", "batch"))
_reg("batch_split_fixed", "SELECT _row, CAST(floor(_row / 64) AS BIGINT) AS batch FROM o", lambda x: b.split_fixed(x, 64).select("_row", "batch"))
_reg(
    "batch_collate",
    "SELECT CAST(floor(_row / 512) AS BIGINT) AS batch, count(*) AS n, md5(string_agg(o_orderstatus, '' ORDER BY _row)) AS digest FROM o GROUP BY 1",
    lambda x: b.collate(x, "o_orderstatus", size=512).select("batch", F.size("o_orderstatus").cast("long").alias("n"), F.md5(F.array_join("o_orderstatus", "")).alias("digest")),
    "o_orderstatus",
)
_reg("batch_size_report", "SELECT unnest(['o_orderkey', 'o_orderstatus']) AS name, n AS n_values FROM n", b.size_report, "o_orderstatus")
_EXTRA = "e AS (SELECT n + i AS _row, ('0x' || substring(md5('0|' || i), 1, 15))::BIGINT % n AS src, i FROM n, range(768) t(i) WHERE i < (768 - n % 768) % 768)"
_reg("batch_upsample", f"{{}}, {_EXTRA} SELECT _row, o_orderkey FROM o UNION ALL SELECT e._row, o.o_orderkey FROM e JOIN o ON o._row = e.src", lambda x: b.upsample(x, 768).select("_row", "o_orderkey"))
_reg(
    "batch_fit_count",
    "{}, p AS (SELECT o_orderkey, _row FROM o ORDER BY md5('0|' || _row), _row LIMIT 768) SELECT CAST(row_number() OVER (ORDER BY _row) - 1 AS BIGINT) AS _row, o_orderkey FROM p",
    lambda x: b.fit_count(x, 7168).select("_row", "o_orderkey"),
)
_reg(
    "batch_upsample_padding",
    f"{{}}, {_EXTRA} SELECT _row, o_orderstatus AS uid, o_totalprice AS reward FROM o UNION ALL SELECT e._row, 'padding', 0.0 FROM e",
    lambda x: b.upsample_with_padding(x.withColumnsRenamed({"o_orderstatus": "uid", "o_totalprice": "reward"}), 768)[0].select("_row", "uid", "reward"),
    "o_orderstatus", "o_totalprice",
)
_reg(
    "batch_shuffled_minibatches",
    "SELECT CAST(row_number() OVER (ORDER BY e.i, md5('7|' || e.i || '|' || _row), _row) - 1 AS BIGINT) AS _row, _row AS _source_row, o_orderkey, CAST(e.i AS INTEGER) AS epoch, CAST(floor((row_number() OVER (PARTITION BY e.i ORDER BY md5('7|' || e.i || '|' || _row), _row) - 1) / 100) AS BIGINT) AS batch FROM o, (VALUES (0), (1)) e(i)",
    lambda x: b.minibatches(x, 100, 2, seed=7),
)
_reg("batch_mod_partition", "SELECT _row, _row % 5 AS worker FROM o", lambda x: b.deal(x, 5).select("_row", "worker"))
_reg("batch_head_tail_split", "SELECT _row, CASE WHEN _row < floor(n * 0.9) THEN 'train' ELSE 'test' END AS part FROM o, n", lambda x: x.select("_row", F.when(F.col("_row") < int(x.count() * 0.9), "train").otherwise("test").alias("part")))
