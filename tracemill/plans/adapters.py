"""Views of the test tables in the shapes that the operators take, for Spark and, as SQL text, for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.session import table

LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

#: long form of the token batch: one row per line item, a row of the batch per order
TOKENS = """tok AS (SELECT l_orderkey AS _row, l_orderkey % 997 AS uid, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS pos,
 l_discount * 0.987654321 AS r, l_tax AS v, l_quantity AS q, l_extendedprice AS x FROM lineitem),
t AS (SELECT _row, uid, pos, r, v, CAST(CASE WHEN pos = 0 OR q <= 40 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS m, v - 0.04 AS a, -x / 99991 AS lp, -x / 99991 + (r - 0.05) AS op, -x / 99991 + (r - 0.05) - (v - 0.04) / 2 AS ro, -v * 10 AS rf FROM tok)
"""


def token_batch(spark: SparkSession, d: str) -> DataFrame:
    """_row, uid and per-token arrays rewards, values, mask, advantages, logp, old_logp, rollout_logp, ref_logp."""
    li = table(spark, d, "lineitem", *LINE, "l_discount", "l_tax", "l_quantity", "l_extendedprice")
    s = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", (F.col("l_discount") * 0.987654321).alias("r"), F.col("l_tax").alias("v"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("x"))))
    rows = li.groupBy(F.col("l_orderkey").alias("_row")).agg(s.alias("s"))
    a = lambda f: F.transform("s", f)
    lp, op = lambda z: -z["x"] / 99991, lambda z: -z["x"] / 99991 + (z["r"] - 0.05)
    return rows.select(
        "_row",
        (F.col("_row") % 997).alias("uid"),
        a(lambda z: z["r"]).alias("rewards"),
        a(lambda z: z["v"]).alias("values"),
        a(lambda z, i: F.when((i == 0) | (z["q"] <= 40), 1.0).otherwise(0.0)).alias("mask"),
        a(lambda z: z["v"] - 0.04).alias("advantages"),
        a(lp).alias("logp"),
        a(op).alias("old_logp"),
        a(lambda z: op(z) - (z["v"] - 0.04) / 2).alias("rollout_logp"),
        a(lambda z: -z["v"] * 10).alias("ref_logp"),
    )


def long(df: DataFrame, *arrays: str) -> DataFrame:
    """(_row, pos, array values rounded to 6)."""
    each = df.select("_row", F.posexplode(F.arrays_zip(*arrays)).alias("pos", "z"))
    return each.select("_row", "pos", *[(F.round(F.col(f"z.{c}"), 6) + 0.0).alias(c) for c in arrays])


#: the catalog without repeated rows, one row per rollout; rewards that are NaN count as null
CATALOG = """cat AS (SELECT id, run_id, trajectory_id, task_id, CASE WHEN isnan(reward) THEN NULL ELSE reward END AS reward, num_chunks, used, model_version, create_at FROM (
 SELECT *, row_number() OVER (PARTITION BY run_id, trajectory_id ORDER BY id DESC) AS rk FROM rollout_run WHERE id IS NOT NULL) z WHERE rk = 1)
"""


_ROLLOUT = ["id", "task_id", "reward", "num_chunks", "used", "model_version", "create_at"]


def catalog(spark: SparkSession, d: str) -> DataFrame:
    return current(table(spark, d, "rollout_run", "run_id", "trajectory_id", *_ROLLOUT))


def current(rows: DataFrame) -> DataFrame:
    """The current row of each rollout."""
    cols = _ROLLOUT
    src = rows.filter("id is not null")
    one = src.groupBy("run_id", "trajectory_id").agg(F.max_by(F.struct(*cols), "id").alias("r")).select("run_id", "trajectory_id", "r.*")
    return one.withColumn("reward", F.when(~F.isnan("reward"), F.col("reward")))
