import random

import pytest
from pyspark.sql import functions as F

from tracemill.llm import caps

SCHEMA = "id long, who string, q double, at long"


def brute(rows, cap):
    best = {}
    for r in rows:
        best.setdefault(r[1], []).append(r)
    out = set()
    for own in best.values():
        key = lambda r: (0 if r[2] is None or r[2] != r[2] or r[2] == -1 else 1, r[2] if r[2] is not None and r[2] == r[2] and r[2] != -1 else 0, r[3] is not None, r[3] or 0, r[0])
        out |= {r[0] for r in sorted(own, key=key, reverse=True)[cap:]}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_contributor(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(1500):
        who = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None, *map(str, range(60))])
        q = rng.choice([0.0, 0.5, 1.0, None, float("nan"), -1.0, rng.random(), 7.0, -3.0])
        rows.append((i, who, q, rng.choice([None, 1, 2, 3])))
    df = spark.createDataFrame(rows, SCHEMA)
    got = caps.over_cap(df, ["who"], "q", [F.col("at").desc_nulls_last(), F.col("id").desc()], "id", cap=8)
    assert {r.id for r in got.collect()} == brute(rows, 8)


def test_all_equal_and_empty_and_share(spark):
    df = spark.range(200).select("id", F.lit("x").alias("who"), F.lit(1.0).alias("q"), F.lit(1).cast("long").alias("at"))
    order = [F.col("id").desc()]
    assert {r.id for r in caps.over_cap(df, ["who"], "q", order, "id", cap=8).collect()} == set(range(192))
    assert caps.over_cap(df, ["who"], "q", order, "id", cap=None, share=0.1).count() == 180
    assert caps.over_cap(df.limit(0), ["who"], "q", order, "id").count() == 0


@pytest.mark.parametrize("cap", [8, 40, 600])
def test_ranking_by_ranges_equals_the_window(spark, monkeypatch, cap):
    monkeypatch.setattr(caps, "RANKED", 8)
    rng = random.Random(cap)
    rows = [(i, "hot" if rng.random() < 0.8 else rng.choice(["a", "b", None]), rng.choice([1.0, 1.0, None, 0.5, 40.0, -7.5, float("inf"), float("nan"), rng.random()]), rng.choice([None, 1, 2])) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = caps.over_cap(df, ["who"], "q", [F.col("at").desc_nulls_last(), F.col("id").desc()], "id", cap=cap)
    assert {r.id for r in got.collect()} == brute(rows, cap)


def test_a_share_of_a_contributor_with_half_of_all_rows(spark):
    n = 200_000
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("who"), F.lit(1.0).alias("q"))
    out = caps.over_cap(df, ["who"], "q", [F.col("id").desc()], "id", cap=None, share=0.1)
    left = out.agg(F.count("*"), F.max("id")).first()
    assert tuple(left) == (n // 2 - n // 10, n - 2 * (n // 10) - 2)  # the newest tenth stays


def test_histograms_merge(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("who"), (F.col("id") / 100).alias("__q"))
    whole = caps.histograms(df, ["who"]).collect()
    parts = caps.histograms(df.filter("__q < 0.4"), ["who"]).unionByName(caps.histograms(df.filter("__q >= 0.4"), ["who"]))
    assert {tuple(r) for r in parts.groupBy("who", "__bin").agg(F.sum("__n")).collect()} == {tuple(r) for r in whole}


def test_other_columns_may_have_any_name(spark):
    df = spark.range(50).select("id", F.lit("x").alias("who"), F.lit(0.5).alias("reward"), *[F.lit(1).alias(c) for c in ("q", "bin", "need", "n", "total", "rk", "cut_bin")])
    assert caps.over_cap(df, ["who"], "reward", [F.col("id").desc()], "id", cap=8).count() == 42


def test_current_rows_take_the_greatest_id_and_drop_repeats(spark):
    df = spark.createDataFrame([(1, "k", 0.5, 1), (1, "k", 0.5, 1), (3, "k", None, 2), (2, "j", 0.1, 1), (None, "j", 0.9, 1)], SCHEMA)
    got = {r.who: (r.id, r.q) for r in caps.current_rows(df, ["who"], "id", "q").collect()}
    assert got == {"k": (3, None), "j": (2, 0.1)}
