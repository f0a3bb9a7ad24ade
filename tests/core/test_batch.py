import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tracemill.operators import batch as b


def make(spark, n=6):
    return b.from_columns(spark, {"obs": list(range(1, n + 1)), "label": list("abcdefgh"[:n])})


def rows(df, *cols):
    r = df.orderBy("_row").collect()
    assert [x["_row"] for x in r] == list(range(len(r)))
    return [[x[c] for x in r] for c in cols]


def test_reorder(spark):
    assert rows(b.reorder(make(spark), [3, 4, 2, 0, 1, 5]), "obs", "label") == [[4, 5, 3, 1, 2, 6], list("decabf")]
    with pytest.raises(b.BatchError):
        b.reorder(make(spark), [0, 0, 1])


def test_chunk_and_concat(spark):
    parts = b.chunk(make(spark), 2)
    assert [rows(p, "obs")[0] for p in parts] == [[1, 2, 3], [4, 5, 6]]
    assert rows(b.concat(parts), "obs")[0] == [1, 2, 3, 4, 5, 6]
    with pytest.raises(b.BatchError):
        b.chunk(make(spark), 4)


def test_repeat(spark):
    assert rows(b.repeat(make(spark, 3), 2), "label")[0] == list("aabbcc")
    assert rows(b.repeat(make(spark, 3), 2, interleave=False), "label")[0] == list("abcabc")
    assert rows(b.repeat_each(make(spark, 3), F.col("obs") - 1), "label")[0] == list("bcc")


@pytest.mark.parametrize("divisor,extra,labels", [(2, 1, "abca"), (3, 0, "abc"), (7, 4, "abcabca")])
def test_pad(spark, divisor, extra, labels):
    padded, n = b.pad_to_divisor(make(spark, 3), divisor)
    assert n == extra and rows(padded, "label")[0] == list(labels)
    assert rows(b.unpad(padded, n), "label")[0] == list("abc")


def test_fold_unfold(spark):
    folded = b.fold(b.repeat(make(spark, 3), 2), 2)
    assert rows(folded, "label")[0] == [["a", "a"], ["b", "b"], ["c", "c"]]
    assert rows(b.unfold(b.reorder(folded, [1, 2, 0]), 2), "label")[0] == list("bbccaa")


def test_union(spark):
    x = make(spark, 3)
    assert b.union(x, x.withColumn("more", F.lit(1))).columns == ["_row", "obs", "label", "more"]
    with pytest.raises(PySparkException, match="shared columns differ"):
        b.union(x, x.withColumn("obs", F.col("obs") + 1)).collect()
    nan = x.withColumn("v", F.lit(float("nan")))
    assert b.union(nan, nan).count() == 3
    with pytest.raises(b.BatchError):
        b.union_meta({"a": 1}, {"a": 2})
    with pytest.raises(b.BatchError):
        b.from_columns(spark, {"a": [1], "b": [1, 2]})


def test_slices_like_python(spark):
    x, full = make(spark), list("abcdef")
    for s in [(1, 4, 1), (None, None, 2), (-3, None, 1), (None, -2, 1), (4, 0, -2), (None, None, -1), (10, 20, 1)]:
        assert rows(b.slice_rows(x, *s), "label")[0] == full[slice(*s)]


def test_padding_and_counts(spark):
    x = make(spark, 3).withColumn("reward", F.lit(1.0))
    full, factor = b.upsample_with_padding(x.withColumnRenamed("label", "uid"), 4)
    got = rows(full, "uid", "reward")
    assert got == [["a", "b", "c", "padding"], [1.0, 1.0, 1.0, 0.0]] and factor == 4 / 3
    assert b.upsample_with_padding(x, 3)[1] == 1.0
    assert rows(b.fit_count(make(spark), 4, most=4), "obs")[0] == sorted(rows(b.fit_count(make(spark), 4, most=4), "obs")[0])
    assert b.fit_count(make(spark), 4, most=100).count() == 8
    assert b.pad_with_row(x, 2, "last").orderBy("_row").collect()[-1].label == "c"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(range(6)))
def test_reorder_back(spark, p):
    inverse = [p.index(i) for i in range(6)]
    assert rows(b.reorder(b.reorder(make(spark), list(p)), inverse), "obs")[0] == [1, 2, 3, 4, 5, 6]


def test_number_rows_over_partitions(spark):
    df = spark.range(1000).repartition(7).withColumn("k", 999 - F.col("id"))
    got = b.number_rows(df, "k").orderBy("_row").collect()
    assert [r["_row"] for r in got] == list(range(1000)) and [r.k for r in got] == list(range(1000))
    assert b.number_rows(df.limit(0), "k").count() == 0
