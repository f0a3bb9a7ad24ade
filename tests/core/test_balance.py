"""Length balancing of whole batches of any size."""

from collections import Counter, defaultdict

import pytest

from tracemill.operators import balance, metrics
from tracemill.plans import core

DATA = "/root/testdata/sf0.001"


def _batch_counts(spark):
    rows = spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("floor(l_orderkey / 256) AS batch", "CAST(l_quantity AS BIGINT) AS length").collect()
    counts, sums = Counter(r.batch for r in rows), Counter()
    for r in rows:
        sums[r.batch] += r.length
    return counts, sums


def test_imbalance_of_every_batch(spark):
    counts, sums = _batch_counts(spark)
    got = core().runs["balance_imbalance"](spark, DATA).collect()
    assert sorted(r.batch for r in got) == sorted(counts) and len(counts) > 1
    assert all(r.min <= r.mean <= r.max and r.minmax_diff == r.max - r.min for r in got)


def test_imbalance_counts_empty_parts(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 3), (2, 0, 4), (2, 1, 4), (2, 2, 7)], "batch int, part int, length long")
    got = {r.batch: tuple(r)[1:] for r in metrics.imbalance(df, "part", "length", "batch", 3).collect()}
    assert got == {1: (0, 5, 5, pytest.approx(8 / 3)), 2: (4, 7, 3, 5.0)}


@pytest.mark.parametrize("name", ["balanced_partitions", "greedy_partitions"])
def test_every_row_in_one_part(spark, name):
    counts, sums = _batch_counts(spark)
    assert any(n % 8 for n in counts.values())
    places, sizes, got = defaultdict(list), Counter(), Counter()
    for r in core().runs[name](spark, DATA).collect():
        places[r.batch].append(r.place)
        sizes[r.batch, r.part] += 1
        got[r.batch] += r.length
    assert {b: sorted(p) for b, p in places.items()} == {b: list(range(n)) for b, n in counts.items()}
    assert got == sums
    for b, n in counts.items():
        assert {sizes[b, p] for p in range(8)} <= {n // 8, -(-n // 8)}


def test_imbalance_sums_every_row(spark):
    sums = _batch_counts(spark)[1]
    assert {r.batch: round(r.mean * 8) for r in core().runs["balance_imbalance"](spark, DATA).collect()} == sums


@pytest.mark.parametrize("method", ["karmarkar_karp", "greedy"])
def test_padded(method):
    for lengths in [[5], [0, 0, 0, 9, 1], [3, 1, 2, 7, 5, 5, 0, 8, 2], list(range(23))]:
        parts = balance.padded(lengths, 4, method)
        assert sorted(i for p in parts for i in p) == list(range(len(lengths))) and len(parts) == 4
        assert max(map(len, parts)) - min(map(len, parts)) <= 1
    assert balance.padded([4, 3, 2, 1, 5, 6, 7, 8], 4, method) == balance.balanced([4, 3, 2, 1, 5, 6, 7, 8], 4, True, method)
