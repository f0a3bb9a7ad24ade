"""Partitions of sequences by length, of equal sums as near as possible.

The methods work on one batch's lengths (numbers on the order of a global batch), so a
batch is one group of ``applyInPandas``; many batches run in parallel.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import by_key, ship_by_value


class Pile:
    """A set of items with its sum, kept as a tree of merged sets, so that merging copies nothing."""

    __slots__ = ("total", "size", "left", "right", "first")

    def __init__(self, total: int = 0, size: int = 0, left=None, right=None):
        self.total, self.size, self.left, self.right = total, size, left, right
        self.first = (-1, 0) if not size else (left, total) if right is None else left.first if left.size else right.first

    def merged(self, other: Pile) -> Pile:
        return Pile(self.total + other.total, self.size + other.size, self, other)

    def items(self) -> list[tuple[int, int]]:
        """(index, length) of the items, in the order they were merged."""
        out, todo = [], [self]
        while todo:
            p = todo.pop()
            if p.right is None:
                if p.size:
                    out.append((p.left, p.total))
            else:
                todo += [p.right, p.left]
        return out

    def __lt__(self, other: Pile) -> bool:
        """By sum, then size, then items. No two piles share an item, so their first items decide."""
        return (self.total, self.size, self.first) < (other.total, other.size, other.first)


class Grouping:
    """k piles, widest first in the queue; ties go to the greater top pile."""

    __slots__ = ("piles", "spread")

    def __init__(self, piles: list[Pile]):
        self.piles = sorted(piles, reverse=True)
        self.spread = self.piles[0].total - self.piles[-1].total

    def __lt__(self, other: Grouping) -> bool:
        return self.spread > other.spread if self.spread != other.spread else other.piles[0] < self.piles[0]


def karmarkar_karp(lengths: Sequence[int], k: int, equal_size: bool) -> list[list[int]]:
    """Largest differencing: the two groupings of widest spread are merged, wide against narrow, until one is left."""
    order = sorted(enumerate(lengths), key=lambda x: (x[1], x[0]))
    if equal_size:
        if len(lengths) % k:
            raise ValueError(f"{len(lengths)} items don't divide into {k} parts")
        heap = [Grouping([Pile(s, 1, i) for i, s in order[a : a + k]]) for a in range(0, len(order), k)]
    else:
        heap = [Grouping([Pile(s, 1, i), *[Pile() for _ in range(k - 1)]]) for i, s in order]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, Grouping([x.merged(y) for x, y in zip(a.piles, reversed(b.piles))]))
    return [sorted(i for i, _ in p.items()) for p in heap[0].piles]


def greedy(lengths: Sequence[int], k: int, equal_size: bool) -> list[list[int]]:
    """In input order, each item goes to the part of the least sum (with equal sizes every item weighs a constant more)."""
    bias = sum(lengths) + 1 if equal_size else 0
    parts: list[list[int]] = [[] for _ in range(k)]
    sums = [0] * k
    for i, s in enumerate(lengths):
        p = min(range(k), key=sums.__getitem__)
        parts[p].append(i)
        sums[p] += s + bias
    return parts


def balanced(lengths: Sequence[int], k: int, equal_size: bool = True, method: str = "karmarkar_karp") -> list[list[int]]:
    """Checked, sorted parts; every item in exactly one."""
    if len(lengths) < k:
        raise ValueError(f"{len(lengths)} items for {k} parts")
    parts = (karmarkar_karp if method == "karmarkar_karp" else greedy)(lengths, k, equal_size)
    if sorted(i for p in parts for i in p) != list(range(len(lengths))) or not all(parts) or equal_size and len({len(p) for p in parts}) > 1:
        raise ValueError("parts don't cover the items")
    return [sorted(p) for p in parts]


def padded(lengths: Sequence[int], k: int, method: str = "karmarkar_karp") -> list[list[int]]:
    """Parts of sizes that differ by one at most, of any number of items from 1 on; a part is empty where items are fewer than k.

    Pads of length 0 fill up to a multiple of k. Differencing takes the least items first,
    ties by place, so pads stand before the items there and no part gets two; greedy takes
    items in order, so pads stand after them and change nothing for them.
    """
    n_pads = -len(lengths) % k
    before = n_pads if method == "karmarkar_karp" else 0
    items = [0] * before + list(lengths) + [0] * (n_pads - before)
    return [[i - before for i in p if before <= i < before + len(lengths)] for p in balanced(items, k, True, method)]


def n_micro_batches(lengths: Sequence[int], budget: int, least: int | None = None, multiple: int | None = None) -> int:
    """ceil(total / budget), at most one per item, at least ``least``, rounded up to a multiple."""
    if max(lengths) > budget:
        raise ValueError("an item exceeds the budget")
    k = min(len(lengths), -(-sum(lengths) // budget))
    k = max(k, least or 0)
    return -(-k // multiple) * multiple if multiple else k


def reverse_index(order: Sequence[int]) -> list[int]:
    """Where each item went, so that it can be put back."""
    out = [0] * len(order)
    for at, i in enumerate(order):
        out[i] = at
    return out


ship_by_value(sys.modules[__name__])


def partition(df: DataFrame, batch: str, row: str, length: str, k: int, equal_size: bool = True, method: str = "karmarkar_karp", most: int = 1_000_000) -> DataFrame:
    """``batch, row, length, part, place``: each batch's rows in k parts; place is the row's new position in the batch.

    With equal_size a batch is padded to a multiple of k by items of length 0, which are
    taken out again: every row comes out once, and parts differ by one row at most.
    A batch of more than ``most`` rows raises, as it is one task's work.
    """
    kind = df.schema[batch].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > most:
            raise ValueError(f"batch of more than {most} rows")
        pdf = pdf.sort_values("row").reset_index(drop=True)
        parts = padded(pdf["length"].tolist(), k, method) if equal_size else balanced(pdf["length"].tolist(), k, equal_size, method)
        part, place, at = [0] * len(pdf), [0] * len(pdf), 0
        for p, members in enumerate(parts):
            for i in members:
                part[i], place[i] = p, at
                at += 1
        return pdf.assign(part=part, place=place)

    src = df.select(F.col(batch).alias("batch"), F.col(row).cast("long").alias("row"), F.col(length).cast("long").alias("length"))
    return by_key(src, "batch").groupBy("batch").applyInPandas(run, f"batch {kind}, row bigint, length bigint, part int, place int")


def micro_batches(df: DataFrame, batch: str, row: str, length: str, budget: int, least: int | None = None, multiple: int | None = None) -> DataFrame:
    """``batch, row, length, part``: as many parts as the token budget needs. Sums are balanced, not bounded by it."""
    kind = df.schema[batch].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        lengths = pdf["length"].tolist()
        part = [0] * len(pdf)
        for p, members in enumerate(balanced(lengths, n_micro_batches(lengths, budget, least, multiple), equal_size=False)):
            for i in members:
                part[i] = p
        return pdf.assign(part=part)

    src = df.select(F.col(batch).alias("batch"), F.col(row).cast("long").alias("row"), F.col(length).cast("long").alias("length"))
    return by_key(src, "batch").groupBy("batch").applyInPandas(run, f"batch {kind}, row bigint, length bigint, part int")
