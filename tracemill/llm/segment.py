"""Splitting oversized transcripts at natural boundaries by lexical cohesion.

A transcript is the text of its items of type ``text``, one after the other, with
nothing between. Boundaries are, from strong to weak, the ends of messages,
paragraphs, lines, sentences and words. Cohesion: the text is cut into sentence
units; the similarity at a gap is the cosine between the term counts of the blocks
of ``BLOCK`` units before and after it; a valley's depth is how far the similarity
climbs to the nearest peak on either side. Terms are hashed to ``DIMS`` counters,
and running sums over ``SLAB`` units at a time give the blocks, so memory doesn't grow with
the transcript beyond its text.

Each piece ends at the deepest valley between ``FILL`` and all of the size limit;
a stronger boundary wins among equally deep ones, then the
later one. Without a sentence end there, the
last one after the overlap is taken, then the last end of a word, then the limit
itself, moved back so as not to part a letter from its combining marks.

Cuts are planned where the rows lie and only offsets are shuffled; the text is moved
only when pieces with text are asked for. Work per transcript is linear in its
length.

Defined cases: null transcripts, messages, contents, items and texts count as empty;
a text of at most ``limit`` characters (empty ones too) is one piece; of repeated and
several saves the latest counts (null saved_at first; if equal, the longest text);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.session import ship_by_value, spread

LIMIT, OVERLAP, FILL, BLOCK, DIMS, SLAB = 6000, 200, 0.5, 4, 256, 1024

#: image is left out of the schema, so the scan skips the image bytes
MESSAGES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("trajectory_id", T.StringType()),
        T.StructField(
            "messages",
            T.ArrayType(T.StructType([T.StructField("content", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType())])))])),
        ),
        T.StructField("saved_at", T.TimestampNTZType()),
    ]
)

_UNIT = re.compile(r"[.!?…]+[\"'”»)\]]*\s+|[。！？।]+[」』”]*\s*|\n+")
#: one of these begins every unit end; a single set is found fast
_MARK = re.compile(r"[.!?…。！？।\n]+")
_WORD = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_]+")
_SPACE = re.compile(r"\s+")


def message_texts(messages: Column) -> Column:
    """One text per message, joined from its items of type text; null for null."""
    item = lambda i: F.when((i.getField("type") == "text") & i.getField("text").isNotNull(), i.getField("text")).otherwise("")
    one = lambda m: F.coalesce(F.array_join(F.transform(m.getField("content"), item), ""), F.lit(""))
    return F.transform(messages, one)


class Slots(dict):
    """Counter of each term, by hash."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        n = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % DIMS
        return n


def boundaries(text: str, message_ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Sentence-level boundaries and their strength: 3 message, 2 paragraph, 1 line, 0 sentence."""
    found: dict[int, int] = {}
    for mark in _MARK.finditer(text):
        m = _UNIT.match(text, mark.start())
        if m:
            gap = m.group()
            found[m.end()] = 2 if gap.count("\n") > 1 else 1 if "\n" in gap else 0
    for e in message_ends:
        found[e] = 3
    found.pop(0, None)
    found.pop(len(text), None)
    at = np.array(sorted(found), dtype=np.int64)
    return at, np.array([found[int(p)] for p in at], dtype=np.int64)


def _similarities(text: str, bounds: list[int], first: int, last: int, memo: Slots) -> np.ndarray:
    """Cosines of the blocks beside the gaps first to last - 1; gap g lies before unit g. Counts only the units of these blocks."""
    a, b = max(first - BLOCK, 0), min(last - 1 + BLOCK, len(bounds) - 1)
    slots: list[int] = []
    sizes = []
    for start, end in zip(bounds[a:b], bounds[a + 1 : b + 1]):
        words = _WORD.findall(text, start, end)
        slots += map(memo.__getitem__, words)
        sizes.append(len(words))
    unit = np.repeat(np.arange(b - a, dtype=np.int64), sizes)
    counts = np.bincount(unit * DIMS + np.array(slots, dtype=np.int64), minlength=(b - a) * DIMS).reshape(b - a, DIMS)
    upto = np.vstack([np.zeros((1, DIMS), np.int64), np.cumsum(counts, axis=0)])
    gap = np.arange(first, last) - a
    left = (upto[gap] - upto[np.maximum(gap - BLOCK, 0)]).astype(np.float64)
    right = (upto[np.minimum(gap + BLOCK, b - a)] - upto[gap]).astype(np.float64)
    norm = np.sqrt((left * left).sum(1) * (right * right).sum(1))
    return np.where(norm > 0, (left * right).sum(1) / np.maximum(norm, 1e-9), 0.0)


def valley_depths(text: str, at: np.ndarray, memo: Slots) -> np.ndarray:
    """Depth of the cohesion valley at each boundary."""
    n = len(at) + 1
    if n == 1:
        return np.zeros(0)
    low = text.lower()
    low = low if len(low) == len(text) else text
    bounds = [0, *at.tolist(), len(text)]
    sim = np.concatenate([_similarities(low, bounds, a, min(a + SLAB, n), memo) for a in range(1, n, SLAB)])
    climb = np.zeros_like(sim)
    for s, out in ((sim, slice(None)), (sim[::-1], slice(None, None, -1))):
        side = np.zeros_like(s)
        for i in range(1, len(s)):  # the height of the peak that a walk uphill from i reaches
            peak = side[i - 1] + s[i - 1] if s[i - 1] >= s[i] else s[i]
            side[i] = max(peak - s[i], 0.0)
        climb[out] += side
    return climb


def _word_end(text: str, low: int, high: int) -> int | None:
    """Last place in (low, high] after white space."""
    best = None
    for m in _SPACE.finditer(text, low, min(high + 1, len(text))):
        if low < m.end() <= high:
            best = m.end()
        elif low < m.start() <= high:
            best = m.start()
    return best


def _hard_end(text: str, low: int, high: int) -> int:
    e = high
    while e > low + 1 and e > high - 64 and e < len(text) and (unicodedata.combining(text[e]) or unicodedata.category(text[e])[0] == "M" or text[e] in "‍️" or text[e - 1] == "‍"):
        e -= 1
    return e if e > max(low + 1, high - 64) else high


def plan_cuts(text: str, message_ends: list[int], memo: Slots, limit: int = LIMIT, overlap: int = OVERLAP, fill: float = FILL) -> list[int]:
    """Ends of the pieces; piece k starts ``overlap`` before the end of piece k-1."""
    n = len(text)
    if n <= limit:
        return [n]
    at, strength = boundaries(text, message_ends)
    score = valley_depths(text, at, memo) + 1e-3 * strength
    ends, start, last = [], 0, 0
    while n - start > limit:
        high = start + limit
        for low in (start + int(fill * limit), last):
            a, b = np.searchsorted(at, [max(low, last), high], side="right")
            if b > a:
                break
        if b > a:
            end = int(at[b - 1 - int(np.argmax(score[a:b][::-1]))]) if low > last else int(at[b - 1])
        else:
            end = _word_end(text, last, high) or _hard_end(text, last, high)
        ends.append(end)
        start, last = max(end - overlap, 0), end
    return [*ends, n]


def _plan(parts: pd.Series) -> pd.Series:
    memo = Slots()
    out = []
    for p in parts:
        texts = [x or "" for x in p] if p is not None else []
        out.append(plan_cuts("".join(texts), list(np.cumsum([len(x) for x in texts])), memo) if texts else [0])
    return pd.Series(out)


ship_by_value(sys.modules[__name__])
_plan_udf = F.pandas_udf(_plan, T.ArrayType(T.IntegerType()))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of trajectory_messages as (run_id, trajectory_id, saved_at, parts, n_chars)."""
    df = spread(spark.read.schema(MESSAGES).parquet(path))
    parts = df.select("run_id", "trajectory_id", "saved_at", F.coalesce(message_texts(F.col("messages")), F.expr("array()").cast("array<string>")).alias("parts"))
    return parts.withColumn("n_chars", F.aggregate("parts", F.lit(0), lambda a, x: a + F.length(x)))


def _ends(rows: DataFrame, limit: int) -> DataFrame:
    """Adds ``ends``. Of texts within the limit only a null goes to Python; the table is read once."""
    large = F.col("n_chars") > limit
    planned = rows.withColumn("planned", _plan_udf(F.when(large, F.col("parts"))))
    return planned.withColumn("ends", F.when(large, F.col("planned")).otherwise(F.array("n_chars"))).drop("planned")


def plans(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(run_id, trajectory_id, saved_at, n_chars, ends): the latest save's cuts. Only offsets are shuffled."""
    cut = _ends(rows, limit).select("run_id", "trajectory_id", "saved_at", "n_chars", "ends")
    latest = F.max(F.struct("saved_at", "n_chars", "ends")).alias("m")
    return cut.groupBy("run_id", "trajectory_id").agg(latest).select("run_id", "trajectory_id", "m.*")


def pieces(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(run_id, trajectory_id, piece_no, start, end, text) of the latest save of each transcript."""
    whole = rows.groupBy("run_id", "trajectory_id").agg(F.max(F.struct("saved_at", "n_chars", "parts")).alias("m")).select("run_id", "trajectory_id", "m.*")
    cut = _ends(whole, limit).select("run_id", "trajectory_id", F.array_join("parts", "").alias("t"), "ends")
    each = cut.select("run_id", "trajectory_id", "t", "ends", F.posexplode("ends").alias("piece_no", "end"))
    start = F.when(F.col("piece_no") == 0, 0).otherwise(F.greatest(F.get("ends", F.col("piece_no") - 1) - overlap, F.lit(0)))
    return each.withColumn("start", start).select("run_id", "trajectory_id", "piece_no", "start", "end", F.substring("t", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
