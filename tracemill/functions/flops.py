"""Training cost estimates of a dense decoder from its shape and sequence lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_parameters(hidden: int, intermediate: int, layers: int, heads: int, kv_heads: int, vocabulary: int, head_dim: int | None = None) -> int:
    """Weights that every token passes: gated MLP, attention projections, embedding and output head."""
    d = head_dim or hidden // heads
    attention = hidden * d * (2 * heads + 2 * kv_heads)
    return (3 * hidden * intermediate + attention) * layers + 2 * vocabulary * hidden


def achieved(df: DataFrame, length: str, seconds: Column, *, hidden: int, intermediate: int, layers: int, heads: int, kv_heads: int, vocabulary: int, head_dim: int | None = None) -> DataFrame:
    """One row ``tflops``: forward and backward, 6 per weight and token and 12 per attention pair, over the time."""
    d = head_dim or hidden // heads
    n = dense_parameters(hidden, intermediate, layers, heads, kv_heads, vocabulary, head_dim)
    tokens, squares = F.sum(F.col(length).cast("double")), F.sum(F.col(length).cast("double") * F.col(length))
    return df.agg(((6.0 * n * tokens + 12.0 * d * heads * layers * squares) / seconds / 1e12).alias("tflops"))
