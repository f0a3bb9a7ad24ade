"""Expressions on token arrays: masks, padding, folds. All stay in the JVM and within a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NONE = "cast(array() as array<double>)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total(a: Column | str) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x)


def masked(a: Column | str, mask: Column | str) -> Column:
    return F.zip_with(_c(a), _c(mask), lambda x, m: x * m)


def masked_sum(a: Column | str, mask: Column | str) -> Column:
    return total(masked(a, mask))


def masked_mean(a: Column | str, mask: Column | str) -> Column:
    """Sum of masked values over (mask sum + 1e-8)."""
    return masked_sum(a, mask) / (total(_c(mask)) + 1e-8)


def masked_var(a: Column | str, mask: Column | str) -> Column:
    """Bessel-corrected masked variance; a mask sum of 0 or 1 raises."""
    n = total(_c(mask))
    mean = masked_mean(a, mask)
    square = total(F.zip_with(_c(a), _c(mask), lambda x, m: (x - mean) * (x - mean) * m)) / (n + 1e-8)
    return F.when(n > 1, square * n / (n - 1)).otherwise(F.raise_error(F.lit("mask sum must exceed 1")).cast("double"))


def positions(mask: Column | str) -> Column:
    """Position ids: running count of the mask minus one, at least 0."""
    folded = F.aggregate(
        _c(mask),
        F.struct(F.lit(0).alias("n"), F.expr("cast(array() as array<int>)").alias("out")),
        lambda s, m: F.struct((s["n"] + m.cast("int")).alias("n"), F.concat(s["out"], F.array(F.greatest(s["n"] + m.cast("int") - 1, F.lit(0)))).alias("out")),
        lambda s: s["out"],
    )
    return folded


def index_positions(mask: Column | str) -> Column:
    return F.transform(_c(mask), lambda m, i: i * m)


def reverse_cumsum(a: Column | str) -> Column:
    return discounted(a, F.lit(1.0))


def discounted(a: Column | str, gamma: Column | float, reset: Column | str | None = None) -> Column:
    """Reverse running sum ``g_t = x_t + gamma * g_{t+1}``.

    With reset, the carried value is multiplied by the position's mask after the
    position itself is stored.
    """
    g = F.lit(gamma) if isinstance(gamma, (int, float)) else gamma
    pairs = F.zip_with(_c(a), _c(reset) if reset is not None else F.transform(_c(a), lambda x: F.lit(1)), lambda x, m: F.struct(x.cast("double").alias("x"), m.cast("double").alias("m")))
    step = lambda s, p: F.struct((p["x"] + g * s["g"]).alias("v"), ((p["x"] + g * s["g"]) * p["m"]).alias("g"), F.concat(F.array(p["x"] + g * s["g"]), s["out"]).alias("out"))
    zero = F.struct(F.lit(0.0).alias("v"), F.lit(0.0).alias("g"), F.expr(NONE).alias("out"))
    return F.aggregate(F.reverse(pairs), zero, step, lambda s: s["out"])


def gae(rewards: Column | str, values: Column | str, gamma: float, lam: float) -> Column:
    """Generalised advantages before whitening; values at masked positions count."""
    v = _c(values)
    deltas = F.transform(F.arrays_zip(_c(rewards).alias("r"), v.alias("v")), lambda z, i: z["r"] + gamma * F.coalesce(F.get(v, i + 1), F.lit(0.0)) - z["v"])
    return discounted(deltas, gamma * lam)


def eos_mask(tokens: Column | str, *eos: int) -> Column:
    """1 up to and including the first end token, then 0."""
    t = _c(tokens)
    first = F.coalesce(F.array_min(F.filter(F.array(*[F.array_position(t, F.lit(e)) for e in eos]), lambda p: p > 0)), F.size(t).cast("long"))
    return F.transform(t, lambda x, i: (i < first).cast("int"))


def pad(a: Column | str, length: int, value, left: bool = False) -> Column:
    c = _c(a)
    more = F.array_repeat(F.lit(value), F.greatest(F.lit(length) - F.size(c), F.lit(0)))
    return F.concat(more, c) if left else F.concat(c, more)


def truncate(a: Column | str, length: int, how: str = "right") -> Column:
    """Keeps ``length`` elements: ``left`` drops the head, ``right`` the tail, ``middle`` the middle; ``error`` raises."""
    c = _c(a)
    n = F.size(c)
    if how == "left":
        return F.when(n > length, F.slice(c, n - length + 1, length)).otherwise(c)
    if how == "right":
        return F.slice(c, 1, length)
    if how == "middle":
        head = length // 2
        return F.when(n > length, F.concat(F.slice(c, 1, head), F.slice(c, n - (length - head) + 1, length - head))).otherwise(c)
    if how == "error":
        return F.when(n > length, F.raise_error(F.lit(f"longer than {length}")).cast("array<int>")).otherwise(c)
    raise ValueError(how)


def strip_left_pad(a: Column | str, pad_id: int) -> Column:
    c = _c(a)
    first = F.array_min(F.filter(F.transform(c, lambda x, i: F.when(x != pad_id, i)), lambda i: i.isNotNull()))
    return F.when(first.isNull(), F.slice(c, 1, 0)).otherwise(F.slice(c, F.coalesce(first, F.lit(0)) + 1, F.size(c)))


def response_mask(attention: Column | str, length: int) -> Column:
    """The mask's last ``length`` places."""
    c = _c(attention)
    return F.slice(c, F.size(c) - length + 1, length)


def window_mask(size: int, start: int, valid: Column) -> Column:
    """1 for the ``valid`` places after ``start``."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: ((i >= start) & (i < start + valid)).cast("int"))


def place_last(mask: Column | str, score: Column) -> Column:
    """The score at the last valid place (mask sum - 1), zeros elsewhere."""
    c = _c(mask)
    last = F.aggregate(c, F.lit(0), lambda s, m: s + m.cast("int")) - 1
    return F.transform(c, lambda m, i: F.when(i == last, score.cast("double")).otherwise(F.lit(0.0)))


def subsequence_positions(a: Column | str, sub: Column | str) -> Column:
    c, s = _c(a), _c(sub)
    n, k = F.size(c), F.size(s)
    starts = F.when((k > 0) & (n >= k), F.sequence(F.lit(0), n - k)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.filter(starts, lambda i: F.slice(c, i + 1, k) == s)


def sft_loss_mask(mask: Column | str, prompt_length: Column) -> Column:
    """Attention mask with the first ``min(p, L) - 1`` places and the last valid place zeroed."""
    c = _c(mask)
    n = F.size(c)
    last = F.aggregate(c, F.lit(0), lambda s, m: s + m.cast("int")) - 1
    head = F.when(prompt_length > 1, F.least(prompt_length, n) - 1).otherwise(F.lit(0))
    return F.transform(c, lambda m, i: F.when((i < head) | (i == last), 0).otherwise(m.cast("int")))


def kl(logp: Column | str, ref: Column | str, kind: str) -> Column:
    """Per-token estimates: kl/k1, abs, mse/k2, low_var_kl/k3 (inner clamp 20, outer clamp 10)."""
    a, b = _c(logp), _c(ref)
    clamp = lambda x, m: F.least(F.greatest(x, F.lit(-m)), F.lit(m))
    if kind in ("kl", "k1"):
        return F.zip_with(a, b, lambda x, y: x - y)
    if kind == "abs":
        return F.zip_with(a, b, lambda x, y: F.abs(x - y))
    if kind in ("mse", "k2"):
        return F.zip_with(a, b, lambda x, y: 0.5 * (x - y) * (x - y))
    if kind in ("low_var_kl", "k3"):
        return F.zip_with(a, b, lambda x, y: clamp(F.exp(clamp(y - x, 20.0)) - clamp(y - x, 20.0) - 1, 10.0))
    raise ValueError(kind)


def positions_after(marks: Column | str, size: Column) -> Column:
    """The place after each mark, where there is one."""
    return F.filter(F.transform(_c(marks), lambda i: i + 1), lambda i: i < size)


def every_second(a: Column | str, start: int = 0) -> Column:
    return F.filter(_c(a), lambda x, i: (i >= start) & ((i - start) % 2 == 0))


def ceil_div(a: Column, b: Column | int) -> Column:
    return F.ceil(a / b)


def round_up(a: Column, b: int) -> Column:
    return F.ceil(a / b) * b


def finalise(ids: Column, prompt_size: Column, generation: list[int], max_model: int, max_response: int, *aligned: Column) -> Column:
    """Struct (response, aligned...): the trailing generation prompt goes, then prompt and response part, both cut to size.

    Arrays that aren't as long as ids raise.
    """
    n = F.size(ids)
    same = F.lit(True)
    for a in aligned:
        same = same & (F.size(a) == n)
    g = len(generation)
    tail = (n >= g) & (F.slice(ids, F.greatest(n - g + 1, F.lit(1)), g) == F.array(*[F.lit(x) for x in generation])) if g else F.lit(False)
    keep = F.when(~same, F.raise_error(F.lit("arrays differ in length")).cast("int")).otherwise(F.least(F.when(tail, n - g).otherwise(n), F.lit(max_model)))
    part = lambda a: F.slice(a, prompt_size + 1, F.greatest(F.least(keep - prompt_size, F.lit(max_response)), F.lit(0)))
    return F.struct(part(ids).alias("response"), *[part(a).alias(f"aligned_{i}") for i, a in enumerate(aligned)])


def pair_stack(chosen: Column, rejected: Column, size: int, pad_id: int = 0) -> Column:
    """[chosen, rejected], each padded on the right or cut to size."""
    fit = lambda a: truncate(pad(a, size, pad_id), size)
    return F.array(fit(chosen), fit(rejected))
