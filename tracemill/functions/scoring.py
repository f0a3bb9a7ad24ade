"""Rule-based scores as column expressions (see ``mathscore`` for the ones that need Python)."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_match(text: Column, pattern: str, group: int = 1) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))


def gsm8k_strict(text: Column) -> Column:
    """The last number after ``####``, without commas and dollar signs."""
    return F.regexp_replace(last_match(text, r"#### (\-?[0-9\.\,]+)"), r"[,$]", "")


def gsm8k_flexible(text: Column) -> Column:
    """The last number that isn't empty or a point; if all are, the first one."""
    found = F.regexp_extract_all(text, F.lit(r"(\-?[0-9\.\,]+)"), F.lit(1))
    good = F.filter(found, lambda x: ~x.isin("", "."))
    return F.when(F.size(found) == 0, F.lit(None).cast("string")).otherwise(F.coalesce(F.try_element_at(good, F.lit(-1)), F.try_element_at(found, F.lit(1))))


def gsm8k_score(text: Column, truth: Column, method: str = "strict", format_score: float = 0.0, score: float = 1.0) -> Column:
    a = gsm8k_strict(text) if method == "strict" else gsm8k_flexible(text)
    return F.when(a.isNull(), 0.0).when(a == truth, score).otherwise(format_score)


def first_answer(text: Column) -> Column:
    """The first ``#### number`` of a solution; raises where there is none."""
    m = F.regexp_extract(text, r"#### (\-?[0-9\.\,]+)", 1)
    return F.when(m == "", F.raise_error(F.lit("no answer in the solution")).cast("string")).otherwise(F.regexp_replace(m, ",", ""))


def normalize_answer(text: Column) -> Column:
    """Lower case, no ASCII punctuation, no articles, single blanks."""
    bare = F.translate(F.lower(text), string.punctuation, "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\b(a|an|the)\b", " "), r"\s+", " "))


def exact_match(prediction: Column, golds: Column) -> Column:
    p = normalize_answer(prediction)
    return F.exists(golds, lambda g: normalize_answer(g) == p)


def substring_match(prediction: Column, golds: Column) -> Column:
    p = normalize_answer(prediction)
    return F.exists(golds, lambda g: F.contains(p, normalize_answer(g)))


def answer_tag(text: Column) -> Column:
    """What the last ``<answer>`` pair holds, trimmed; null without one."""
    return F.trim(last_match(text, r"(?s)<answer>(.*?)</answer>"))


def count_of(text: Column, needle: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle)))) / len(needle)).cast("int")


def qa_score(text: Column, golds: Column, format_score: float = 0.0, score: float = 1.0, substring: bool = False) -> Column:
    """Exact-match score of the tagged answer; more than 10 opening or closing tags quarter it (not with substring)."""
    a = answer_tag(text)
    hit = substring_match(a, golds) if substring else exact_match(a, golds)
    many = (count_of(text, "<answer>") > 10) | (count_of(text, "</answer>") > 10)
    full = F.lit(score) if substring else F.when(many, score / 4).otherwise(score)
    return F.when(a.isNull(), 0.0).when(hit, full).otherwise(format_score)


def think_format(text: Column) -> Column:
    return text.rlike(r"(?s)^<think>.*</think>.*\\boxed\{.*\}.*$").cast("double")


def extract_code(text: Column) -> Column:
    """The last fenced python block, else the last fenced block's body, else the text."""
    py = F.try_element_at(F.split(F.try_element_at(F.split(text, "```python"), F.lit(-1)), "```"), F.lit(1))
    parts = F.split(text, "```")
    other = F.regexp_replace(F.try_element_at(parts, F.lit(2)), r"^[^\n]*\n", "")
    return F.when(F.contains(text, F.lit("```python")), py).when(F.size(parts) > 2, other).otherwise(text)


def pass_rate(results: Column, first: int | None = 10) -> Column:
    """Share of results that are true among the first ten, or among all."""
    r = F.slice(results, 1, first) if first else results
    return F.when(F.size(r) > 0, F.size(F.filter(r, lambda x: x == 1)) / F.size(r)).otherwise(0.0)


def spread_compile_error(codes: Column) -> Column:
    """Every case after the first -4 becomes -4."""
    at = F.array_position(codes, F.lit(-4))
    return F.transform(codes, lambda x, i: F.when((at > 0) & (i >= at - 1), -4).otherwise(x))


def all_passed(results: Column) -> Column:
    return F.when(results.isNull() | (F.size(results) == 0), 0.0).otherwise(F.forall(results, lambda x: x == 1).cast("double"))


def execution_code(api_status: Column, compile_status: Column, run_status: Column, return_code: Column, stdout: Column, expected: Column) -> Column:
    """1 right, 0 wrong, -1 service error, -2 run error, -3 time-out, -4 compile error; only final newlines are ignored."""
    bare = lambda c: F.regexp_replace(c, r"\n+$", "")
    return (
        F.when(api_status.isin("SandboxError"), -1)
        .when(compile_status.isin("Error", "TimeLimitExceeded"), -4)
        .when(run_status == "TimeLimitExceeded", -3)
        .when((run_status != "Finished") | (return_code != 0), -2)
        .when(bare(stdout) == bare(expected), 1)
        .otherwise(0)
    )


def same_output(out: Column, expected: Column) -> Column:
    """Equal as texts with both ends stripped, or line by line stripped."""
    ends = r"(?U)^\s+|\s+$"
    strip = lambda c: F.regexp_replace(c, ends, "")
    lines = lambda c: F.array_join(F.transform(F.split(strip(c), "\n"), strip), "\n")
    return (strip(out) == strip(expected)) | (lines(out) == lines(expected))


def choice_score(text: Column, gold: Column) -> Column:
    """First ``Answer: X`` letter (the word in any case) against the gold letter, case-sensitive."""
    m = F.regexp_extract(text, r"(?i)Answer[ \t]*:[ \t]*\$?([A-D])\$?", 1)
    return F.when((m != "") & (m == gold), 1.0).otherwise(0.0)


def score_number(text: Column) -> Column:
    return F.expr("cast(null as double)") if text is None else F.regexp_extract(text, r"Score:\s*(\d*\.?\d+)", 1).try_cast("double")


def char_count_score(text: Column, boxed: Column, gold: Column) -> Column:
    return F.when(boxed.isNull(), 0.0).when(boxed == gold, 1.0).otherwise(0.0)


def clean_activity(text: Column) -> Column:
    """Trimmed, `` [title]`` as a sentence end, other brackets removed, double blanks made single once."""
    t = F.replace(F.trim(text), F.lit(" [title]"), F.lit(". "))
    return F.replace(F.regexp_replace(t, r"\[.*?\]", ""), F.lit("  "), F.lit(" "))


def passage_lines(titles: Column, texts: Column) -> Column:
    one = lambda t, x: F.struct(t.alias("t"), x.alias("x"))
    return F.array_join(F.transform(F.zip_with(titles, texts, one), lambda s, i: F.concat(F.lit("Doc "), (i + 1).cast("string"), F.lit(" (Title: "), s["t"], F.lit(") "), s["x"], F.lit("\n"))), "")


def search_results(text: Column) -> Column:
    """Struct (query, n_titles, results) of a search tool's text."""
    return F.struct(
        F.regexp_extract(text, r'query"?:\s*"([^"]*)"', 1).alias("query"),
        F.regexp_count(text, F.lit(r'"title"\s*:')).cast("int").alias("n_titles"),
        F.regexp_extract(text, r'(?s)"results"\s*:\s*(\[.*\])', 1).alias("results"),
    )


def tool_reward(score: Column, previous: Column) -> Column:
    """0 where a new attempt beats the previous one, else -0.05."""
    return F.when(score > F.coalesce(previous, F.lit(0.0)), 0.0).otherwise(-0.05)


def dispatch(source: Column, scores: dict[str, Column]) -> Column:
    """The score of the first prefix that the data source starts with; an unknown source raises."""
    out = None
    for prefix, s in scores.items():
        hit = source.startswith(prefix)
        out = F.when(hit, s.cast("double")) if out is None else out.when(hit, s.cast("double"))
    return out.otherwise(F.raise_error(F.concat(F.lit("no score for "), source)).cast("double"))


def quote_escape(text: Column) -> Column:
    """Single quotes that have no backslash before them get one."""
    return F.regexp_replace(text, r"(?<!\\)'", r"\\'")


def smart_size(height: Column, width: Column, factor: int, low: int, high: int) -> Column:
    """Height and width rounded (half to even) to multiples of factor with an area in [low, high]."""
    near = lambda x: F.greatest(F.lit(factor), F.bround(x / factor) * factor)
    h, w = near(height), near(width)
    shrink, grow = F.sqrt(height * width / high), F.sqrt(low / (height * width))
    down = lambda x: F.greatest(F.lit(factor), F.floor(x / shrink / factor) * factor)
    up = lambda x: F.ceil(x * grow / factor) * factor
    pick = lambda x, d: F.when(h * w > high, down(d)).when(h * w < low, up(d)).otherwise(x).cast("int")
    return F.struct(pick(h, height).alias("height"), pick(w, width).alias("width"))


def linear_size(height: Column, width: Column, high: int) -> Column:
    """Both scaled by the root of the area's excess; unchanged below it."""
    f = F.when(height * width > high, F.sqrt(high / (height * width))).otherwise(1.0)
    return F.struct((height * f).cast("int").alias("height"), (width * f).cast("int").alias("width"))
