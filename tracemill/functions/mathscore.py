"""Answer normalisation and comparison that column expressions can't express, as Arrow UDFs.

Plain functions take and return Python values; ``*_udf`` are the vectorised columns.
Null and unparsable inputs score 0 and never raise. Nothing is evaluated: symbolic
equality compares quotients of polynomials, read by a small parser.
"""

from __future__ import annotations

import math
import re
import sys
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.session import ship_by_value

# Fixed values of the answer normalisers: replacements and removals in their order.
FINAL_REPLACED = [("an ", ""), ("a ", ""), (".$", "$"), ("\\$", ""), ("\\ ", ""), (" ", ""), ("mbox", "text"), (",\\text{and}", ","), ("\\text{and}", ","), ("\\text{m}", "\\text{}")]
FINAL_REMOVED = [
    "square", "ways", "integers", "dollars", "mph", "inches", "hours", "km", "units", "\\ldots", "sue", "points", "feet", "minutes", "digits", "cents", "degrees", "cm", "gm",
    "pounds", "meters", "meals", "edges", "students", "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots",
]
LATEX_REMOVED = ["\n", "\\!"]
LATEX_DROPPED = ["\\left", "\\right", "^{\\circ}", "^\\circ", "\\$"]
UNITS = ["degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "day", "week", "month", "year", "foot", "feet", "inch", "yard", "liter"]
MAGNITUDES = {"million": "*10^6", "billion": "*10^9", "trillion": "*10^12"}


def last_boxed(text: str, strict: bool = False) -> str | None:
    r"""The last ``\boxed{...}`` with balanced braces; also ``\boxed x`` up to a dollar sign and ``\fbox{}`` unless strict."""
    if not strict and "\\boxed " in text:
        return "\\boxed " + text.rsplit("\\boxed ", 1)[1].partition("$")[0]
    start = text.rfind("\\boxed{" if strict else "\\boxed")
    if start < 0 and not strict:
        start = text.rfind("\\fbox")
    if start < 0:
        return None
    depth = 0
    for brace in re.compile(r"[{}]").finditer(text, start):
        depth += 1 if brace.group() == "{" else -1
        if depth == 0:
            return text[start : brace.end()]
        if depth < 0:
            return None
    return None


def unbox(boxed: str) -> str:
    for open_, close in (("\\boxed ", ""), ("\\boxed{", "}"), ("\\fbox{", "}")):
        if boxed.startswith(open_) and boxed.endswith(close):
            return boxed[len(open_) : len(boxed) - len(close)]
    raise ValueError(f"not a box: {boxed!r}")


_BARE_FRACTIONS = ((re.compile(r"\\frac([^{])([^{])"), r"\\frac{\1}{\2}"), (re.compile(r"\\frac([^{])(?=\{)"), r"\\frac{\1}"))


def normal_latex(text: str) -> str:
    """One spelling of equal LaTeX answers: no spacing, units or percent signs, full fractions and roots."""
    t = text
    for gone in LATEX_REMOVED:
        t = t.replace(gone, "")
    t = re.sub(r"[td]frac", "frac", t.replace("\\\\", "\\"))
    for gone in LATEX_DROPPED:
        t = t.replace(gone, "")
    parts = t.split("\\text{ ")
    if len(parts) > 2:
        raise ValueError("two units")
    t = parts[0].replace("\\%", "")
    t = re.sub(r"(^|[ {])\.", r"\g<1>0.", t)
    t = re.sub(r"^[^=]{0,2}=([^=]*)$", r"\1", t)
    t = re.sub(r"\\sqrt(?!\{)(.)", r"\\sqrt{\1}", t).replace(" ", "")
    for pattern, by in _BARE_FRACTIONS:
        t = pattern.sub(by, t)
    if t == "0.5":
        return "\\frac{1}{2}"
    plain = re.fullmatch(r"(-?(?:0|[1-9]\d*))/(-?(?:0|[1-9]\d*))", t)
    return f"\\frac{{{plain[1]}}}{{{plain[2]}}}" if plain else t


def equivalent(a: str | None, b: str | None) -> bool:
    """Equal after :func:`normal_latex`; texts it can't read are compared as they are."""
    if a is None or b is None:
        return a is None and b is None
    try:
        return normal_latex(a) == normal_latex(b)
    except (ValueError, IndexError):
        return a == b


def math_score(solution: str | None, truth: str | None) -> float:
    """1 if the last boxed answer equals the truth."""
    boxed = last_boxed(solution) if solution else None
    if boxed is None:
        return 0.0
    try:
        return float(equivalent(unbox(boxed), truth))
    except ValueError:
        return 0.0


# Patterns of marked-up text and what stays of them.
_FINAL_LATEX = [
    (r"(.*?)(\$)(.*?)(\$)(.*)", r"$\3$"), (r"(\\text\{)(.*?)(\})", r"\2"), (r"(\\textbf\{)(.*?)(\})", r"\2"), (r"(\\overline\{)(.*?)(\})", r"\2"), (r"(\\boxed\{)(.*)(\})", r"\2"),
    (r"(frac)([^{])(.)", r"frac{\2}{\3}"), (r"(sqrt)([^{])", r"sqrt{\2}"),
]


def final_answer(text: str) -> str:
    """A quantitative answer's normal form: what follows the last equals sign, without words, units and mark-up."""
    t = text.rsplit("=", 1)[-1]
    for old, new in [*FINAL_REPLACED, *((x, "") for x in FINAL_REMOVED)]:
        t = t.replace(old, new)
    for pattern, by in _FINAL_LATEX:
        t = re.sub(pattern, by, t)
    t = t.replace("$", "")
    digits = t.replace(",", "")
    return (digits if digits.isdigit() else t).strip()


def minerva(solution: str, truth: str, boxed_truth: bool = False, pattern: str = r"(?i)Answer\s*:\s*([^\n]+)") -> tuple[bool, str]:
    """(right, prediction) of the last ``Answer:`` line."""
    found = re.findall(pattern, solution)
    answer = final_answer(found[-1] if found else "[INVALID]")
    if boxed_truth:
        boxed = last_boxed(truth)
        return answer == (final_answer(unbox(boxed)) if boxed else None), answer
    return answer == final_answer(truth), answer


def strict_box(solution: str, truth: str) -> tuple[int, str | None]:
    """(1 or -1, prediction) of the last boxed answer in the last 100 characters."""
    boxed = last_boxed(solution[-100:], strict=True)
    answer = unbox(boxed) if boxed else None
    return (1 if answer == truth else -1), answer


def dapo_score(solution: str | None, truth: str | None, strict: bool = False) -> dict:
    """score 1 or -1, acc and pred, from the last 300 characters."""
    text = (solution or "")[-300:]
    if strict:
        score, pred = strict_box(text, truth or "")
        ok = score == 1
    else:
        ok, pred = minerva(text, truth or "")
    return {"score": 1.0 if ok else -1.0, "acc": bool(ok), "pred": pred}


def number(text: str) -> float | None:
    try:
        return float(text.replace("{,}", "").replace(",", ""))
    except ValueError:
        return None


def _plain(text: str) -> str:
    if re.match(r"\$\d+(\.\d+)?", text):
        return text[1:]
    if re.fullmatch(r"\d+(\.\d+)?\\?%", text):
        return text.replace("\\%", "").replace("%", "")
    return text


def _parts(text: str) -> list[str] | None:
    inner = re.fullmatch(r"[\[(](.+)[\])]", text)
    return [x.strip() for x in inner[1].split(",")] if inner and "," in inner[1] else None


def close(a: float, b: float, percent: bool = True, tolerance: float = 1e-4) -> bool:
    """Relative closeness to b, or to b / 100 or b * 100."""
    return any(math.isclose(x, a, rel_tol=tolerance) for x in ((b / 100, b, b * 100) if percent else (b,)))


def math_equal(prediction: str | None, reference: str | None, percent: bool = True, tolerance: float = 1e-4) -> bool:
    """Text, number, then element-wise (intervals, tuples and matrices) equality, then that of algebra."""
    if prediction is None or reference is None:
        return False
    p, r = _plain(str(prediction))[:1000], _plain(str(reference))
    if p.strip().lower() == r.strip().lower() or p.replace(" ", "") == r.replace(" ", ""):
        return True
    a, b = number(p), number(r)
    if a is not None and b is not None:
        return close(a, b, percent, tolerance)
    if not p.strip():
        return False
    ps, rs = _parts(p.strip()), _parts(r.strip())
    if ps and rs:
        return p.strip()[0] == r.strip()[0] and p.strip()[-1] == r.strip()[-1] and len(ps) == len(rs) and all(math_equal(x, y, percent, tolerance) for x, y in zip(ps, rs))
    rows = lambda t: [c.split("&") for c in re.sub(r"\\(begin|end)\{[pb]matrix\}", "", t).strip().removesuffix("\\\\").split("\\\\")]
    if "matrix}" in p and "matrix}" in r:
        m, n = rows(p), rows(r)
        return len(m) == len(n) and all(len(x) == len(y) and all(math_equal(i.strip(), j.strip(), percent, tolerance) for i, j in zip(x, y)) for x, y in zip(m, n))
    if p.count("=") == 1 and r.count("=") == 1:
        return math_equal("-".join(p.split("=")), "-".join(r.split("=")), percent, tolerance)
    for x, y in ((p, r), (r, p)):
        if x.count("=") == 1 and len(x.split("=")[0].strip()) <= 2 and "=" not in y:
            return math_equal(x.split("=")[1].strip(), y, percent, tolerance)
    return symbolic(p, r)


#: greatest exponent and most terms of a polynomial that :func:`symbolic` expands
DEGREE, TERMS = 64, 2000


class TooLarge(ValueError):
    """A power or product beyond DEGREE or TERMS."""


class _Algebra:
    """Reads plain algebra as a quotient of polynomials: dicts from exponents per letter to a fraction."""

    def __init__(self, text: str):
        self.parts = re.findall(r"\d+\.\d*|\.\d+|\d+|[a-z]|\*\*|[-+*/^()]", text)
        if "".join(self.parts) != re.sub(r"\s", "", text):
            raise ValueError("not plain algebra")
        self.at = 0

    def peek(self) -> str:
        return self.parts[self.at] if self.at < len(self.parts) else ""

    def take(self) -> str:
        self.at += 1
        return self.parts[self.at - 1]

    def whole(self):
        value = self.sum()
        if self.peek():
            raise ValueError(f"unread {self.peek()}")
        return value

    def sum(self):
        value = self.product()
        while self.peek() in ("+", "-"):
            sign = Fraction(1 if self.take() == "+" else -1)
            n, d = self.product()
            value = _add(_times(value[0], d), _times(_times(n, value[1]), {(): sign})), _times(value[1], d)
        return value

    def product(self):
        value = self.factor()
        while True:
            p = self.peek()
            if p in ("*", "/"):
                self.take()
                n, d = self.factor()
            elif p and (p[0].isalnum() or p in "(."):  # 2x, (a)(b)
                p, (n, d) = "*", self.factor()
            else:
                return value
            value = (_times(value[0], n), _times(value[1], d)) if p == "*" else (_times(value[0], d), _times(value[1], n))
            if not value[1]:
                raise ValueError("division by zero")

    def factor(self):
        if self.peek() in ("-", "+"):
            sign = Fraction(-1 if self.take() == "-" else 1)
            n, d = self.factor()
            return _times(n, {(): sign}), d
        p = self.take() if self.peek() else ")"
        if p == "(":
            value = self.sum()
            if not self.peek() or self.take() != ")":
                raise ValueError("open bracket")
        elif p[0].isdigit() or p[0] == ".":
            value = {(): Fraction(p)} if Fraction(p) else {}, {(): Fraction(1)}
        elif p.isalpha():
            value = {((p, 1),): Fraction(1)}, {(): Fraction(1)}
        else:
            raise ValueError(f"unexpected {p}")
        if self.peek() in ("^", "**"):
            self.take()
            n, d = self.factor()
            e = n.get((), Fraction(0)) / d[()] if set(n) <= {()} and set(d) == {()} else None
            if e is None or e.denominator != 1:
                raise ValueError("exponent")
            if abs(e) > DEGREE:
                raise TooLarge("exponent")
            if e < 0:
                value, e = (value[1], value[0]), -e
                if not value[1]:
                    raise ValueError("division by zero")
            base, value = value, ({(): Fraction(1)}, {(): Fraction(1)})
            for _ in range(int(e)):
                value = _times(value[0], base[0]), _times(value[1], base[1])
        return value


def _times(a: dict, b: dict) -> dict:
    out: dict = {}
    for m, x in a.items():
        for k, y in b.items():
            powers = dict(m)
            for letter, e in k:
                powers[letter] = powers.get(letter, 0) + e
            key = tuple(sorted(powers.items()))
            out[key] = out.get(key, 0) + x * y
        if len(out) > TERMS:
            raise TooLarge("terms")
    return {m: x for m, x in out.items() if x and all(e <= DEGREE for _, e in m) or _too_high(m)}


def _too_high(m) -> bool:
    if any(e > DEGREE for _, e in m):
        raise TooLarge("degree")
    return False


def _add(a: dict, b: dict) -> dict:
    out = dict(a)
    for m, x in b.items():
        out[m] = out.get(m, 0) + x
    return {m: x for m, x in out.items() if x}


def symbolic(a: str, b: str) -> bool:
    """Whether two quotients of polynomials in any letters are equal, by exact fractions.

    Nothing is evaluated: numbers, letters, brackets, signs and whole powers are read, other text
    is equal to nothing, and so are powers above DEGREE and products of more than TERMS terms.
    """
    try:
        (n, d), (m, e) = _Algebra(a.replace(" ", "")).whole(), _Algebra(b.replace(" ", "")).whole()
        return _times(n, e) == _times(m, d)
    except (ValueError, ZeroDivisionError, RecursionError, OverflowError):
        return False


def expression(text: str) -> str:
    """Lower-case normal form for grading: no units, signs of money and percent, words of magnitude as powers."""
    t = text
    inner = re.fullmatch(r"\\text\{(.+?)\}", t)
    t = inner[1] if inner else t
    t = re.sub(r"\\?[%$]", "", t)
    t = re.sub(r" (or|and) ", " , ", t)
    for word, power in MAGNITUDES.items():
        t = t.replace(word, power)
    for unit in UNITS:
        t = re.sub(rf"{unit}(es)?(s)? *(\^[0-9]+)?", "", t)
    t = re.sub(r"\^ *\\circ", "", t)
    if t.startswith("{") and t.endswith("}"):
        t = t[1:-1]
    t = re.sub(r",\\! *", "", t)
    value = None if "," in t else number(t)
    if value is not None and math.isfinite(value) and abs(value - round(value)) <= 1e-7:
        t = str(round(value))
    t = re.sub(r"- *", "-", re.sub(r"\\d?frac\{([^{}]+)\}\{([^{}]+)\}", r"(\1)/(\2)", t))
    t = re.sub(r"([0-9]) +([0-9])", r"\1+\2", t).lower()
    bare = t.replace(",", "")
    return str(int(bare)) if re.fullmatch(r"-?\d+", bare) and re.fullmatch(r"-?\d{1,3}(,\d{3})*|-?\d+", t) else t


def _elements(text: str) -> list[str]:
    t = re.sub(r"(?<=\d),(?=\d{3}(\D|$))", "", text)
    if not t:
        return []
    return [x.strip() for x in t[1:-1].split(",")] if len(t) > 2 and t[0] in "([" and t[-1] in ")]" and not re.search(r"[()\[\]]", t[1:-1]) else [t]


def grade(given: str | None, truth: str | None) -> bool:
    """Equal normal forms, or element-wise: unreduced fractions and integers must match exactly."""
    if given is None or truth is None:
        return False
    if equivalent(given.strip(), truth.strip()):
        return True
    a, b = expression(given), expression(truth)
    if a == b:
        return True
    if not a:
        return False
    xs, ys = _elements(a), _elements(b)
    if len(xs) != len(ys) or len(ys) > 1 and (a[0] != b[0] or a[-1] != b[-1]):
        return False
    whole, fraction = re.compile(r"-?\d+"), re.compile(r"-?\(?\d+\.?\)?/\(?0*[1-9]\d*\.?\)?")
    for x, y in zip(xs, ys):
        if fraction.fullmatch(x) and fraction.fullmatch(y):
            same = x == y
        elif bool(whole.fullmatch(x)) != bool(whole.fullmatch(y)):
            same = False
        else:
            same = x == y or symbolic(x, y)
        if not same:
            return False
    return True


def prime_score(solution: str | None, truth: str | None) -> float:
    boxed = last_boxed(solution) if solution else None
    if boxed is None or truth is None:
        return 0.0
    try:
        answer = unbox(boxed)
    except ValueError:
        return 0.0
    return float(grade(answer, truth) or math_equal(answer, truth))


def verify_score(solution: str | None, truth: str | None, timeout_score: float = 0.0) -> float:
    """1 if the last boxed answer equals the truth, else 0; timeout_score where the comparison is too large to be made."""
    boxed = last_boxed(solution) if solution else None
    if boxed is None or truth is None:
        return 0.0
    try:
        answer = unbox(boxed)
    except ValueError:
        return 0.0
    try:
        for t in (answer, truth):
            _Algebra(t.replace(" ", "")).whole()
    except TooLarge:
        return timeout_score
    except (ValueError, ZeroDivisionError, RecursionError, OverflowError):
        pass
    return float(math_equal(answer, truth))


def geo_score(solution: str | None, truth: str | None) -> float:
    """0.9 of the accuracy and 0.1 of the think-then-box format."""
    if solution is None:
        return 0.0
    shaped = re.fullmatch(r"<think>.*</think>.*\\boxed\{.*\}.*", solution, re.S) is not None
    boxed = last_boxed(solution)
    inner = unbox(boxed) if boxed and boxed.startswith("\\boxed{") else None
    return 0.9 * float(inner is not None and grade(inner, truth)) + 0.1 * float(shaped)


def boxed_report(solution: str | None, golds: list[str]) -> dict:
    """score, format_score, acc and extracted answer; any gold may match."""
    boxed = last_boxed(solution) if solution else None
    if boxed is None:
        return {"score": 0.0, "format_score": 0.0, "acc": False, "extracted": None}
    try:
        answer = unbox(boxed)
    except ValueError:
        return {"score": 0.0, "format_score": 0.0, "acc": False, "extracted": None}
    ok = any(grade(answer, g) or math_equal(answer, g) for g in golds)
    return {"score": float(ok), "format_score": 1.0, "acc": ok, "extracted": answer}


def repetitive(text: str | None, limit: float = 0.2) -> bool:
    """Whether twice the summed common prefixes of neighbouring sorted suffixes exceed limit * n * (n + 1).

    Suffixes are ranked by doubling, so long texts are fine.
    """
    n = len(text or "")
    if n <= 1:
        return False
    rank = [ord(c) for c in text]
    order, k = list(range(n)), 1
    while True:
        key = lambda i: (rank[i], rank[i + k] if i + k < n else -1)  # noqa: E731, B023
        order.sort(key=key)
        fresh, last = [0] * n, 0
        for p, q in zip(order, order[1:]):
            last += key(p) != key(q)
            fresh[q] = last
        rank = fresh
        if last == n - 1 or k >= n:
            break
        k *= 2
    total = h = 0
    for i in range(n):
        if rank[i] == n - 1:
            h = 0
            continue
        j = order[rank[i] + 1]
        while i + h < n and j + h < n and text[i + h] == text[j + h]:
            h += 1
        total += h
        h = max(h - 1, 0)
    return 2 * total / (n * (n + 1)) > limit


ship_by_value(sys.modules[__name__])


TEXT, NUMBER, TRUTH = T.StringType(), T.DoubleType(), T.BooleanType()


def _two(f, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) for x, y in zip(a, b)])

    return run


def _one(f, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(a: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else f(x) for x in a])

    return run


def _boxed_answer(text: str) -> str | None:
    boxed = last_boxed(text)
    try:
        return unbox(boxed) if boxed else None
    except ValueError:
        return None


last_boxed_udf = _one(last_boxed, TEXT)
boxed_answer_udf = _one(_boxed_answer, TEXT)
normal_latex_udf = _one(normal_latex, TEXT)
final_answer_udf = _one(final_answer, TEXT)
repetitive_udf = _one(repetitive, TRUTH)
math_score_udf = _two(math_score, NUMBER)
prime_score_udf = _two(prime_score, NUMBER)
geo_score_udf = _two(geo_score, NUMBER)
math_equal_udf = _two(math_equal, TRUTH)


@F.pandas_udf(T.StructType([T.StructField("score", NUMBER), T.StructField("acc", TRUTH), T.StructField("pred", TEXT)]))
def dapo_score_udf(solution: pd.Series, truth: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([dapo_score(s, t) for s, t in zip(solution, truth)], columns=["score", "acc", "pred"])


def custom_score(f, kind: T.DataType = NUMBER, on_error: float = 0.0):
    """A column of a user's ``f(solution, truth)``; a row that raises scores on_error."""

    def guarded(a, b):
        try:
            return f(a, b)
        except Exception:  # noqa: BLE001
            return on_error

    return _two(guarded, kind)
