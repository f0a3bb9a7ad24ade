"""Languages of documents and of the segments of mixed ones, by hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs. A run of letters is the product
of their vectors, each rotated by its place (binding); a text is the sum of the
vectors of its 2 to 4-letter runs, and of single signs of scripts without spaces (bundling), and so is a language: its prototype is the
bundle of labelled sentences. A sentence gets the language of the prototype with the
greatest cosine, after the mean of all prototypes is taken off both sides.

Prototypes are trained on a sample of at most ``SAMPLE`` documents per labelled
language (by hash of the id), plus a few function words per language below, so that
a language without labels has one too. As labels may be wrong, the sample's
sentences are assigned anew ``ROUNDS`` times by the prototypes just made. Training
sends 12 vectors to the driver, whatever the size of the data. All documents are then
scored where they lie, whole, without a shuffle.

Sentences: texts are cut at line ends and sentence marks. Fenced code, quoted
names, paths, addresses, file names, calls, identifiers, numbers, tags and special
tokens are taken out; what is left counts as a sentence with at least ``WORDS`` words, or
``SIGNS`` letters of a script without spaces.

Defined cases: null, empty and blank texts and texts without a sentence have no
segments and language null; repeated rows give repeated rows; an empty table gives no
rows and needs no training; a label is compared without case, region and script, as
code of two or three letters or English name.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tracemill.session import ship_by_value, spread

DIM, SAMPLE, ROUNDS, WORDS, SIGNS, LETTERS = 8192, 300, 2, 3, 5, 8
TEMPERATURE, KEPT = 25.0, 16_000_000

# The languages, other codes and names, frequent function words.
LANGUAGES = {
    "en": ("eng", "english"),
    "de": ("deu", "ger", "german"),
    "nl": ("nld", "dut", "dutch"),
    "fr": ("fra", "fre", "french"),
    "es": ("spa", "spanish"),
    "it": ("ita", "italian"),
    "pt": ("por", "portuguese"),
    "ru": ("rus", "russian"),
    "uk": ("ukr", "ukrainian"),
    "zh": ("zho", "chi", "cmn", "chinese"),
    "ja": ("jpn", "japanese"),
    "hi": ("hin", "hindi"),
}
NO_LANGUAGE = ("und", "zxx", "mul", "mis", "null", "none", "nan", "n/a", "na", "unknown", "??", "?", "-")
SEEDS = {
    "en": "the and that this with from have not you for was are but which there should will can after before",
    "de": "der die das und nicht mit ist auf ein eine den dem ich sich auch nach bei wurde werden soll kann",
    "nl": "de het een en niet met is op van dat ik zich ook naar bij werd worden moet kan nog zijn heeft",
    "fr": "le la les et ne pas avec est sur une des je se aussi dans pour que qui être doit peut sont nous",
    "es": "el la los y no con es en una de que se también para por qué ser debe puede está son nosotros hay",
    "it": "il la gli e non con è su una di che si anche per essere deve può sono nella della questo ho",
    "pt": "o a os e não com é em uma de que se também para por ser deve pode está são na da isso eu",
    "ru": "и не в на что я с он как это по но из у за от так же все мне было должен чтобы",
    "uk": "і не в на що я з він як це по але із у за від так же все мені було повинен щоб ще",
    "zh": "的是不了在有我这个们中来上大为和国地到以说时要就出会可也你对生能",
    "ja": "のにはをたがでてとしれさるいもこのあるなかったありますしましたですからまで",
    "hi": "का की के है में से को और यह पर नहीं हैं कर लिए एक भी कि था हो ने मैं",
}
CODES = list(LANGUAGES)

_FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
_QUOTED = re.compile(r"“[^”\n]{0,80}”|„[^“”\n]{0,80}[“”]|«[^»\n]{0,80}»|「[^」\n]{0,80}」|『[^』\n]{0,80}』|\"[^\"\n]{0,80}\"|`[^`\n]{0,80}`")
# letters of scripts without spaces: an identifier or number ends at them, as no blank parts it from the sentence
_KANA_HAN = r"\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
# what is no sentence, in the order in which it is taken out; each begins at the start of a run of its letters,
# so that a run is read once; the first column is a sign, or a pattern of one, that a text must hold
_NOISE = [
    ("<", re.compile(r"<\|[^|>\n]{0,40}\|>|<[^<>\n]{1,80}>")),  # tags, special tokens
    ("(", re.compile(r"\b\w+\([^()\n]*\)")),  # calls
    ("/", re.compile(r"(?<!\S)[^\s\\/]*+[\\/][^\s\\/]*+[\\/]\S*")),  # paths and addresses
    ("\\", re.compile(r"(?<!\S)[^\s\\/]*+[\\/][^\s\\/]*+[\\/]\S*")),
    ("www.", re.compile(r"www\.\S+")),
    ("@", re.compile(r"(?<!\S)\S[^\s@]*+@\S+")),
    (".", re.compile(r"(?<![\w\-])[\w\-]++\.[A-Za-z][A-Za-z0-9]{1,4}\b(?!\s*[A-Za-z]?\()")),  # file names
    ("", re.compile(r"(?<![^\W\d_%s])[^\W\d_%s]*+[\d_][^\W%s]*" % (_KANA_HAN, _KANA_HAN, _KANA_HAN))),  # identifiers and numbers
    (re.compile(r"[a-z][A-Z]"), re.compile(r"\b[A-Za-z]+[a-z][A-Z]\w*")),  # names in camel case
]
_END = re.compile("[.!?\u2026][\"'\u201d\u00bb)\\]]*\\s+|[\u3002\uff01\uff1f\u0964]|[\r\n\x0b\x0c\x85\u2028\u2029]+|(?<=\\s)[|\u2022\u00b7](?=\\s)|[;:]\\s{2,}")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_DENSE = re.compile(r"[぀-ヿ㐀-鿿]")


def canonical_label(label: Column) -> Column:
    """Two-letter code of a label, ``other`` for a name that isn't one of the twelve, null for none."""
    low = F.regexp_replace(F.lower(label), r"(?U)^\s+|\s+$", "")
    base = F.regexp_replace(low, r"^([a-z]{2,3})[-_].*$", "$1")
    names = {n: c for c, ns in LANGUAGES.items() for n in (c, *ns)}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    none = (base == "") | base.isin(*NO_LANGUAGE) | ~base.rlike("[a-z]")
    return F.when(label.isNull() | none, None).otherwise(F.coalesce(F.element_at(known, base), F.lit("other")))


def clean(text: str) -> str:
    """Lower-case words with single blanks at their ends."""
    return unicodedata.normalize("NFC", " ".join(_WORD.findall(text)).lower())


def is_sentence(cleaned: str) -> bool:
    if not cleaned.isascii() and len(_DENSE.findall(cleaned)) >= SIGNS:
        return True
    words = cleaned.split()
    if len(words) < WORDS or len(cleaned) - len(words) + 1 < LETTERS:
        return False
    varied = 0
    for w in words:
        if len(w) > 2 and len(set(w)) > 2:
            varied += 1
            if varied == 2:
                return True
    return False


class Sentences(dict):
    """What :func:`clean` makes of a stretch of text, or an empty string where it is no sentence; at most KEPT letters."""

    letters = 0

    def __missing__(self, stretch: str) -> str:
        self.letters += len(stretch)
        if self.letters > KEPT:
            self.clear()
            self.letters = len(stretch)
        c = clean(stretch)
        c = self[stretch] = c if is_sentence(c) else ""
        return c


def _blank(m: re.Match) -> str:
    return " " * (m.end() - m.start())


def segments(text: str, memo: Sentences | None = None) -> list[tuple[int, int, str]]:
    """``(start, end, cleaned)`` of each sentence of text."""
    memo = Sentences() if memo is None else memo
    t = _FENCE.sub(_blank, text) if "```" in text else text
    t = _QUOTED.sub(lambda m: m.group() if len(m.group().split()) > 5 else _blank(m), t)
    for sign, noise in _NOISE:
        if sign in t if isinstance(sign, str) else sign.search(t):
            t = noise.sub(_blank, t)
    out, start = [], 0
    for e in [*[m.end() for m in _END.finditer(t)], len(t)]:
        if e > start:
            c = memo[t[start:e]]
            if c:
                out.append((start, e, c))
        start = e
    return out


class Vectors:
    """Letters' and runs' vectors of one process."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.tables = [np.ones((0, DIM), dtype=np.int8) for _ in range(4)]

    def _known(self, codes: list[int]) -> None:
        """Makes the signs of letters: a row of each table per letter, rotated by the letter's place in the run; ones for no letter."""
        fresh = [c for c in codes if c not in self.rows]
        if not fresh:
            return
        if len(self.rows) + len(fresh) > 4000:
            self.__init__()
            fresh = codes
        signs = [(np.random.Generator(np.random.Philox(key=c)).integers(0, 2, DIM, dtype=np.int8) * 2 - 1).astype(np.int8) if c else np.ones(DIM, dtype=np.int8) for c in fresh]
        for c in fresh:
            self.rows[c] = len(self.rows)
        self.tables = [np.vstack([t, np.roll(signs, place, axis=1)]) for place, t in enumerate(self.tables)]

    def blocks(self, names: np.ndarray, size: int = 512):
        """(first, vectors as rows) of the runs, rows of four letters' code points each, a block at a time."""
        for a in range(0, len(names), size):
            part = names[a : a + size]
            codes, at = np.unique(part, return_inverse=True)
            self._known(codes.tolist())
            rows = np.array([self.rows[c] for c in codes.tolist()])[at.reshape(part.shape)]
            v = self.tables[0][rows[:, 3]]
            for place in (1, 2, 3):
                v *= self.tables[place][rows[:, 3 - place]]
            yield a, v.astype(np.float32)


class Slots:
    """Numbers of runs, given out in order of first use.

    A run is four letters of 16 bits in one number, zeros before a shorter one; letters
    get their 16 bits in order of first use.
    """

    def __init__(self) -> None:
        self.number = np.zeros(0x110000, dtype=np.uint16)  # of each letter
        self.letters = np.zeros(0x10000, dtype=np.int64)  # code point of each number
        self.n_letters = 1
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted
        self.slot = np.zeros(0, dtype=np.int64)  # of each key
        self.names = np.zeros((0, 4), dtype=np.int64)  # code points of each slot's run

    def full(self) -> bool:
        """Whether a new start is due, as it is before the letters' numbers run out."""
        return len(self.keys) > 300_000 or self.n_letters > 0x8000

    def numbered(self, codes: np.ndarray) -> np.ndarray:
        fresh = np.unique(codes[(self.number[codes] == 0) & (codes != 0)])
        if self.n_letters + len(fresh) > 0xFFFF:
            raise ValueError("more than 65,535 different letters in one batch")
        self.number[fresh] = np.arange(self.n_letters, self.n_letters + len(fresh))
        self.letters[self.n_letters : self.n_letters + len(fresh)] = fresh
        self.n_letters += len(fresh)
        return self.number[codes].astype(np.uint64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Slots of runs."""
        codes, uniques = pd.factorize(keys)
        at = np.searchsorted(self.keys, uniques)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniques[known]
        fresh = uniques[~known]
        if len(fresh):
            shifts = np.array([48, 32, 16, 0], dtype=np.uint64)
            self.names = np.vstack([self.names, self.letters[((fresh[:, None] >> shifts) & np.uint64(0xFFFF)).astype(np.int64)]])
            keys_, slots = np.concatenate([self.keys, fresh]), np.concatenate([self.slot, np.arange(len(self.slot), len(self.slot) + len(fresh))])
            order = np.argsort(keys_, kind="stable")
            self.keys, self.slot = keys_[order], slots[order]
        return self.slot[np.searchsorted(self.keys, uniques)][codes]

    def __len__(self) -> int:
        return len(self.keys)


def runs(sentences: list[str], slot: Slots) -> tuple[np.ndarray, np.ndarray]:
    """``(row, slot)`` of each run of 2 to 4 letters of the cleaned sentences and of each dense sign.

    A run may begin or end with the blank at a word's end.
    """
    sizes = np.array([len(c) + 3 for c in sentences], dtype=np.int64)
    # a sentence and the blanks around it, then a zero that no run crosses
    codes = np.frombuffer("".join(f" {c} \0" for c in sentences).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(sentences)), sizes)
    c = slot.numbered(codes)
    rows, keys = [], []
    inside = c != 0
    key, ok = c, inside
    for k in (1, 2, 3):
        key = (key[:-1] << np.uint64(16)) | c[k:]
        ok = ok[:-1] & inside[k:]
        rows.append(row[: len(ok)][ok])
        keys.append(key[ok])
    dense = ((codes >= 0x3040) & (codes <= 0x30FF)) | ((codes >= 0x3400) & (codes <= 0x9FFF))
    rows.append(row[dense])
    keys.append(c[dense])
    return np.concatenate(rows), slot.of(np.concatenate(keys))


class Counted:
    """Sentences as rows of run counts: entries (row, run, count) sorted by row."""

    def __init__(self, sentences: list[str], slot: Slots):
        row, ids = runs(sentences, slot)
        width = max(len(slot), 1)
        key, self.n = np.unique(row * width + ids, return_counts=True)
        self.row, self.run = key // width, key % width
        self.rows = len(sentences)
        self.norm = np.sqrt(np.bincount(self.row, weights=self.n.astype(np.float64) ** 2, minlength=self.rows))

    def cosines(self, dots: np.ndarray) -> np.ndarray:
        """Cosine of each row with each prototype, from the runs' dot products with the prototypes."""
        out = np.zeros((self.rows, dots.shape[1]))
        if len(self.row):
            starts = np.flatnonzero(np.diff(self.row, prepend=-1))
            out[self.row[starts]] = np.add.reduceat(dots[self.run] * self.n.astype(np.float32)[:, None], starts, axis=0, dtype=np.float64)
        return out / np.maximum(self.norm * np.sqrt(DIM), 1e-9)[:, None]

    def totals(self, share: np.ndarray, width: int) -> np.ndarray:
        """Run counts per language, where share[row, language] says how often a row counts for it."""
        return np.stack([np.bincount(self.run, weights=self.n * share[self.row, k], minlength=width) for k in range(share.shape[1])], axis=1)


def centred(prototypes: np.ndarray) -> np.ndarray:
    unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    unit = unit - unit.mean(axis=0)
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


class Profiles:
    """Scores sentences against prototypes in one process.

    A sentence's vector is the sum of its runs', so its dot product with a prototype is
    the sum of theirs, and these are kept per run. Its squared length is taken as
    DIM times the sum of squared run counts, which it equals but for the chance
    overlap of random vectors.
    """

    def __init__(self, prototypes: np.ndarray):
        self.vectors = Vectors()
        self.unit = centred(prototypes)
        self.slot = Slots()
        self.dots = np.zeros((0, len(self.unit)), dtype=np.float32)
        self.seen: dict[str, tuple[int, float]] = {}
        self.letters = 0
        self.memo = Sentences()

    def _learn(self) -> None:
        names = self.slot.names[len(self.dots) :]
        if len(names):
            self.dots = np.vstack([self.dots, *[v @ self.unit.T for _, v in self.vectors.blocks(names)]])

    def classify(self, cleaned: list[str]) -> list[tuple[int, float]]:
        """``(language, confidence)`` of each."""
        if self.letters > KEPT:
            self.seen.clear()
            self.letters = 0
        if self.slot.full():
            self.slot = Slots()
            self.dots = self.dots[:0]
        new = [c for c in dict.fromkeys(cleaned) if c not in self.seen]
        self.letters += sum(map(len, new))
        for a in range(0, len(new), 2000):
            part = new[a : a + 2000]
            counted = Counted(part, self.slot)
            self._learn()
            cos = counted.cosines(self.dots)
            e = np.exp(TEMPERATURE * (cos - cos.max(axis=1, keepdims=True)))
            self.seen.update(zip(part, zip(cos.argmax(axis=1).tolist(), (e.max(axis=1) / e.sum(axis=1)).tolist())))
        return [self.seen[c] for c in cleaned]


def train_prototypes(texts: list[str], labels: list[str | None], rounds: int = ROUNDS) -> np.ndarray:
    """Prototypes (12, DIM) from labelled texts; labels are two-letter codes.

    A run enters a language's bundle with the weight log(p(run|language) / p(run)),
    where that is positive, so that runs common to several languages don't fill it.
    """
    code = {c: i for i, c in enumerate(CODES)}
    votes: dict[str, np.ndarray] = {}
    memo = Sentences()
    for t, l in zip(texts, labels):
        if t and l in code:
            for _, _, c in segments(t, memo):
                votes.setdefault(c, np.zeros(len(CODES)))[code[l]] += 1
    slot = Slots()
    seeds, vectors = Counted([SEEDS[c] for c in CODES], slot), Vectors()
    known = Counted(list(votes), slot)
    names = slot.names
    share = np.array(list(votes.values())).reshape(-1, len(CODES))
    often = share.sum(axis=1)
    fixed = seeds.totals(np.eye(len(CODES)), len(names))
    protos = np.zeros((len(CODES), DIM), dtype=np.float32)
    for no in range(rounds + 1):
        counts = fixed + known.totals(share, len(names))
        rate = (counts + 0.05) / np.maximum(counts.sum(axis=0), 1)
        weight = (np.maximum(np.log(rate / rate.mean(axis=1, keepdims=True)), 0.0) * (counts > 0)).astype(np.float32)
        protos = np.zeros((len(CODES), DIM), dtype=np.float32)
        for a, v in vectors.blocks(names):
            protos += weight[a : a + len(v)].T @ v
        if no < rounds and len(often):
            unit = centred(protos)
            dots = np.vstack([v @ unit.T for _, v in vectors.blocks(names)])
            share = np.eye(len(CODES))[known.cosines(dots).argmax(axis=1)] * often[:, None]
    return protos


def sample(df: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int = SAMPLE) -> DataFrame:
    """At most per_label rows ``(text, label)`` of each language, by hash of the id."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), canonical_label(F.col(label_col)).alias("label"))
    rows = rows.filter(F.col("label").isin(*CODES) & F.col("text").isNotNull())
    rank = F.row_number().over(W.partitionBy("label").orderBy(F.xxhash64(F.lit(7), "id"), "id"))
    return rows.withColumn("rk", rank).filter(F.col("rk") <= per_label).select("text", "label")


def _train_group(pdf: pd.DataFrame) -> pd.DataFrame:
    p = train_prototypes(pdf["text"].tolist(), pdf["label"].tolist())
    return pd.DataFrame({"lang": CODES, "vector": [row.tolist() for row in p]})


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = SAMPLE) -> np.ndarray:
    """Prototypes from a sample of at most 12 x per_label documents, made in one task."""
    bounded = sample(df, id_col, text_col, label_col, per_label).withColumn("g", F.lit(0))
    rows = bounded.groupBy("g").applyInPandas(lambda pdf: _train_group(pdf), "lang string, vector array<double>").collect()
    if not rows:
        return train_prototypes([], [])
    by = {r.lang: r.vector for r in rows}
    return np.array([by[c] for c in CODES])


def label_texts(profiles: Profiles, texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
    """``(start, end, lang, confidence)`` of each sentence of each text, each by its own words alone."""
    found = [segments(t, profiles.memo) if t else [] for t in texts]
    scored = iter(profiles.classify([c for f in found for _, _, c in f]))
    return [[(a, e, CODES[k], conf) for (a, e, _), (k, conf) in zip(f, scored)] for f in found]


def label_segments(profiles: Profiles, text: str | None) -> list[tuple[int, int, str, float]]:
    return label_texts(profiles, [text])[0]


def slices(texts: list[str | None], most: int = 1_000_000):
    """Runs of whole texts of about ``most`` characters."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t) if t else 0
        if n > most:
            yield run
            run, n = [], 0
    yield run


ship_by_value(sys.modules[__name__])

_SEGMENT = "array<struct<start:int,end:int,lang:string,confidence:double>>"


def identify(df: DataFrame, prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """``(id_col, more..., segments)`` of every row, in one pass without a shuffle."""
    src = spread(df.select(text_col, id_col, *more))
    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in (id_col, *more)) + f", segments {_SEGMENT}"
    shared = df.sparkSession.sparkContext.broadcast(prototypes.astype(np.float32))

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())]))
        profiles = Profiles(shared.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(0).to_pylist()):
                found = [[{"start": a, "end": e, "lang": l, "confidence": c} for a, e, l, c in segs] for segs in label_texts(profiles, texts)]
                kept = [c.slice(at, len(texts)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], [*batch.schema.names[1:], "segments"])
                at += len(texts)

    return src.mapInArrow(run, schema)


def segment_rows(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, seg_no, start, end, lang, confidence)``, one row per sentence; offsets count characters."""
    return found.select(id_col, F.posexplode("segments").alias("seg_no", "s")).select(id_col, "seg_no", "s.*")


def languages(found: str = "segments") -> Column:
    """Distinct languages of the segments, sorted."""
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: s.getField("lang"))))


def main_language(found: str = "segments") -> Column:
    """Struct ``(chars, lang, confidence)`` of the language with most characters."""
    langs = F.array_distinct(F.transform(found, lambda s: s.getField("lang")))
    size = lambda l: F.aggregate(F.filter(found, lambda s: s.getField("lang") == l), F.lit(0), lambda a, s: a + s.getField("end") - s.getField("start"))
    conf = lambda l: F.aggregate(F.filter(found, lambda s: s.getField("lang") == l), F.lit(0.0), lambda a, s: a + s.getField("confidence") * (s.getField("end") - s.getField("start")))
    return F.array_max(F.transform(langs, lambda l: F.struct(size(l).alias("chars"), l.alias("lang"), (conf(l) / size(l)).alias("confidence"))))
