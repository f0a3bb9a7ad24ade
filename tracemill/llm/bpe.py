"""Encoding of a corpus with a public byte-level BPE, by recursive DuckDB queries.

Each Python worker holds one in-memory DuckDB with the merge table. The words of a
batch of texts (cut by the tokenizer's own pattern) that the worker hasn't met are
loaded as token-position rows, one per byte, and a recursive query contracts each
word's leftmost pair of minimum rank, by a join with the merge table, until no word
has a mergeable pair; an ordered aggregation yields the ids. A step contracts that pair
at all its places from left to right, every second one in a run of one token, as steps of
one place each would do one after the other, since a merge makes no pair of a lower rank.
:func:`decode` goes back by an ordered aggregation of the tokens' bytes.

Two things make the rows of that query linear in the text without changing a result.
Words are first cut where no token of the vocabulary holds both neighbouring bytes, as
no merge can cross there. What is left is covered by windows of ``2 * STEP`` bytes, each
beginning ``STEP`` after the one before (a short word is one window), and equal windows
are contracted once. Two neighbours that agree on one whole token in their common half
are joined at it: a row of tokens is the encoding of its text if each two neighbours in
it are that of theirs, and these stand together in a window. Where two windows agree on
none, the word is covered anew by windows twice as long, at last by itself alone.

The vocabulary (fixed size) is read once, on the driver, from a path that is a
parameter, and broadcast. Work is linear in the text, plus once per distinct window
and worker: a worker keeps its words from task to task, at most ``KEPT`` letters of them.

Defined cases: null and empty texts give an empty list; blank texts are encoded as
they are; strings of special tokens are ordinary text; lone surrogates are encoded
as U+FFFD; repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import json
import sys
import types
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tracemill.session import env_path, ship_by_value, spread

TOKENIZERS = env_path("TRACEMILL_TOKENIZERS", "/opt/tokenizers")
#: the pre-tokenizer's pattern, a fixed value of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: first distance of windows in bytes; work of one query, as the sum of squared lengths; letters of the words that a worker keeps
STEP, BATCH, KEPT = 24, 4_000_000, 8_000_000


def byte_letters() -> dict[int, str]:
    """Byte-level letters: printable Latin-1 bytes stand for themselves, the rest for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merge table, byte ids, tokens' bytes and the byte pairs that some token holds, as plain arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids: dict[str, int] = model["vocab"]
        self.mark = uuid.uuid4().hex
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int32)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        self.byte_ids = np.array([ids[letters[b]] for b in range(256)], dtype=np.int32)
        self.joined = np.zeros((256, 256), dtype=bool)
        self.tokens: dict[int, bytes] = {}
        for t, i in ids.items():
            if all(c in back for c in t):
                raw = bytes(back[c] for c in t)
                self.tokens[i] = raw
                for a, b in zip(raw, raw[1:]):
                    self.joined[a, b] = True


_RECURSIVE = """
WITH RECURSIVE state AS (
  SELECT w, pos, tok, false AS done FROM bytes
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT s.w, s.pos, s.tok, s.after, m.rank, m.merged
     FROM (SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt, lead(pos) OVER (PARTITION BY w ORDER BY pos) AS after FROM state WHERE NOT done) s
     LEFT JOIN merges m ON m.l = s.tok AND m.r = s.nxt),
   least AS MATERIALIZED (SELECT w, min(rank) AS rank FROM pairs GROUP BY w),
   hits AS (SELECT p.w, p.pos, p.after, p.merged, CASE WHEN lag(p.after) OVER (PARTITION BY p.w ORDER BY p.pos) = p.pos THEN 0 ELSE 1 END AS fresh
     FROM pairs p JOIN least l ON p.w = l.w AND p.rank = l.rank),
   runs AS (SELECT *, sum(fresh) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM hits),
   taken AS MATERIALIZED (SELECT w, pos, after, merged FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS k FROM runs) WHERE k % 2 = 1)
   SELECT p.w, p.pos, coalesce(t.merged, p.tok) AS tok, l.rank IS NULL AS done
   FROM pairs p JOIN least l ON p.w = l.w LEFT JOIN taken t ON t.w = p.w AND t.pos = p.pos
   WHERE NOT EXISTS (SELECT 1 FROM taken g WHERE g.w = p.w AND g.after = p.pos))
)
SELECT w, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY w ORDER BY w
"""


def joined(windows: list[tuple[int, tuple[int, ...]]], size: dict[int, int]) -> list[int] | None:
    """Ids of the word that the windows (start, ids) cover, or None where two neighbours have no token in common.

    size gives the bytes of each id.
    """
    out: list[int] = []
    cut = windows[0][0]
    for k, (start, ids) in enumerate(windows):
        nxt = windows[k + 1] if k + 1 < len(windows) else None
        theirs = {}
        if nxt is not None:
            at = nxt[0]
            for i in nxt[1]:
                theirs[at] = i
                at += size[i]
        at, found = start, nxt is None
        for i in ids:
            if at >= cut:
                if theirs.get(at) == i:
                    cut, found = at, True
                    break
                out.append(i)
            at += size[i]
        if not found:
            return None
    return out


class Encoder:
    """Encodes texts in one process. Words met are kept, up to KEPT letters of them."""

    def __init__(self, vocabulary: Vocabulary):
        import duckdb
        import regex

        self.v = vocabulary
        self.size = {i: len(raw) for i, raw in vocabulary.tokens.items()}
        self.find = regex.compile(PATTERN).findall
        self.kept: dict[str, tuple[int, ...]] = {}
        self.count: dict[str, int] = {}
        self.letters = 0
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = pd.DataFrame({"l": vocabulary.left, "r": vocabulary.right, "rank": np.arange(len(vocabulary.left), dtype=np.int32), "merged": vocabulary.merged})
        self.db.register("m", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.db.unregister("m")

    def parts(self, words: list[str]) -> list[list[bytes]]:
        """Each word's bytes, cut where no merge can cross."""
        raws = [w.encode() if w.isascii() else w.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode() for w in words]
        every = b"".join(raws)
        b = np.frombuffer(every, dtype=np.uint8)
        ends = np.cumsum([len(r) for r in raws])
        cut = np.ones(len(b), dtype=bool)  # whether a part ends after the byte
        cut[:-1] = ~self.v.joined[b[:-1], b[1:]]
        cut[ends - 1] = True
        at = np.flatnonzero(cut) + 1
        n = np.diff(np.searchsorted(at, ends, side="right"), prepend=0)
        whole = at.tolist()
        cuts = [every[x:y] for x, y in zip([0, *whole], whole)]
        out, k = [], 0
        for m in n.tolist():
            out.append(cuts[k : k + m])
            k += m
        return out

    def contract(self, parts: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of parts of at least one byte, by one recursive query."""
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        every = np.frombuffer(b"".join(parts), dtype=np.uint8)
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = pd.DataFrame({"w": np.repeat(np.arange(len(parts), dtype=np.int32), sizes), "pos": (np.arange(len(every)) - starts).astype(np.int32), "tok": self.v.byte_ids[every]})
        self.db.register("rows_", rows)
        self.db.execute("CREATE OR REPLACE TEMP TABLE bytes AS SELECT * FROM rows_")
        self.db.unregister("rows_")
        return [tuple(ids) for _, ids in self.db.execute(_RECURSIVE).fetchall()]

    def contract_all(self, windows: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """The same in queries of bounded work, short windows first, as a query takes as many steps as its longest one."""
        done: dict[bytes, tuple[int, ...]] = {}
        batch, cost = [], 0
        for p in sorted(windows, key=len):
            if len(p) == 1:
                done[p] = (int(self.v.byte_ids[p[0]]),)
                continue
            batch.append(p)
            cost += len(p) ** 2
            if cost > BATCH:
                done.update(zip(batch, self.contract(batch)))
                batch, cost = [], 0
        if batch:
            done.update(zip(batch, self.contract(batch)))
        return done

    def encode_parts(self, parts: list[bytes], step: int = STEP) -> dict[bytes, tuple[int, ...]]:
        """Ids of each part, from windows that are made longer until all neighbours agree."""
        done: dict[bytes, tuple[int, ...]] = {}
        todo = list(dict.fromkeys(parts))
        while todo:
            starts = {p: range(0, max(len(p) - step, 1), step) for p in todo}
            found = self.contract_all(list({p[a : a + 2 * step] for p in todo for a in starts[p]}))
            left = []
            for p in todo:
                if len(starts[p]) == 1:
                    done[p] = found[p]
                    continue
                ids = joined([(a, found[p[a : a + 2 * step]]) for a in starts[p]], self.size)
                if ids is None:
                    left.append(p)
                else:
                    done[p] = tuple(ids)
            todo, step = left, 2 * step
        return done

    def learn(self, words: list[str]) -> None:
        """Encodes words that aren't kept yet."""
        cut = dict(zip(words, self.parts(words)))
        done = self.encode_parts([p for ps in cut.values() for p in ps])
        for w, ps in cut.items():
            self.kept[w] = done[ps[0]] if len(ps) == 1 else tuple(i for p in ps for i in done[p])
            self.count[w] = len(self.kept[w])
            self.letters += len(w)

    def words(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them kept."""
        found = [self.find(t) if t else [] for t in texts]
        if self.letters > KEPT:
            self.kept.clear()
            self.count.clear()
            self.letters = 0
        new = set(chain.from_iterable(found)).difference(self.kept)
        if new:
            self.learn(list(new))
        return found

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        get = self.kept.__getitem__
        return [list(chain.from_iterable(map(get, ws))) for ws in self.words(texts)]

    def sizes(self, texts: list[str | None]) -> list[int]:
        get = self.count.__getitem__
        return [sum(map(get, ws)) for ws in self.words(texts)]


def warm_encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this process, which outlives a task: made at the first call for a vocabulary."""
    held = sys.modules.setdefault("tracemill_warm", types.ModuleType("tracemill_warm"))
    if getattr(held, "bpe", (None,))[0] != vocabulary.mark:
        held.bpe = (vocabulary.mark, Encoder(vocabulary))
    return held.bpe[1]


def _slices(texts: list, most: int = 2_000_000) -> Iterator[list]:
    """Runs of texts of about ``most`` characters, so that a batch of long texts needs no more memory."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t) if t else 0
        if n > most:
            yield run
            run, n = [], 0
    if run:
        yield run


def vocabulary(path: str = TOKENIZERS, name: str = "byte_bpe_50k.json") -> Vocabulary:
    return Vocabulary(f"{path}/{name}")


def _mapper(spark: SparkSession, path: str, what: str):
    """Arrow batches (id, text) to (id, what), about two million characters at a time; ids pass unchanged."""
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        import pyarrow as pa

        encoder = warm_encoder(shared.value)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1).to_pylist()):
                out = pa.array(encoder.encode(texts), pa.list_(pa.int32())) if what == "ids" else pa.array(encoder.sizes(texts), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), out], [batch.schema.names[0], what])
                at += len(texts)

    return run


ship_by_value(sys.modules[__name__])


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """``(id_col, ids ARRAY<INT>)`` of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    return spread(df.select(id_col, text_col)).mapInArrow(_mapper(df.sparkSession, path, "ids"), f"`{id_col}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZERS) -> DataFrame:
    """``(id_col, n_tokens INT)`` of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    return spread(df.select(id_col, text_col)).mapInArrow(_mapper(df.sparkSession, path, "n_tokens"), f"`{id_col}` {kind}, n_tokens int")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = TOKENIZERS) -> DataFrame:
    """``(id_col, text)``: the texts of id lists, by an ordered aggregation in DuckDB."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import duckdb
        import pyarrow as pa

        db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        tokens = pd.DataFrame({"tok": list(shared.value.tokens), "raw": [b.hex() for b in shared.value.tokens.values()]})
        db.register("t", tokens)
        db.execute("CREATE TABLE tokens AS SELECT * FROM t")
        for batch in batches:
            lists = [x if x is not None else [] for x in batch.column(1).to_pylist()]
            sizes = [len(x) for x in lists]
            rows = pd.DataFrame({"k": np.repeat(np.arange(len(lists)), sizes), "pos": np.concatenate([np.arange(n) for n in sizes] or [[]]).astype("int64"), "tok": np.array([i for x in lists for i in x], dtype="int64")})
            db.register("rows_", rows)
            found = dict(db.execute("SELECT k, string_agg(raw, '' ORDER BY pos) FROM rows_ JOIN tokens USING (tok) GROUP BY k").fetchall())
            db.unregister("rows_")
            texts = [bytes.fromhex(found.get(i, "")).decode("utf-8", "replace") for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
