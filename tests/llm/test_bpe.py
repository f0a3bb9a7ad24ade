import random
import string

import pytest
from pyspark.sql import functions as F

from tracemill.llm import bpe

TEXTS = [
    None, "", " ", "\n\t ", "Hello world, it's  me!", "<|endoftext|> is text", "日本語のテキスト、漢字" * 20, "नमस्ते दुनिया", "a" * 1500, "-=" * 900 + "---", "x1y22z333 ½ Ⅷ ﬁ 👩‍💻🇪🇺",
    "Schöne Grüße\r\n …", "\x00\x01�", "é" * 50, "AbCdEf" * 300,
]


@pytest.fixture(scope="module")
def expected():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False)]


def test_equals_the_public_encoder_and_round_trips(spark, expected):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    ids = bpe.encode(df)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert [got[i] for i in range(len(TEXTS))] == expected
    counts = {r.doc_id: r.n_tokens for r in bpe.count_tokens(df).collect()}
    assert counts == {i: len(x) for i, x in enumerate(expected)}
    back = {r.doc_id: r.text for r in bpe.decode(ids).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert ids.schema["ids"].dataType.simpleString() == "array<int>"
    assert bpe.encode(df.limit(0)).count() == 0 and bpe.encode(df.union(df)).count() == 2 * len(TEXTS)


def test_windows_join_to_the_tokens_of_whole_words():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    draw = random.Random(5)
    words = []
    for letters in ("=", "ab", "abc", "─", "\u3000", "ACGT", "xX", "あい", "=-", string.ascii_letters):
        for n in (2, 49, 97, 700):
            words += ["".join(draw.choice(letters) for _ in range(n)), "q" + (letters * n)[:n]]
    words += ["=" * 1_000_000, "".join(draw.choice(string.ascii_letters) for _ in range(1_000_000))]
    assert bpe.Encoder(bpe.vocabulary()).encode(words) == [x.ids for x in t.encode_batch(words, add_special_tokens=False)]


def test_neighbours_without_a_common_token_are_told():
    size = {1: 1, 2: 2}
    assert bpe.joined([(0, (1, 2, 1)), (1, (2, 1, 1))], size) == [1, 2, 1, 1]
    assert bpe.joined([(0, (2, 2)), (1, (2, 2))], size) is None


def test_small_memory_gives_the_same(monkeypatch, expected):
    monkeypatch.setattr(bpe, "KEPT", 3)
    monkeypatch.setattr(bpe, "BATCH", 50)
    e = bpe.Encoder(bpe.vocabulary())
    assert [x for t in TEXTS for x in e.encode([t])] == expected
