import random
import re

from pyspark.sql import functions as F

from tracemill.llm import crosssplit


def brute(entries, texts):
    w = {k: set(re.findall(r"[^\W_]+", t.lower())) for k, t in texts.items()}
    out = set()
    for e, k, a in entries:
        for f, m, b in entries:
            if a is True and b is False and k is not None and m is not None:
                near = k in w and m in w and w[k] and w[m] and 10 * len(w[k] & w[m]) >= 7 * len(w[k] | w[m])
                if k == m or near:
                    out.add((e, f))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    common = ["then", "and", "open", "file", "the", "to"]
    base = [[rng.choice(common) if rng.random() < 0.4 else f"w{rng.randint(0, 300)}" for _ in range(rng.randint(2, 25))] for _ in range(25)]
    texts, entries = {}, []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 50)}"
        rng.shuffle(words)
        texts[f"k{i}"] = " ".join(words).upper() if i % 3 else ", ".join(words)
        entries.append((i, f"k{i}", i % 2 == 0))
    entries += [(500, "k1", True), (500, "k1", True), (501, None, False), (502, "k3", None), (503, "none", True), (504, "none", False)]
    texts["k8"] = " ... "
    e = spark.createDataFrame(entries, "entry long, k string, is_a boolean")
    t = spark.createDataFrame(list(texts.items()), "k string, text string")
    pairs = lambda *x: {(r.a, r.b) for r in crosssplit.entry_pairs(*crosssplit.cross_split(*x)).collect()}
    assert pairs(e, t) == brute(entries, texts)
    # with every word of two records hot and hardly a chunk to join, the other ways find the same
    assert pairs(e, t, 0.7, 1) == brute(entries, texts)
    assert pairs(e.limit(0), t) == set()
    assert pairs(e, t.limit(0)) == brute(entries, {})


def test_chunks_find_most_pairs_alone(spark):
    """Recall of the chunk join against brute force, on texts of which up to a sixth of the words are changed."""
    rng = random.Random(11)
    texts, entries = {}, []
    for i in range(150):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(8, 40))]
        for j, a in enumerate((True, False)):
            words = list(base)
            for _ in range(rng.randint(0, len(words) // 6) if j else 0):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 3000)}"
            texts[f"k{i}-{j}"] = " ".join(words)
            entries.append((2 * i + j, f"k{i}-{j}", a))
    e = spark.createDataFrame(entries, "entry long, k string, is_a boolean")
    t = spark.createDataFrame(list(texts.items()), "k string, text string")
    members, links = crosssplit.cross_split(e, t)
    by = {r.by_chunks: r["count"] for r in links.groupBy("by_chunks").count().collect()}
    assert {(r.a, r.b) for r in crosssplit.entry_pairs(members, links).collect()} == brute(entries, texts)
    assert by[True] >= 0.9 * sum(by.values())


def test_hot_class_isn_t_expanded(spark):
    e = spark.range(3000).select(F.col("id").alias("entry"), F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") % 2 == 0).alias("is_a"))
    t = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("one and the same text").alias("text"))
    members, links = crosssplit.cross_split(e, t)
    assert links.count() == 1 and members.count() == 3000 and crosssplit.entry_pairs(members, links).count() == 1500 * 1500


def test_equal_runs_are_cut_alike(spark):
    df = spark.sql("SELECT split('r1 r2 r3 r4 a b c d e f g h i j', ' ') x, split('r1 r2 r3 q4 a b c d e f g h i j', ' ') y")
    cut = lambda c: crosssplit.with_chunks(df, c).first().chunks
    x, y = cut("x"), cut("y")
    assert sum(c["len"] for c in x) == 14 and [c.digest for c in x][-2:] == [c.digest for c in y][-2:]


def test_keys_and_longest_text(spark):
    df = spark.createDataFrame([(" AB.json ", "  short"), ("ab", "the longest one  "), ("ab.JSON", None), (None, "x"), ("c", "  ")], "task_id string, instruction string")
    got = {r.k: r.text for r in crosssplit.longest_texts(df, "task_id", "instruction").collect()}
    assert got == {"ab": "the longest one"}
