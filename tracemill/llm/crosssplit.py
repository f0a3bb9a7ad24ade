"""Same or near-same records across splits, by content-defined chunks.

Normal form: the distinct words of a record, rarest first (document frequency, then
the word). Word order, case, padding and repeats don't matter, and edits of
one record's wording touch few places of it. Records of one normal form are one class,
and only classes are compared.

Chunks: the normal form is cut where the hash of a rolling window of two words ends
in ``MASK`` zero bits, so equal runs of words are cut alike wherever they stand. Chunk
digests are joined across splits (within a split nothing is paired), and the lengths of
the shared chunks are summed per pair into overlap fractions of either record. Shared
chunks that alone reach the threshold prove a pair; of all others that share a chunk, the
words are compared.

Chunks that more than ``COMMON`` classes hold are left out of that join, and a pair whose
edits fall into every chunk shares none. The exact way for the rest: two sets of words
with a Jaccard similarity of at least t always share a word of both *heads*, the first
``n - ceil(t * n) + 1`` words, as the order is the same for all records. Head words are
joined across splits, except *hot* words, which more than ``COMMON`` classes and more than
1/HEAVY of all places hold. As hot words stand last in each normal form, a pair whose heads
share hot words alone shares two of them in heads a word longer (different classes at
t > 2/3 share at least two words), so hot words are joined as pairs of words. Pairs from this
way are checked on their words. :func:`overlaps` tells for each pair which way found it.

Word frequencies of all records are joined back in two ways: words with
more than 1/HEAVY of all places are at most HEAVY, counted, and broadcast; each
other word has at most that share of the rows, so its join has no hot key.

Results are pairs of classes plus the members of each class; equal records aren't
expanded into pairs until :func:`entry_pairs` is asked for them.

Defined cases: null, empty and wordless texts match by key only; null keys match
nothing; records of a null split belong to no split; an empty table gives no
pairs; repeated rows give no repeated pairs; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.session import materialize

THRESHOLD, MASK, HEAVY, COMMON = 0.7, 1, 20_000, 64


def norm_key(c: Column) -> Column:
    """Without case, surrounding blanks and a final ``.json``."""
    bare = F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\.json$", ""), r"(?U)\s+$", "")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column) -> Column:
    """Distinct runs of letters and digits, lower case, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"))))


def longest_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(k, text)``: the longest trimmed text of each key; equally long ones by the greatest."""
    rows = df.select(norm_key(F.col(key)).alias("k"), strip(F.col(text)).alias("text")).filter("k is not null and length(text) > 0")
    return rows.groupBy("k").agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("m")).select("k", "m.text")


def classes(texts: DataFrame) -> DataFrame:
    """``(k, class)``, and the words of each class are those of any of its texts."""
    w = texts.select("k", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    return w.withColumn("class", F.md5(F.array_join("words", " ")))


def rare_first(sets: DataFrame, common: int = COMMON) -> DataFrame:
    """``(class, seq, cold)`` of rows ``(class, words)``: words ordered by frequency over all classes; cold of them aren't hot."""
    places = sets.select("class", F.explode("words").alias("word"))
    freq = materialize(places.groupBy("word").agg(F.count("*").alias("n")), "freq")
    total = freq.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(1, total // HEAVY)
    heavy = F.broadcast(freq.filter(F.col("n") > limit).withColumnRenamed("n", "heavy_n"))  # at most HEAVY words
    marked = places.join(heavy, "word", "left")
    light = marked.filter("heavy_n is null").select("class", "word").join(freq.filter(F.col("n") <= limit), "word")
    ranked = marked.filter("heavy_n is not null").select("class", "word", F.col("heavy_n").alias("n")).unionByName(light)
    seq = F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x.getField("word"))
    return ranked.groupBy("class").agg(seq.alias("seq"), F.count_if(F.col("n") <= max(limit, common)).cast("int").alias("cold"))


def head_length(n: Column, threshold: float = THRESHOLD) -> Column:
    return (n - F.ceil(n * threshold - 1e-9) + 1).cast("int")


def with_chunks(df: DataFrame, seq: str = "seq", mask: int = MASK) -> DataFrame:
    """Adds ``chunks``: ``array<struct<digest, len>>`` of a word sequence."""
    c = F.col(seq)
    n = F.size(c)
    rolled = lambda i: F.xxhash64(F.get(c, i - 2), F.get(c, i - 1))
    cut = lambda i: (i == n) | (rolled(i).bitwiseAND(F.lit((1 << mask) - 1)) == 0)
    # a column of its own, so that the ends aren't found again for every chunk
    ended = df.withColumn("_ends", F.filter(F.sequence(F.lit(1), n), cut))
    start = lambda j: F.when(j == 0, 0).otherwise(F.get("_ends", j - 1))
    one = lambda e, j: F.struct(F.xxhash64(F.array_join(F.slice(c, start(j) + 1, e - start(j)), " ")).alias("digest"), (e - start(j)).alias("len"))
    return ended.withColumn("chunks", F.transform("_ends", one)).drop("_ends")


def _fits(threshold: float) -> Column:
    """Sizes that don't rule the threshold out."""
    return (F.col("n_a") >= F.ceil(F.col("n_b") * threshold - 1e-9)) & (F.col("n_b") >= F.ceil(F.col("n_a") * threshold - 1e-9))


def _sides(df: DataFrame, key: str, *more: str) -> list[DataFrame]:
    """Split a's and split b's rows of df with columns named after the split."""
    return [df.filter(f"in_{s}").select(key, F.col("class").alias(f"class_{s}"), F.col("n").alias(f"n_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in more]) for s in "ab"]


def chunk_pairs(cut: DataFrame, threshold: float = THRESHOLD, common: int = COMMON) -> DataFrame:
    """``(class_a, class_b, n_a, n_b, shared_len)`` of different classes that share chunks, from the sum of their lengths."""
    each = cut.withColumn("c", F.explode("chunks")).select("class", "in_a", "in_b", "n", "c.digest", "c.len")
    rare = each.groupBy("digest").agg(F.count("*").alias("held"), F.bool_or("in_a").alias("x"), F.bool_or("in_b").alias("y")).filter(F.col("x") & F.col("y") & (F.col("held") <= common))
    a, b = _sides(each.join(rare.select("digest"), "digest", "left_semi"), "digest", "len")
    met = a.join(b.drop("len_b"), "digest").filter(_fits(threshold) & (F.col("class_a") != F.col("class_b")))
    return met.groupBy("class_a", "class_b", "n_a", "n_b").agg(F.sum("len_a").alias("shared_len"))


def head_pairs(cut: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(class_a, class_b)`` of different classes, among them all that reach the threshold, from the words of their heads."""
    head = head_length(F.col("n"), threshold)
    words = cut.select("class", "in_a", "in_b", "n", F.posexplode(F.slice("seq", 1, F.least(head, F.col("cold")))).alias("at", "word"))
    a, b = _sides(words, "word", "at")
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-9)
    reach = 1 + F.least(F.col("n_a") - F.col("at_a") - 1, F.col("n_b") - F.col("at_b") - 1)
    met = a.join(b, "word").filter(_fits(threshold) & (F.col("class_a") != F.col("class_b")))
    # a first common word so far back that too few can follow shows in the greatest reach
    by_word = met.groupBy("class_a", "class_b").agg(F.max(reach - needed).alias("slack")).filter("slack >= 0").select("class_a", "class_b")
    hot = F.slice("seq", F.col("cold") + 1, F.greatest(F.least(head + 1, F.col("n")) - F.col("cold"), F.lit(0)))
    two = F.flatten(F.transform("hot", lambda x, i: F.transform(F.slice("hot", i + 2, F.size("hot")), lambda y: F.concat_ws(" ", x, y))))
    pairs = cut.filter(F.col("cold") < head).withColumn("hot", hot).select("class", "in_a", "in_b", "n", F.explode(two).alias("two"))
    a, b = _sides(pairs, "two")
    by_two = a.join(b, "two").filter(_fits(threshold) & (F.col("class_a") != F.col("class_b"))).select("class_a", "class_b")
    return by_word.unionByName(by_two).distinct()


def overlaps(records: DataFrame, threshold: float = THRESHOLD, common: int = COMMON) -> DataFrame:
    """Pairs of different classes ``(class_a, class_b, shared_len, overlap_a, overlap_b, jaccard, by_chunks)`` that reach the threshold.

    records: ``(class, words, in_a, in_b)``, one row per class; a is one split, b the
    other. shared_len counts the words of the joined chunks, overlap_a and overlap_b
    are its shares of either record (0 where by_chunks is false).
    """
    if threshold <= 2 / 3:
        raise ValueError("pairs of hot words need a threshold above 2/3")
    seqs = rare_first(records.select("class", "words"), common).join(records.select("class", "in_a", "in_b"), "class")
    cut = materialize(with_chunks(seqs.withColumn("n", F.size("seq"))), "chunks")
    shared = materialize(chunk_pairs(cut, threshold, common), "shared")
    rest = head_pairs(cut, threshold).join(shared.select("class_a", "class_b"), ["class_a", "class_b"], "left_anti")
    both = shared.select("class_a", "class_b", "shared_len", F.lit(True).alias("by_chunks")).unionByName(rest.select("class_a", "class_b", F.lit(0).cast("long").alias("shared_len"), F.lit(False).alias("by_chunks")))
    sides = both.join(cut.select(F.col("class").alias("class_a"), F.col("seq").alias("seq_a"), F.col("n").alias("n_a")), "class_a")
    sides = sides.join(cut.select(F.col("class").alias("class_b"), F.col("seq").alias("seq_b"), F.col("n").alias("n_b")), "class_b")
    # words in shared chunks are common words, so enough of them need no look at the words
    proven = F.col("shared_len") * (1 + threshold) >= (F.col("n_a") + F.col("n_b")) * threshold - 1e-9
    common_words = F.size(F.array_intersect("seq_a", "seq_b"))
    union = F.col("n_a") + F.col("n_b") - common_words
    reached = proven | (common_words * 1.0 >= union * threshold - 1e-9)
    return sides.filter(reached).select(
        "class_a", "class_b", "shared_len", (F.col("shared_len") / F.col("n_a")).alias("overlap_a"), (F.col("shared_len") / F.col("n_b")).alias("overlap_b"),
        (common_words / union).alias("jaccard"), "by_chunks",
    )


def cross_split(entries: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, common: int = COMMON) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``(entry, is_a, class)`` of every entry, and the linked pairs of classes.

    entries: ``(entry, k, is_a)``; texts: ``(k, text)``. Entries of equal words, or of one
    key without words, are a class. links: ``(class_a, class_b, jaccard, overlap_a,
    overlap_b, by_chunks)``; a class in both splits is linked with itself.
    """
    ent = entries.filter("k is not null and is_a is not null").select("entry", "k", "is_a").distinct()
    cls = materialize(classes(texts.join(ent.select("k").distinct(), "k", "left_semi")), "classes")
    members = materialize(ent.join(cls.select("k", "class"), "k", "left").select("entry", "is_a", F.coalesce("class", F.concat(F.lit("key "), "k")).alias("class")), "members")
    flags = materialize(members.groupBy("class").agg(F.bool_or("is_a").alias("in_a"), F.bool_or(~F.col("is_a")).alias("in_b")), "flags")
    sets = cls.groupBy("class").agg(F.first("words").alias("words"))
    near = overlaps(sets.join(flags, "class"), threshold, common).drop("shared_len")
    one = F.lit(1.0)
    own = flags.filter(F.col("in_a") & F.col("in_b")).select(F.col("class").alias("class_a"), F.col("class").alias("class_b"), one.alias("overlap_a"), one.alias("overlap_b"), one.alias("jaccard"), F.lit(True).alias("by_chunks"))
    return members, own.unionByName(near)


def entry_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, b)``: the pairs of entries that the links of their classes make."""
    side = lambda s, own: members.filter(own).select(F.col("entry").alias(s), F.col("class").alias(f"class_{s}"))
    return links.select("class_a", "class_b").join(side("a", F.col("is_a")), "class_a").join(side("b", ~F.col("is_a")), "class_b").select("a", "b")
