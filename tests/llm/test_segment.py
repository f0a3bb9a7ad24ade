import random

from pyspark.sql import functions as F

from tracemill.llm import segment

TOPIC = {
    "cat": "The cat chased a mouse. A cat purrs on the mat. My cat hunts every mouse.",
    "tax": "The tax form lists income. Each tax office checks income. Pay the tax on income.",
}


def rejoin(text, ends, overlap):
    out, last = "", 0
    for k, e in enumerate(ends):
        start = 0 if k == 0 else max(ends[k - 1] - overlap, 0)
        piece = text[start:e]
        if k:
            assert piece.startswith(text[ends[k - 1] - overlap : ends[k - 1]][-overlap:])
        out += text[last:e]
        last = e
    return out


def test_pieces_stay_under_the_limit_and_rejoin():
    rng = random.Random(3)
    for _ in range(60):
        words = ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 900))]
        text = "".join(w + rng.choice([" ", " ", ". ", "\n", "\n\n", ""]) for w in words)
        cut = sorted({rng.randint(0, len(text)) for _ in range(5)} | {len(text)})
        ends = segment.plan_cuts(text, cut, segment.Slots(), limit=500, overlap=40)
        assert ends == sorted(set(ends)) and ends[-1] == len(text)
        starts = [0, *[e - 40 for e in ends[:-1]]]
        assert all(0 < e - s <= 500 for s, e in zip(starts, ends))
        assert rejoin(text, ends, 40) == text


def test_cut_falls_into_the_valley_between_topics():
    text = (TOPIC["cat"] + " ") * 6 + (TOPIC["tax"] + " ") * 6
    seam = len((TOPIC["cat"] + " ") * 6)
    limit = seam + 120
    ends = segment.plan_cuts(text, [len(text)], segment.Slots(), limit=limit, overlap=20)
    assert ends[0] == seam


def test_slabs_give_the_same_depths(monkeypatch):
    rng = random.Random(9)
    text = "".join(f"{rng.choice(['cat', 'tax', 'mouse', 'income', 'form'])} {rng.choice(['a', 'b'])}{rng.randint(0, 9)}. " for _ in range(500))
    at, _ = segment.boundaries(text, [])
    whole = segment.valley_depths(text, at, segment.Slots())
    for size in (1, 3, 64):
        monkeypatch.setattr(segment, "SLAB", size)
        assert (segment.valley_depths(text, at, segment.Slots()) == whole).all()


def test_memory_of_a_transcript_of_4_million_characters():
    import tracemalloc

    text = "".join(f"Word {k} of it is here. " for k in range(180_000))
    tracemalloc.start()
    ends = segment.plan_cuts(text, [len(text)], segment.Slots())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 4_000_000 and ends[-1] == len(text) and peak < 120e6


def test_word_end_then_hard_cut():
    assert segment.plan_cuts("ab " * 400, [1200], segment.Slots(), limit=100, overlap=10)[0] % 3 == 0
    ends = segment.plan_cuts("x" * 1000, [1000], segment.Slots(), limit=100, overlap=10)
    assert ends[0] == 100 and ends[-1] == 1000
    marks = segment.plan_cuts("é" * 500, [1000], segment.Slots(), limit=101, overlap=10)
    assert all(e % 2 == 0 for e in marks)


def test_nulls_latest_save_and_clashing_columns(spark):
    row = "named_struct('role', 'user', 'content', array(named_struct('type', 'text', 'text', repeat('a b. ', 2000), 'image', cast(null as string)), named_struct('type', 'image', 'text', 'zzz', 'image', 'i')))"
    none = "cast(null as array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>)"
    df = spark.sql(
        f"""SELECT 'r' run_id, 'long' trajectory_id, array({row}) messages, timestamp_ntz'2026-01-02' saved_at, 1 AS n_chars, 2 AS ends
        UNION ALL SELECT 'r', 'long', array({row}), timestamp_ntz'2026-01-02', 1, 2
        UNION ALL SELECT 'r', 'shrunk', array({row}), timestamp_ntz'2026-01-01', 1, 2
        UNION ALL SELECT 'r', 'shrunk', {none}, timestamp_ntz'2026-01-03', 1, 2
        UNION ALL SELECT 'r', 'null', {none}, null, 1, 2"""
    )
    path = segment_path(spark, df)
    t = segment.transcripts(spark, path)
    got = {r.trajectory_id: (r.n_chars, len(r.ends)) for r in segment.plans(t).collect()}
    assert got["long"][0] == 10000 and got["long"][1] == 2
    assert got["shrunk"] == (0, 1) and got["null"] == (0, 1)
    p = segment.pieces(t).orderBy("trajectory_id", "piece_no").collect()
    long = [r for r in p if r.trajectory_id == "long"]
    assert all(len(r.text) <= 6000 for r in p) and long[1].text[:200] == long[0].text[-200:]
    assert segment.pieces(t.limit(0)).count() == 0


def segment_path(spark, df):
    from tracemill.session import shared_dir
    import uuid

    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
