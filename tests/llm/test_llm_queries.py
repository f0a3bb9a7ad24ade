"""The queries of the training-data operators on the smallest test data."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tracemill.llm.queries import LLM

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "p1_found": [("run_id", "string"), ("trajectory_id", "string")],
    "p3_found": [("id", "bigint")],
    "p4_found": [("entry_a", "bigint"), ("entry_b", "bigint")],
    "p6_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p7_found": [("doc_id", "bigint")],
    "p8_found": [("doc_id", "bigint"), ("lang", "string")],
}


@pytest.mark.parametrize("name", sorted(LLM.runs))
def test_query(spark, name):
    df = LLM.runs[name](spark, str(DATA))
    assert df.dtypes == COLUMNS.get(name, df.dtypes)
    rows = df.collect()
    if name in LLM.sql:
        con = duckdb.connect()
        for p in DATA.glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        cur = con.execute(LLM.sql[name])
        names = [c[0] for c in cur.description]
        assert Counter(tuple(r[c] for c in names) for r in rows) == Counter(cur.fetchall())


def test_tokens_match_the_public_encoder_on_whole_documents(spark):
    from tokenizers import Tokenizer

    from tracemill.llm import bpe

    t = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: e.ids for d, e in zip(docs, t.encode_batch([d.text or "" for d in docs], add_special_tokens=False))}
    got = {r.doc_id: r.ids for r in LLM.runs["p6_ids"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    oversized = {d for d, ids in want.items() if len(ids) > 2048}
    assert {r.doc_id for r in LLM.runs["p7_found"](spark, "/root/testdata/sf0.01").collect()} == oversized
    placed = LLM.runs["p7_containers"](spark, "/root/testdata/sf0.01").collect()
    sums, docs_seen = Counter(), Counter()
    for r in placed:
        sums[r.container] += r.n_tokens
        docs_seen[r.doc_id] += r.n_tokens
    assert max(sums.values()) <= 2048 and docs_seen == {d: len(ids) for d, ids in want.items() if ids}
