"""run() against a brute-force version: SQL verdicts, pairwise components, one tokenizer call per text."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from ragstone.llm import quality, tokens
from tests.llm.test_documents import brute_components


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(60):
        body = [word() for _ in range(rng.randint(45, 120))]
        rows += [" ".join(body)] * rng.choice([1, 1, 2])
        if i % 4 == 0:
            body[3] = word()
            rows.append(" ".join(body))
    rows += [" ".join(f"{word()}%%%" for _ in range(70)), "too short", "", None, "same line here\n" * 60]
    rows += [" ".join(word() for _ in range(60)) + " mail a.b@x.example.com now"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    good = {i for i, kept in db.execute(f"select doc_id, kept from ({quality.ORACLE_SQL})").fetchall() if kept}
    stay = {i for i, (_, part) in brute_components([(i, rows[i]) for i in good]).items() if part == i}
    tokenizer = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for p in got:
        pieces[p.doc_id].append(p)
    assert set(pieces) == stay and 50 <= len(stay) < len(good) < len(rows)
    for i, own in pieces.items():
        ids = [*tokenizer.encode(rows[i].replace("a.b@x.example.com", "<EMAIL>"), add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes()))
            at += p.length
        assert at == len(ids)


def test_stages_keep_the_columns(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == docs.columns
