import hashlib
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ragstone.llm import bpe, packing, token_files, tokens

ALPHABET = [*" \n\t\r\x0b\x1c\x85  ab'sé1٣!<|>́​😀ßΣİ中.", "<|endoftext|>", "'s", "<|startoftext|>", "..", " ", "\n"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_library_ids(name):
    path, texts = tokens.default_path(name), random_texts(3000)
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(tokens.encoder(path).encode([t])[0]) for t in texts] == want


def test_stores_turn_over():
    path = tokens.default_path("byte_bpe_50k.json")
    small, texts = tokens.Encoder(tokens.pieces_of, tokens.library_learner(path), 5), ["a b, c.", "d e f, g", "a b, h i!", "c. x y"]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(small.encode([t])[0]) for t in texts] == want


def test_own_codec_equals_the_library():
    path, texts = tokens.default_path("byte_bpe_50k.json"), [*random_texts(3000, 2), "x" * 5000, "ab" * 3000]
    codec, library = bpe.codec(path), Tokenizer.from_file(path)
    for text in texts:
        got, want = codec.encode([text])[0], library.encode(text, add_special_tokens=False).ids
        assert ids_of(got) == want
        assert codec.decode(got) == library.decode(want, skip_special_tokens=False)
    cut = np.array(library.encode("😀", add_special_tokens=False).ids[:1], "<u4").tobytes()
    assert codec.decode(cut) == library.decode(ids_of(cut), skip_special_tokens=False)


def test_round_trip_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(odd_docs).collect())
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(no_docs).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(120):
        v = rng.integers(0, 1 << int(rng.integers(1, 63)), size=rng.integers(0, 9000), dtype=np.uint64)
        v[rng.random(len(v)) < rng.random()] = 0
        if len(v):
            v[rng.integers(0, len(v), 3)] = np.array([2**64 - 1, 2**60, 2**60 - 1], np.uint64)
        blocks = token_files.encode_blocks(v)
        assert np.array_equal(np.concatenate([token_files.decode_block(d, w, e) for d, _, w, e in blocks] or [v]), v)
    zeros = token_files.encode_blocks(np.zeros(token_files.BLOCK_IDS, np.uint64))
    assert len(zeros[0][0]) < token_files.BLOCK_IDS // 20


def test_token_files_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    got = token_files.token_file_round_trip(odd_docs).collect()
    assert sorted(r.start for r in got) == list(np.cumsum([0, *[r.n_tokens for r in sorted(got, key=lambda r: r.start)][:-1]]))
    by_start = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert by_start == sorted(by_start)
    want = [(-1 if r.doc_id is None else r.doc_id, zlib.crc32(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in odd_docs.collect()]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in got) == sorted(want)
    assert token_files.token_file_round_trip(no_docs).count() == 0


def test_cuts_fill_their_class():
    for n in range(1, 3000):
        lengths = packing.cuts(n)
        assert sum(lengths) == n and all(0 < x <= 1024 for x in lengths)
        assert all(x <= packing.SHORT or 1024 - x * (1024 // x) < 1024 // x and 1024 // (1024 // x) == x for x in lengths)


def test_packing_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    pieces = packing.packed(odd_docs, with_ids=True).collect()
    sequences = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append(p)
    for held in sequences.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == list(np.cumsum([0, *[p.length for p in held][:-1]])) and sum(p.length for p in held) <= 1024
    want = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(p.length for p in pieces) == want
    five = sorted((p for p in pieces if p.doc_id == 5), key=lambda p: p.start)
    assert ids_of(b"".join(p.ids for p in five)) == [*library.encode(odd_docs.filter("doc_id = 5").first().text, add_special_tokens=False).ids, 0]
    assert packing.packed(no_docs).count() == 0


def test_files_are_cut_and_read_by_tasks_of_their_own(spark):
    """Many files and blocks, ids without bound, documents over several blocks."""
    docs = spark.createDataFrame([(i, "word " * (i * 37 % 900)) for i in range(60)], "doc_id long, text string").repartition(4)
    manifest = token_files.write_token_files(docs, tokens.default_path("word_bpe_49k.json"), file_ids=3000)
    assert manifest.count() > 8 and all(r.n_ids >= 1 for r in manifest.collect())
    rows = token_files.read_token_files(manifest)
    assert rows.rdd.getNumPartitions() == manifest.count()
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in rows.collect())
    sizes = [i * 37 % 900 + 1 for i in range(60)]
    assert got == [(i, sum(sizes[:i]), sizes[i]) for i in range(60)]
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 1 << 20, 3 * token_files.GATHER_IDS // 2).astype("<u4")
    out = io.BytesIO()
    out.close, file = lambda: None, token_files.IdFile(out)
    bounds = [0, 5, 5, 70_000, 900_000, len(ids)]
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        file.add(k, ids[a:b].tobytes())
    file.close()
    back = list(token_files.read_file(pa.BufferReader(out.getvalue())))
    assert [d for d, _ in back] == list(range(5)) and np.array_equal(np.concatenate([x for _, x in back]), ids)


def test_written_sequences_and_padding(spark, odd_docs, tmp_path):
    packing.write_sequences(odd_docs, str(tmp_path / "out"))
    pieces = packing.packed(odd_docs)
    used = {r.sequence_id: r.used for r in packing.padding(pieces).collect()}
    assert {r.sequence_id: len(r.ids) // 4 for r in spark.read.parquet(str(tmp_path / "out")).collect()} == used
    assert all(r.padding == (0 if r.used & (r.used - 1) == 0 else 1024 - r.used) for r in packing.padding(pieces).collect())
    library = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    encoded = {r.doc_id: r.ids for r in bpe.encoded(odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    texts = {r.doc_id: r.text for r in odd_docs.filter("doc_id in (1, 4, 5)").collect()}
    assert all(encoded[i] == library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items())
