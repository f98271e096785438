"""Byte-pair encoding and decoding of its own, from a tokenizer file.

Encoding a word: its symbols stand in a doubly linked list; a priority queue holds the mergeable
neighbours by merge rank, then position. The best entry is taken, skipped if one of its symbols has
changed meanwhile, else merged, and the two new neighbours are queued: O(n log n) for n symbols.
Decoding concatenates the vocabulary's byte strings. The file's added tokens are cut out first.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import slices
from ragstone.llm.tokens import PATTERN, Encoder, byte_letters, default_path, pieces_of, words_as_bytes


class BytePairCodec:
    """The vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.ids: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.byte_ids = [self.ids[c] for c in letters]
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in self.ids.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        self.pattern = regex.compile(PATTERN)
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words = Encoder(list, lambda words: [self.word(w) for w in words], 200_000)
        self.texts = Encoder(pieces_of, self._pieces, 300_000)

    def word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        symbols = [self.byte_ids[b] for b in word.encode()]
        n, merges = len(symbols), self.merges
        if n > 1:
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            queue = [(*merges[pair], i, *pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in merges]
            queue = [(rank, i, left, right, new) for rank, new, i, left, right in queue]
            heapq.heapify(queue)
            while queue:
                _, i, left, right, new = heapq.heappop(queue)
                j = after[i]
                if symbols[i] != left or j >= n or symbols[j] != right:
                    continue  # stale: one of the two has been merged since
                symbols[i], symbols[j] = new, -1
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    if found := merges.get((new, symbols[k])):
                        heapq.heappush(queue, (found[0], i, new, symbols[k], found[1]))
                if (h := before[i]) >= 0 and (found := merges.get((symbols[h], new))):
                    heapq.heappush(queue, (found[0], h, symbols[h], new, found[1]))
            symbols = [s for s in symbols if s >= 0]
        return words_as_bytes(symbols)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        runs = [self.at_added.split(piece) if self.at_added and "<" in piece else [piece] for piece in pieces]
        plain = iter(self.words.encode([self.pattern.findall(run) for own in runs for run in own if run and run not in self.added]))
        ids = lambda run: words_as_bytes([self.added[run]]) if run in self.added else next(plain) if run else b""
        return [b"".join(map(ids, own)) for own in runs]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        return self.texts.encode(texts)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, as in the public libraries."""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<long>) of each text; null texts are encoded as empty. The general interface."""
    path = path or default_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = [np.frombuffer(x, "<u4").astype("i8") for x in codec(path).encode([t or "" for t in part["text"].to_pylist()])]
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "ids": pa.array(ids, pa.list_(pa.int64()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<long>")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; null text as empty, repeated rows each for itself.

    Only doc_id and text are read; an empty table gives an empty result; one document's ids are
    held at a time besides a short run of texts.
    """
    path = path or default_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for part in slices(batch):
                ids = codec(path).encode([t or "" for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"],
                        "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids_sha256": [sha(x) for x in ids],
                        "decoded_sha256": [sha(codec(path).decode(x).encode()) for x in ids],
                    }
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
