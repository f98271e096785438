"""Token-id files: Simple-8b words in blocks, with a footer that gives each block's place.

A 64-bit word holds a 4-bit selector (top bits) and as many ids as the selector says, packed from
the low bits up. Ids that no selector holds (2**60 and more) are escapes: a zero stands in the word,
and the block lists their positions and values. File: magic, blocks, the ids' count per document,
block table, then the lengths of both tables. Decoding is vectorised over a block's words.

Files are written by tasks in ascending doc_id order over range partitions and closed at a bound; a
written manifest lists the files of successful tasks only, and each file is read by a task of its own.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragstone.llm.common import filesystem, fresh_path, slices, written
from ragstone.llm.tokens import default_path, encoder

#: Ids per word and bits per id of the Simple-8b selectors 0 to 15.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8BIDS01"
#: Ids in a block; a block is decoded by itself.
BLOCK_IDS = 2048
#: Ids whose selectors are found at once: whole blocks, few enough for a processor's cache.
NEAR_IDS = 16 * BLOCK_IDS
#: Ids that a writing task gathers before it encodes them.
GATHER_IDS = 1 << 21
#: Blocks that a reader decodes at once.
READ_BLOCKS = 32
#: A file is closed beyond this many ids.
FILE_IDS = 1 << 26
#: Bytes of text that a writing task gets, about.
TASK_BYTES = 128 << 20
END_ID = 2
MANIFEST = "part int, file int, path string, first_doc long, n_docs long, n_ids long"
ROWS = "path string, doc int, doc_id long, n_tokens long, ids_crc32 long"


def _selectors(plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the selector that packs most ids from there on within its block, and their count."""
    n = len(plain)
    place = np.arange(n, dtype=np.int32)
    left = np.minimum(BLOCK_IDS - place % BLOCK_IDS, n - place)  # ids to the block's end
    selector, count = np.full(n, 15, np.uint8), np.ones(n, np.int32)
    for s in range(14, -1, -1):  # from few ids a word to many: the last that fits stays
        stop = np.where(plain >= np.uint64(1 << int(BITS[s])), place, np.int32(n))
        run = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] - place, left)
        whole = run >= COUNTS[s]
        if whole.any():
            selector[whole], count[whole] = s, COUNTS[s]
        elif s < 12:
            break  # narrower selectors need longer runs of smaller ids
    return selector, count


def encode_blocks(ids: np.ndarray) -> list[tuple[bytes, int, int, int]]:
    """Blocks of ``ids`` (uint64): bytes, ids, words and escapes of each."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if n == 0:
        return []
    escaped = ids >= np.uint64(1 << 60)
    plain = np.where(escaped, np.uint64(0), ids)
    selector, count = np.empty(n, np.uint8), np.empty(n, np.int32)
    for lo in range(0, n, NEAR_IDS):
        selector[lo : lo + NEAR_IDS], count[lo : lo + NEAR_IDS] = _selectors(plain[lo : lo + NEAR_IDS])
    # All blocks are walked side by side, a word in each per step.
    at, words = np.arange(0, n, BLOCK_IDS), []
    ends = np.minimum(at + BLOCK_IDS, n)
    while len(at):
        words.append(at)
        at = at + count[at]
        live = at < ends
        at, ends = at[live], ends[live]
    starts = np.sort(np.concatenate(words))
    sel = selector[starts]
    packed = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        if BITS[s]:
            mine = np.flatnonzero(sel == s)
            for k in range(COUNTS[s]):
                packed[mine] |= plain[starts[mine] + k] << np.uint64(k * int(BITS[s]))
    bounds = np.searchsorted(starts, np.arange(0, n + BLOCK_IDS, BLOCK_IDS))
    out = []
    for b, first in enumerate(range(0, n, BLOCK_IDS)):
        last, own = min(first + BLOCK_IDS, n), packed[bounds[b] : bounds[b + 1]]
        odd = np.flatnonzero(escaped[first:last])
        data = own.astype("<u8").tobytes() + odd.astype("<u4").tobytes() + ids[first:last][odd].astype("<u8").tobytes()
        out.append((data, last - first, len(own), len(odd)))
    return out


def decode_block(data: bytes, n_words: int, n_escapes: int) -> np.ndarray:
    """The ids (uint64) of one block."""
    words = np.frombuffer(data, "<u8", n_words)
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[sel]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(sel):
        if bits := int(BITS[s]):
            mine, mask = np.flatnonzero(sel == s), np.uint64((1 << bits) - 1)
            for k in range(COUNTS[s]):
                out[start[mine] + k] = (words[mine] >> np.uint64(k * bits)) & mask
    if n_escapes:
        at = n_words * 8
        out[np.frombuffer(data, "<u4", n_escapes, at)] = np.frombuffer(data, "<u8", n_escapes, at + 4 * n_escapes)
    return out


class IdFile:
    """A file of ids being written: ``add`` documents, then ``close``."""

    def __init__(self, out):
        self.out, self.place = out, out.write(MAGIC) or len(MAGIC)
        self.docs: list[tuple[int, int]] = []
        self.blocks: list[tuple[int, int, int, int]] = []
        self.held: list[bytes] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit."""
        self.docs.append((-(1 << 63) if doc_id is None else doc_id, len(ids) // 4))
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= GATHER_IDS:
            self._flush(self.n_held // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        held = np.frombuffer(b"".join(self.held), "<u4")
        for data, ids, words, escapes in encode_blocks(held[:n]):
            self.out.write(data)
            self.blocks.append((self.place, ids, words, escapes))
            self.place += len(data)
        self.held, self.n_held = [held[n:].tobytes()], len(held) - n

    def close(self) -> None:
        self._flush(self.n_held)
        self.out.write(np.array(self.docs, "<i8").reshape(-1, 2).tobytes())
        self.out.write(np.array(self.blocks, "<i8").reshape(-1, 4).tobytes())
        self.out.write(np.array([len(self.docs), len(self.blocks)], "<i8").tobytes())
        self.out.close()


def read_file(file) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids (uint32) of each document of an open file, in order; a few blocks are decoded at a time."""
    size = file.size()
    n_docs, n_blocks = np.frombuffer(file.read_at(16, size - 16), "<i8").tolist()
    foot = size - 16 - 16 * n_docs - 32 * n_blocks
    docs = np.frombuffer(file.read_at(16 * n_docs, foot), "<i8").reshape(-1, 2)
    blocks = np.frombuffer(file.read_at(32 * n_blocks, foot + 16 * n_docs), "<i8").reshape(-1, 4).tolist()
    ready, next_block = np.zeros(0, np.uint32), 0
    for doc_id, n in docs.tolist():
        parts, have = [ready], len(ready)
        while have < n:
            # Blocks without escapes stand word to word: a run of them is decoded in one sweep.
            run = next_block + 1
            while run < len(blocks) and run - next_block < READ_BLOCKS and not blocks[run - 1][3] and not blocks[run][3]:
                run += 1
            words, escapes = sum(b[2] for b in blocks[next_block:run]), blocks[next_block][3]
            parts.append(decode_block(file.read_at(8 * words + 12 * escapes, blocks[next_block][0]), words, escapes).astype(np.uint32))
            have, next_block = have + len(parts[-1]), run
        ready = np.concatenate(parts) if len(parts) > 1 else ready
        yield (None if doc_id == -(1 << 63) else doc_id), ready[:n]
        ready = ready[n:]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every text and write the ids (with the end id) in ascending doc_id order; returns the manifest.

    Manifest: part and file (their order is the order of ids), path, first_doc (documents before the
    file in its part), n_docs, n_ids. The order among rows with one doc_id is that of their texts'
    hashes; a null doc_id comes first.
    """
    from pyspark import TaskContext

    folder = folder or fresh_path(docs.sparkSession, "token-ids")
    schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    tail = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        out, name, n_ids, file, n_before = None, "", 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            row = {"part": TaskContext.get().partitionId(), "file": file, "path": f"{folder}/{name}", "first_doc": n_before, "n_docs": len(out.docs), "n_ids": n_ids}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for part in slices(batch):
                ids = encoder(tokenizer).encode([t or "" for t in part["text"].to_pylist()])
                for doc_id, got in zip(part["doc_id"].to_pylist(), ids, strict=True):
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        name, n_ids = f"{uuid.uuid4().hex}.s8b", 0
                        out = IdFile(fs.open_output_stream(f"{root}/{name}"))
                    out.add(doc_id, got + tail)
                    n_ids += len(got) // 4 + 1
                    if n_ids >= file_ids:
                        yield closed()
                        file, n_before, out = file + 1, n_before + len(out.docs), None
        if out is not None:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + n_bytes // TASK_BYTES)
    ordered = rows.repartitionByRange(n_parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return written(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files, as read back."""
    schema = pa.schema([("path", pa.string()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = filesystem(row["path"])
                rows, start = [], row["start"]
                with fs.open_input_file(path) as file:
                    for k, (doc_id, ids) in enumerate(read_file(file)):
                        rows.append({"path": row["path"], "doc": k, "doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                        start += len(ids)
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    # One manifest row per file: a running sum over as many rows as there are tasks.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.select("path", before.alias("start"))
    # A task for each file: numbered, or adaptive execution would join the few small rows in one.
    starts = starts.repartitionByRange(max(1, manifest.count()), "start")
    return starts.mapInArrow(read, "path string, doc int, doc_id long, start long, n_tokens long, ids_crc32 long").select("doc_id", "start", "n_tokens", "ids_crc32")


def token_file_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32.

    Null or empty text: the end id alone. Repeated rows and ids are written each for itself. An empty
    table writes no file and gives an empty result. Only doc_id and text are read.
    """
    return read_token_files(write_token_files(docs, tokenizer or default_path("word_bpe_49k.json")))
