"""Harmonic packing of token ids into sequences of fixed capacity.

Lengths fall into classes by reciprocal capacity: class k holds lengths in (capacity / (k + 1),
capacity / k], and a sequence of class k takes exactly k pieces. Tasks fill the sequences of each
class by themselves, so no rows are shuffled. A document is cut so that pieces fill their class:
whole sequences first, then from what is left pieces of exactly capacity // k, the longest that
fits, until a short tail remains. What a task still has open at its end goes into common sequences,
longest first into the first that holds it.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import slices
from ragstone.llm.tokens import default_path, encoder

CAPACITY = 1024
END_ID = 0
#: Tails up to this length are not cut further.
SHORT = 64
_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(n: int, capacity: int = CAPACITY, short: int = SHORT) -> list[int]:
    """The lengths of the pieces that a document of ``n`` ids is cut into."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left > short:
        out.append(capacity // -(-capacity // left))
        left -= out[-1]
    return [*out, left] if left else out


class HarmonicPacker:
    """Places pieces: ``place`` for each, then ``finish``; both give (piece, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.open, self.sequences = capacity, {}, 0

    def place(self, piece, length: int) -> list[tuple]:
        k = self.capacity // length
        if k == 1:
            self.sequences += 1
            return [(piece, self.sequences - 1, 0)]
        held = self.open.setdefault(k, [])
        held.append((length, piece))
        if len(held) < k:
            return []
        del self.open[k]
        return self._sequence(held)

    def _sequence(self, held: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for length, piece in held:
            out.append((piece, self.sequences, offset))
            offset += length
        self.sequences += 1
        return out

    def finish(self) -> list[tuple]:
        """At most k - 1 pieces of each class k are left: first fit, longest first."""
        left = sorted((x for held in self.open.values() for x in held), key=lambda x: -x[0])
        room: list[tuple[int, int]] = []  # (room left, bin), ascending
        bins: list[list] = []
        for item in left:
            at = bisect.bisect_left(room, (item[0], -1))
            free, b = room.pop(at) if at < len(room) else (self.capacity, len(bins))
            if b == len(bins):
                bins.append([])
            bins[b].append(item)
            bisect.insort(room, (free - item[0], b))
        self.open = {}
        return [x for held in bins for x in self._sequence(held)]


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece (and ids, if asked for).

    Null or empty text: the end id alone. Repeated rows are packed each for itself; an empty table
    gives an empty result. sequence_id is unique over all tasks: the task's number times 2**32 plus
    its own count. Sequences stand unpadded here; ``padding`` gives what they need. Only doc_id and
    text are read. A task holds a short run of texts and, per class, fewer pieces than fill a sequence.
    """
    from pyspark import TaskContext

    tokenizer = tokenizer or default_path("byte_bpe_50k.json")
    schema = pa.schema(_PIECE + [("ids", pa.binary())] * with_ids)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, packer = TaskContext.get().partitionId() << 32, HarmonicPacker(capacity)

        def out(placed: list[tuple]) -> pa.RecordBatch:
            columns = zip(*[(*piece[:5], first + sequence, offset, *piece[5:]) for piece, sequence, offset in placed], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for part in slices(batch):
                placed = []
                for doc_id, ids in zip(part["doc_id"].to_pylist(), encoder(tokenizer).encode([t or "" for t in part["text"].to_pylist()]), strict=True):
                    ids, start = ids + tail, 0
                    for length in cuts(len(ids) // 4, capacity):
                        own = ids[4 * start : 4 * (start + length)]
                        placed += packer.place((doc_id, start, length, zlib.crc32(own), len(ids) // 4, *([own] if with_ids else [])), length)
                        start += length
                if placed:
                    yield out(placed)
        if placed := packer.finish():
            yield out(placed)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def padding(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, used, padding: sequences are padded to the capacity, except those at a power of two."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    exact = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padding", F.when(exact, F.lit(0)).otherwise(F.lit(capacity) - F.col("used")))


def write_sequences(docs: DataFrame, path: str, **how) -> None:
    """Write the packed sequences with their ids as Parquet: sequence_id, ids (binary, in offset order)."""
    pieces = packed(docs, with_ids=True, **how)
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    whole.select("sequence_id", joined.alias("ids")).write.parquet(path)
