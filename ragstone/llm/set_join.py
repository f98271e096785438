"""Jaccard join of documents on sets of word n-grams, by set relations.

Documents with equal sets are one set from the start. Sets link at a Jaccard similarity of 0.8 or
more; components over links come out, never all pairs of a group.

Index lists: each set is listed under its prefix, the first ``n - ceil(0.8 n) + 1`` of its n-grams in
one global order; two linked sets meet in some list. The order puts n-grams found in many sets last
(a bounded set of them is known everywhere), the rest by hash. A list is ordered by set size and
skipped through in blocks: a block's first set is its pivot, and the block ends where the pivot's
position in the list's order leaves too few n-grams for a link. Sets whose own position leaves too few
are passed over.

Answers by relation: every set is first compared with the pivots that it meets most often. A set linked
to a pivot p belongs to p's star, at the known distance ``|a ^ p|``; a star falls into shells of like
distance. Other pairs only count if they meet in a list and are not yet in one component. They are
answered shell by shell: ``|a ^ b| >= |p ^ q| - |a ^ p| - |b ^ q|``, with ``|p ^ q|`` from below by the
pivots' bitmaps, in which equal n-grams cancel; only shells that the bound leaves open are looked into,
set by set with their own bitmaps, and only what that leaves open is compared. Each round compares the
closest few partners of a set and merges components; rounds go on, with more partners each, until
nothing was put off. The result equals that of comparing all pairs.

Plan: n-grams are 64-bit hashes in packed arrays, dealt out by hash; lists of frequent n-grams are
dealt out by set as well, the more so the more frequent, and long lists of stars and large shells in
pairs of blocks, so no list needs one task. Only texts of compared sets travel, a pivot's once per
block of sets compared with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragstone.llm.common import lookup_join, slices, written
from ragstone.llm.components import components

WORDS = 5
#: An n-gram found in this many sets or more is frequent; at most MOST_FREQUENT are known (12 MB).
FREQUENT = 16
MOST_FREQUENT = 1 << 20
#: Only n-grams whose hash lies below this share of all are counted: prefixes are the lowest fifth or so.
COUNTED = 0.5
#: Sets of a frequent n-gram that are listed in one task.
SPREAD = 1024
#: Bits of a set's bitmap: a power of two of at least 1.5 times its n-grams, within these bounds.
LEAST_BITS, MOST_BITS = 512, 16384
#: Pivots that a set is compared with at first.
PIVOTS = 2
#: A star's shells: greatest distance from the pivot in thousandths of the set's size.
SHELLS = (0, 20, 60, 120)
#: Partners of a set that the first round compares, and how many times more each further round.
PARTNERS, MORE_PARTNERS = 8, 8
#: Sets, or shells, that a task holds against as many others.
BLOCK = 1024
#: Guests that meet a block of a shell's sets in one task, in blocks.
GUESTS = 16
#: n-grams or list entries that a task gathers before it deals them out.
GATHER = 1 << 18
#: Pairs whose bitmaps are compared at once.
PAIRS = 1 << 16
#: n-grams of all sets for each task that lists them.
SLOT_GRAMS = 2_000_000
#: Sets whose equal a task passes over when it meets them again.
MOST_SEEN = 100_000
#: Rows of one column up to which a table of ids is broadcast.
ID_ROWS = 500_000
ENTRY = np.dtype([("t", "<u8"), ("a", "<u8"), ("b", "<u4"), ("n", "<u4"), ("i", "<u4")])

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes whose hashes are summed up at once.
_RUN = 1 << 16
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
#: A random number per byte; A-Z have those of a-z.
_VALUES = np.random.default_rng(7).integers(1, 1 << 64, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base, and those of its inverse modulo 2**64."""
    up, down = np.full(size, _STEP), np.full(size, _BACK)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift in (31, 29):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word (A-Z as a-z) of the texts that stand end to end in ``data``, and how many words lie before each offset.

    A word's hash is a polynomial in its bytes, taken from running sums over all bytes.
    """
    n = len(data)
    word = np.zeros(n + 2, bool)
    word[1:-1] = _IS_WORD[data]
    own = word[1:-1]
    first, last = own & ~word[:-2], own & ~word[2:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner], last[inner - 1] = own[inner], own[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _RUN, "right")))
        size = int(ends[j - 1]) - low
        up, down = _powers(max(_RUN, 1 << (size - 1).bit_length()))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUES[data[low : low + size]] * up[:size], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _LENGTH
        i = j
    return _mixed(out), np.searchsorted(starts, offsets)


def shingles_of(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The distinct n-grams of each text as ascending 64-bit hashes; a shorter text is one n-gram, none without words."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    h, bounds = word_hashes(data, offsets - offsets[0])
    whole = np.full(max(len(h) - size + 1, 0), size, np.uint64)
    for k in range(size):
        whole = whole * _STEP + h[k : k + len(whole)]
    whole, out = _mixed(whole), []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= size:
            grams = np.sort(whole[start : end - size + 1])
            new = np.ones(len(grams), bool)
            np.not_equal(grams[1:], grams[:-1], out=new[1:])
            out.append(grams if new.all() else grams[new])
        elif end > start:
            gram = np.array([end - start], np.uint64)
            for k in range(start, end):
                gram = gram * _STEP + h[k : k + 1]
            out.append(_mixed(gram))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bitmap(grams: np.ndarray) -> bytes:
    """Each n-gram flips one bit, so equal n-grams of two sets cancel."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (3 * len(grams) // 2).bit_length()))
    flips = np.bincount(((grams >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


class Bitmaps:
    """Bitmaps side by side; wider ones are folded onto the width of the other of a pair."""

    def __init__(self, bits: list[bytes]):
        self.width = np.array([len(b) for b in bits], np.int64)
        self.rows: dict[int, np.ndarray] = {}
        self.place = np.zeros(len(bits), np.int64)
        narrow = None
        for w in sorted(set(self.width.tolist()), reverse=True):
            mine = np.flatnonzero(self.width == w)
            own = np.frombuffer(b"".join(bits[i] for i in mine), np.uint64).reshape(len(mine), w // 8)
            if narrow is not None:  # the wider ones, folded, stand first
                while narrow.shape[1] > w // 8:
                    half = narrow.shape[1] // 2
                    narrow = narrow[:, :half] ^ narrow[:, half:]
            before = 0 if narrow is None else len(narrow)
            self.place[mine] = before + np.arange(len(mine))
            narrow = own if narrow is None else np.concatenate([narrow, own])
            self.rows[w] = narrow

    def differ(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """At least by so many n-grams the sets ``a`` and ``b`` (places) differ, and about by so many."""
        low, about = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        width = np.minimum(self.width[a], self.width[b])
        for w, rows in self.rows.items():
            mine = np.flatnonzero(width == w)
            for at in range(0, len(mine), PAIRS * 64 // w + 1):
                part = mine[at : at + PAIRS * 64 // w + 1]
                x = np.bitwise_count(rows[self.place[a[part]]] ^ rows[self.place[b[part]]]).sum(1, dtype=np.int64)
                low[part] = x
                about[part] = -4 * w * np.log(np.maximum(1 - x / (4 * w), 1e-9))
        return low, about


def set_id(grams: np.ndarray) -> bytes:
    """12 bytes that stand for a set."""
    return hashlib.blake2b(grams.tobytes(), digest_size=12).digest()


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1 if n else 0


def linked(overlap, n_a, n_b):
    """Jaccard of at least 0.8, in whole numbers; works for numbers and columns. The sets then differ by (n_a + n_b) / 9 at most."""
    return 9 * overlap >= 4 * (n_a + n_b)


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, np.ndarray]]:
    """The sets of a task's texts; equal ones once, as far as they are remembered."""
    seen = set()
    for batch in batches:
        for part in slices(batch):
            for grams in shingles_of(part["text"]):
                if len(grams) and (sid := set_id(grams)) not in seen:
                    if len(seen) < MOST_SEEN:
                        seen.add(sid)
                    yield sid, grams


def text_id() -> Column:
    """16 bytes that stand for the column text as it is."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n_shingles, sid (null for the empty set) and bits (its bitmap) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingles_of(part["text"])
                ids, bits = [set_id(s) if len(s) else None for s in sets], [bitmap(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "text_id": part["text_id"], "n_shingles": pa.array(map(len, sets), pa.int64()), "sid": pa.array(ids, pa.binary()), "bits": pa.array(bits, pa.binary())})

    return docs.select("doc_id", "text", text_id().alias("text_id")).mapInArrow(run, "doc_id long, text_id binary, n_shingles long, sid binary, bits binary")


def _dealt(slot: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Packed rows by slot."""
    order = np.argsort(slot, kind="stable")
    slot, rows = slot[order], rows[order]
    first = np.flatnonzero(np.diff(slot, prepend=-1))
    return pa.RecordBatch.from_pydict({"slot": pa.array(slot[first], pa.int32()), "data": [x.tobytes() for x in np.split(rows, first[1:])]})


def _packed(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of packed rows end to end, copied once."""
    out = [np.zeros(0, np.uint8)]
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary())
        _, offsets, data = chunk.buffers()
        at = np.frombuffer(offsets, np.int64, len(chunk) + 1, chunk.offset * 8)
        out.append(np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else out[0])
    return np.concatenate(out)


def frequent_grams(docs: DataFrame, n_slots: int, least: int = FREQUENT, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams found in ``least`` sets or more, the most frequent ``most`` at most, ascending; and over how many tasks each one's list is spread."""
    top = np.uint64(int(COUNTED * 2**64))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            grams = np.concatenate(held)
            return _dealt((grams % np.uint64(n_slots)).astype(np.int32), grams)

        for _, grams in _new_sets(batches):
            held.append(grams[: np.searchsorted(grams, top)])
            n += len(held[-1])
            if n >= GATHER:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def count(table: pa.Table) -> pa.Table:
        grams = np.sort(_packed(table["data"]).view("<u8"))
        first = np.flatnonzero(np.diff(grams, prepend=grams[:1] ^ np.uint64(1)))
        n = np.diff(first, append=len(grams))
        often = n >= least
        return pa.table({"gram": grams[first[often]].view(np.int64), "n": n[often].astype(np.int64)})

    counts = written(docs.mapInArrow(gather, "slot int, data binary").groupBy("slot").applyInArrow(count, "gram long, n long"), "join-frequent")
    if counts.count() > most:
        counts = counts.orderBy(F.desc("n"), "gram").limit(most)
    rows = counts.select("gram", F.ceil(F.col("n") / SPREAD).cast("int").alias("spread")).toPandas()  # at most ``most`` rows
    grams, spread = rows["gram"].to_numpy(np.int64).view(np.uint64), rows["spread"].to_numpy(np.int32)
    order = np.argsort(grams)
    return grams[order], spread[order]


def _ids(a: np.ndarray, b: np.ndarray) -> pa.Array:
    packed = np.rec.fromarrays([a, b], dtype=[("a", "<u8"), ("b", "<u4")]).tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(a), [None, pa.py_buffer(packed)]).cast(pa.binary())


def index_lists(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], n_slots: int) -> DataFrame:
    """token, sid, n, place, pivot, pivot_n: the entries of lists with two sets or more.

    place is the n-gram's position in the set's own order. pivot is null where the entry's position rules a link with its block's pivot out.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (often, spread), held, n = known.value, [], 0

        def at(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(often):
                return np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
            place = np.minimum(np.searchsorted(often, grams), len(often) - 1)
            return place, often[place] == grams

        def out() -> pa.RecordBatch:
            rows = np.concatenate(held)
            place, late = at(rows["t"])
            share = np.where(late, rows["a"] % (spread[place] if len(often) else np.ones(1, np.int32)).astype(np.uint64), np.uint64(0))
            return _dealt((_mixed(rows["t"] ^ (share * _STEP)) % np.uint64(n_slots)).astype(np.int32), rows)

        for sid, grams in _new_sets(batches):
            late = at(grams)[1]
            own = np.concatenate([grams[~late], grams[late]])[: prefix_length(len(grams))]
            rows = np.empty(len(own), ENTRY)
            rows["t"], rows["n"], rows["i"] = own, len(grams), np.arange(len(own))
            rows["a"], rows["b"] = int.from_bytes(sid[:8], "little"), int.from_bytes(sid[8:], "little")
            held.append(rows)
            n += len(rows)
            if n >= GATHER:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def listed(table: pa.Table) -> pa.Table:
        often, spread = known.value
        rows = _packed(table["data"]).view(ENTRY)
        t = np.sort(rows["t"])  # most lists have one set: they go first
        alone = np.ones(len(t), bool)
        same = t[1:] == t[:-1]
        alone[1:][same] = alone[:-1][same] = False
        keep = ~alone[np.searchsorted(t, rows["t"])]
        if len(often):  # a spread list may have its other sets elsewhere
            place = np.minimum(np.searchsorted(often, rows["t"]), len(often) - 1)
            keep |= (often[place] == rows["t"]) & (spread[place] > 1)
        rows = rows[keep]
        rows = rows[np.lexsort((rows["b"], rows["a"], rows["n"], rows["t"]))]
        new = np.ones(len(rows), bool)
        new[1:] = rows[1:] != rows[:-1]
        rows = rows[new]  # equal sets of different tasks
        n, i = rows["n"].astype(np.int64), rows["i"].astype(np.int64)
        # Lists are walked side by side, a block of each at a time; a pivot reaches sets of up to (5 n - 9 i) / 4 n-grams.
        pivot, todo = np.arange(len(rows)), np.flatnonzero(np.diff(rows["t"], prepend=rows["t"][:1] ^ np.uint64(1)))
        ends = np.append(todo[1:], len(rows))
        while len(todo):
            reach = np.maximum((5 * n[todo] - 9 * i[todo]) // 4, n[todo])
            nxt = np.array([p + np.searchsorted(n[p:e], r, "right") for p, e, r in zip(todo.tolist(), ends.tolist(), reach.tolist(), strict=True)], np.int64)
            size = nxt - todo
            pivot[np.repeat(todo - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.repeat(todo, size)
            more = nxt < ends
            todo, ends = nxt[more], ends[more]
        met = (9 * i <= 5 * n - 4 * n[pivot]) & (9 * i[pivot] <= 5 * n[pivot] - 4 * n) & (pivot != np.arange(len(rows)))
        pivots = pa.array(np.where(met, pivot, 0), pa.int64(), mask=~met)
        ids = _ids(rows["a"], rows["b"])
        return pa.table({"token": rows["t"].view(np.int64), "sid": ids, "n": n, "place": i, "pivot": ids.take(pivots), "pivot_n": pa.array(n).take(pivots)})

    dealt = docs.mapInArrow(gather, "slot int, data binary")
    return dealt.groupBy("slot").applyInArrow(listed, "token long, sid binary, n long, place long, pivot binary, pivot_n long")


def compared(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, n_a, b, n_b, each pair once) with the overlap of the two sets.

    Only the texts of one document per set travel: the one with the least doc_id. Rows without a
    doc_id are all looked through if a set has no other. The text of a ``b`` with many partners is
    sent once for each block of them.
    """
    pairs = written(pairs, "join-pairs")
    used = written(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), "join-used")
    of_set = sets.join(used, "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    wanted = written(of_set.select("doc_id").distinct(), "join-wanted")
    few = wanted.count() <= ID_ROWS
    rows = docs.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    if not wanted.filter("doc_id is null").isEmpty():
        rows = rows.union(docs.filter("doc_id is null").select(*rows.columns))

    def with_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = [set_id(s) if len(s) else None for s in shingles_of(part["text"])]
                yield pa.RecordBatch.from_pydict({"sid": pa.array(ids, pa.binary()), "text": part["text"]})

    texts = rows.mapInArrow(with_id, "sid binary, text string").join(used, "sid", "left_semi")
    # Copies share a set; a repeated id may bring several texts of one set: any of them will do.
    texts = written(texts, "join-texts").dropDuplicates(["sid"])
    many = written(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("blocks > 1"), "join-blocks")
    block = F.coalesce(F.pmod(F.xxhash64("a"), F.col("blocks")), F.lit(0)).cast("int").alias("block")
    dealt = written(lookup_join(pairs, many, ["b"], salt=F.xxhash64("a")).select("a", "n_a", "b", "n_b", block), "join-dealt")
    members = dealt.join(texts, dealt["a"] == texts["sid"]).select("b", "block", "a", "n_a", "n_b", "text")
    pivots = dealt.select("b", "block").distinct().join(texts.withColumnRenamed("sid", "b"), "b").select("b", "block", F.lit(None).cast("binary").alias("a"), F.lit(0).cast("long").alias("n_a"), F.lit(0).cast("long").alias("n_b"), "text")

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for part in slices(batch):
                n = []
                for a, grams in zip(part["a"].to_pylist(), shingles_of(part["text"]), strict=True):
                    if a is None:
                        last = grams
                    n.append(0 if a is None else len(np.intersect1d(grams, last, assume_unique=True)))
                whole = pa.RecordBatch.from_arrays([*[part[c] for c in ("a", "n_a", "b", "n_b")], pa.array(n, pa.int64())], names=["a", "n_a", "b", "n_b", "overlap"])
                yield whole.filter(part["a"].is_valid())

    both = members.unionByName(pivots).repartition("b", "block").sortWithinPartitions("b", "block", F.col("a").asc_nulls_first())
    return written(both.mapInArrow(overlaps, "a binary, n_a long, b binary, n_b long, overlap long"), "join-overlaps")


def _by_bitmap(pairs: DataFrame) -> DataFrame:
    """a, n_a, b, n_b, times of those ``pairs`` whose bitmaps (bits_a, bits_b) allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(batch.num_rows)
            low, _ = Bitmaps(batch["bits_a"].to_pylist() + batch["bits_b"].to_pylist()).differ(at, at + batch.num_rows)
            fine = 9 * low <= batch["n_a"].to_numpy() + batch["n_b"].to_numpy()
            yield batch.drop_columns(["bits_a", "bits_b"]).filter(pa.array(fine))

    return pairs.select("a", "n_a", "b", "n_b", "times", "bits_a", "bits_b").mapInArrow(run, "a binary, n_a long, b binary, n_b long, times long")


def _closest(a: np.ndarray, b: np.ndarray, about: np.ndarray, most: int) -> np.ndarray:
    """Which of the pairs are among the ``most`` closest of either of their two."""
    keep = np.zeros(len(a), bool)
    for side in (a, b):
        order = np.lexsort((about, side))
        own = side[order]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        rank = np.arange(len(own)) - np.repeat(first, np.diff(first, append=len(own)))
        keep[order[rank < most]] = True
    return keep


class _Closest:
    """Pairs (numbers) with their estimated distance: the closest of each, and how many were put off."""

    def __init__(self, most: int):
        self.most, self.dropped = most, 0
        self.pairs = np.zeros((0, 3), np.int64)

    def add(self, a: np.ndarray, b: np.ndarray, about: np.ndarray) -> None:
        self.pairs = np.concatenate([self.pairs, np.stack([a, b, about], 1)])
        if len(self.pairs) > 1 << 20:
            self.cut()

    def cut(self) -> np.ndarray:
        order = np.lexsort((self.pairs[:, 2], self.pairs[:, 1], self.pairs[:, 0]))
        pairs = self.pairs[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:, :2] != pairs[:-1, :2]).any(1)
        pairs = pairs[new]
        keep = _closest(*pairs.T, self.most)
        self.dropped += int((~keep).sum())
        self.pairs = pairs[keep]
        return self.pairs


def _runs(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of each place with the ``counts`` places after it, some PAIRS at a time."""
    total, at = np.cumsum(counts), 0
    while at < len(counts):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        own = counts[at:end]
        a = np.repeat(np.arange(at, end), own)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own)
        at = end


def _coded(column: pa.ChunkedArray) -> tuple[list[bytes], np.ndarray, pa.Array]:
    """A column's distinct values, each row's place in them, and a row that has each of them."""
    coded = column.combine_chunks().dictionary_encode()
    place = coded.indices.to_numpy().astype(np.int64)
    row = np.zeros(len(coded.dictionary), np.int64)
    row[place] = np.arange(len(place))
    return coded.dictionary.to_pylist(), place, pa.array(row)


def _blocks(members: Column) -> Column:
    return F.ceil(members / BLOCK).cast("int")


def _open_shells(lists: DataFrame, most: int, n_slots: int) -> DataFrame:
    """p, q, put_off: shells that meet in a list and that their pivots' bitmaps leave open.

    ``lists`` has a row per token and shell with the token's number of shells (size). A row without
    p counts the pairs put off because both have ``most`` closer ones.
    """
    rows = lists.withColumn("block", F.pmod(F.xxhash64("unit"), _blocks(F.col("size"))).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), _blocks(F.col("size")) - 1)))
    rows = rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("token", "x", "y"), F.lit(n_slots)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        units, unit, row = _coded(table["unit"])
        _, part, _ = _coded(table["part"])
        maps = Bitmaps(table["bits"].take(row).to_pylist())
        columns = [table[name].to_numpy().astype(np.int64) for name in ("token", "x", "y", "block", "least", "most", "off", "place")]
        order = np.lexsort((columns[4], columns[2], columns[1], columns[0]))
        token, x, y, block, least, largest, off, place, unit, part = (c[order] for c in (*columns, unit, part))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        # Shells within reach of a shell's size follow it in its list; the rest is skipped.
        group, scale = np.cumsum(new), np.int64(2) * (largest.max() + 1)
        reach = np.searchsorted(group * scale + least, group * scale + 5 * largest // 4, "right")
        found = _Closest(most)
        for a, b in _runs(reach - np.arange(len(token)) - 1):
            fine = (part[a] != part[b]) & ((x[a] == y[a]) | (block[a] != block[b]))
            # Linked sets first meet where both have enough n-grams left: other lists of theirs are passed over.
            fine &= (9 * place[a] <= 5 * largest[a] - 4 * least[b]) & (9 * place[b] <= 5 * largest[b] - 4 * least[a])
            a, b = a[fine], b[fine]
            low, about = maps.differ(unit[a], unit[b])
            total = largest[a] + largest[b]
            open_ = 9 * (low - off[a] - off[b]) <= total
            u, v = unit[a][open_], unit[b][open_]
            found.add(np.minimum(u, v), np.maximum(u, v), 1000 * about[open_] // total[open_])
        pairs = found.cut()
        names = lambda k: pa.array([*[units[i] for i in pairs[:, k].tolist()], None], pa.binary())
        return pa.table({"p": names(0), "q": names(1), "put_off": [*[0] * len(pairs), found.dropped]})

    rows = rows.select("slot", "token", "x", "y", "block", "unit", "part", "least", "most", "off", "place", "bits")
    return rows.groupBy("slot").applyInArrow(run, "p binary, q binary, put_off long")


def _open_pairs(shells: DataFrame, units: DataFrame, info: DataFrame, most: int, n_slots: int) -> DataFrame:
    """a, n_a, b, n_b (a < b), put_off: sets of the pairs p, q of shells whose own bitmaps leave a link open.

    The larger shell of a pair is the host: its sets are sent once, in blocks, and the sets of all its
    guests to each block. A row without a counts what was put off.
    """
    of = lambda s: units.select(F.col("unit").alias(s), F.col("members").alias(f"members_{s}"))
    pairs = shells.select("p", "q").distinct().join(of("p"), "p").join(of("q"), "q")
    first = F.struct("members_p", "p") >= F.struct("members_q", "q")
    pick = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    pairs = written(pairs.select(pick("p", "q", "host"), pick("q", "p", "guest"), pick("members_p", "members_q", "members"), pick("members_q", "members_p", "guests")), "join-shells")
    hosts = pairs.groupBy("host").agg(_blocks(F.first("members")).alias("blocks"), _blocks(F.sum("guests") / GUESTS).alias("guest_blocks"))
    hosts, block = written(hosts, "join-hosts"), lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = info.select("unit", "sid", "n", "bits")
    own = hosts.join(held, hosts["host"] == held["unit"]).withColumn("at", block("blocks")).withColumn("guest_at", each("guest_blocks")).withColumn("left", F.lit(False))
    guests = lookup_join(pairs.select("host", "guest"), hosts, ["host"], how="inner", salt=F.xxhash64("guest"))
    guests = guests.join(held, guests["guest"] == held["unit"]).withColumn("guest_at", block("guest_blocks")).withColumn("at", each("blocks")).withColumn("left", F.lit(True))
    both = own.select("host", "at", "guest_at", "left", "sid", "n", "bits").unionByName(guests.select("host", "at", "guest_at", "left", "sid", "n", "bits"))
    both = both.select(F.xxhash64("host", "at", "guest_at").alias("key"), "left", "sid", "n", "bits").withColumn("slot", F.pmod("key", F.lit(n_slots)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        ids, sid, row = _coded(table["sid"])
        maps = Bitmaps(table["bits"].take(row).to_pylist())
        key, left, n = table["key"].to_numpy(), table["left"].to_numpy(), table["n"].to_numpy().astype(np.int64)
        n_of = n[row.to_numpy()]
        order = np.lexsort((~left, key))
        key, left, n, sid = key[order], left[order], n[order], sid[order]
        found = _Closest(most)
        # Each guest meets the host's sets of its key; they stand after the guests.
        for a, b in _runs(np.where(left, np.searchsorted(key, key, "right") - np.arange(len(key)) - 1, 0)):
            fine = ~left[b] & (5 * n[a] >= 4 * n[b]) & (5 * n[b] >= 4 * n[a])
            u, v = sid[a[fine]], sid[b[fine]]
            low, about = maps.differ(u, v)
            total = n_of[u] + n_of[v]
            open_ = 9 * low <= total
            u, v = u[open_], v[open_]
            found.add(np.minimum(u, v), np.maximum(u, v), 1000 * about[open_] // total[open_])
        a, b = found.cut()[:, :2].T.tolist()
        swap = [ids[i] > ids[j] for i, j in zip(a, b, strict=True)]
        a, b = [j if s else i for i, j, s in zip(a, b, swap, strict=True)], [i if s else j for i, j, s in zip(a, b, swap, strict=True)]
        names, sizes = (lambda k: pa.array([*[ids[i] for i in k], None], pa.binary())), (lambda k: pa.array([*n_of[k].tolist(), None], pa.int64()))
        return pa.table({"a": names(a), "n_a": sizes(a), "b": names(b), "n_b": sizes(b), "put_off": [*[0] * len(a), found.dropped]})

    return both.groupBy("slot").applyInArrow(run, "a binary, n_a long, b binary, n_b long, put_off long")


def _links(answers: DataFrame) -> DataFrame:
    return answers.filter(linked(F.col("overlap"), F.col("n_a"), F.col("n_b")))


def _first_answers(lists: DataFrame, bits: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Every set (a) compared with the pivots (b) that it meets most often, of those that bitmaps leave open."""
    met = lists.filter("pivot is not null").groupBy("sid", "pivot").agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("n_a"), F.max("pivot_n").alias("n_b"))
    met = met.withColumnsRenamed({"sid": "a", "pivot": "b"})
    for side in ("a", "b"):
        met = met.join(bits.select(F.col("sid").alias(side), F.col("bits").alias(f"bits_{side}")), side)
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("times"), "b"))
    first = _by_bitmap(met).withColumn("k", best).filter(F.col("k") <= PIVOTS)
    # Of two pivots that met each other one pair is enough.
    first = written(first.select("a", "n_a", "b", "n_b"), "join-first")
    twice = first.join(first.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi").filter("a < b").select("a", "b")
    return compared(first.join(twice, ["a", "b"], "left_anti"), docs, sets)


def _stars(bits: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each set's shell, and the shells with the components known so far.

    The first: sid, n, bits, unit (star and shell) and off (how far from the star's pivot). The second:
    unit, star, part, least, most (sizes), off (the farthest), members and bits (the pivot's).
    """
    links = _links(answers)
    own = links.groupBy("a").agg(F.max(F.struct("overlap", "b", "n_b")).alias("s"))
    off = F.coalesce(F.col("n") + F.col("s.n_b") - 2 * F.col("s.overlap"), F.lit(0))
    info = bits.join(own.withColumnRenamed("a", "sid"), "sid", "left").select("sid", "n", "bits", F.coalesce("s.b", "sid").alias("star"), off.alias("off"))
    shell = sum(((1000 * F.col("off") > k * F.col("n")).cast("int") for k in SHELLS), F.lit(0))
    info = written(info.withColumn("unit", F.concat("star", F.unhex(F.lpad(F.hex(shell), 2, "0")))), "join-stars")
    parts = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("star"), F.col("component").alias("part"))
    units = info.groupBy("unit").agg(F.first("star").alias("star"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("off").alias("off"), F.count(F.lit(1)).alias("members"))
    units = units.join(bits.select(F.col("sid").alias("star"), "bits"), "star").join(parts, "star", "left")
    return info, written(units.withColumn("part", F.coalesce("part", "star")), "join-units")


def linked_sets(spark: SparkSession, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """sid and component (the sid of one of its sets) of every set that has a link to another, but the one named."""
    n_slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"] // SLOT_GRAMS)
    lists = written(index_lists(docs, frequent_grams(docs, n_slots), n_slots), "join-lists")
    bits = sets.filter("sid is not null").select("sid", F.col("n_shingles").alias("n"), "bits").join(lists.select("sid").distinct(), "sid", "left_semi")
    bits = written(bits.groupBy("sid").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "join-bits")
    answers = _first_answers(lists, bits, docs, sets)
    info, units = _stars(bits, answers)

    pair = lambda rows: rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    done, most = pair(answers), PARTNERS
    placed = written(lists.select("token", "sid", "place").join(info.select("sid", "unit"), "sid").groupBy("token", "unit").agg(F.min("place").alias("place")), "join-placed")
    while True:
        # Of lists that hold the same shells one is enough, and none that hold one component alone.
        content = [F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("unit", F.lit(1))).alias("h"), F.bit_xor(F.xxhash64(F.lit(2), "unit")).alias("g")]
        mixed = placed.join(units.select("unit", "part"), "unit").groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y"), *content)
        mixed = written(mixed.filter("x <> y").select("token", "size", "h", "g"), "join-mixed")
        one = mixed.join(mixed.groupBy("size", "h", "g").agg(F.min("token").alias("one")), ["size", "h", "g"]).select("token", "one")
        placed = placed.join(one, "token").groupBy(F.col("one").alias("token"), "unit").agg(F.min("place").alias("place"))
        placed = written(placed, "join-placed")
        sizes = placed.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
        by_shell = placed.join(sizes, "token").join(units.select("unit", "part", "least", "most", "off", "bits"), "unit")
        shells = written(_open_shells(by_shell, most, n_slots), "join-shells")
        open_ = written(_open_pairs(shells.filter("p is not null"), units, info, most, n_slots), "join-open")
        complete = shells.filter("put_off > 0").isEmpty() and open_.filter("put_off > 0").isEmpty()
        new = written(open_.filter("a is not null").drop("put_off").distinct().join(done, ["a", "b"], "left_anti"), "join-new")
        if not new.isEmpty():
            answers = compared(new, docs, sets)
            done = done.union(answers.select("a", "b"))
            part = lambda s: info.select(F.col("sid").alias(s), "unit").join(units.select("unit", F.col("part").alias(f"part_{s}")), "unit").drop("unit")
            edges = _links(answers).join(part("a"), "a").join(part("b"), "b").select(F.col("part_a").alias("u"), F.col("part_b").alias("v"))
            merged = written(components(edges.distinct()), "join-merged")
            units = written(lookup_join(units, merged.withColumnRenamed("node", "part"), ["part"], salt=F.xxhash64("unit")).withColumn("part", F.coalesce("component", "part")).drop("component"), "join-units")
        if complete:
            break
        most *= MORE_PARTNERS
    found = info.select("sid", "unit").join(units.select("unit", F.col("part").alias("component")), "unit")
    return found.filter("sid <> component").select("sid", "component")


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, part (of a component's sets; null for the empty set) and text_id of every row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(document_sets(ids), "join-sets")
    parts = written(linked_sets(docs.sparkSession, ids, sets), "join-components")
    rows = lookup_join(sets.drop("bits"), parts, ["sid"], salt=F.xxhash64("doc_id"))
    rows = rows.withColumn("part", F.coalesce("component", "sid"))
    groups = rows.filter("part is not null").groupBy("part").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = lookup_join(rows.select("doc_id", "n_shingles", "part", "text_id"), written(groups, "join-groups"), ["part"], salt=F.xxhash64("doc_id"))
    return rows.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "part", "text_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    component_id: the smallest doc_id that links reach. Null text and texts without words have the
    empty set and stand alone. Repeated rows get a row each, with equal results; a null doc_id never
    names a component of others. An empty table gives an empty result. Only doc_id and text are read.
    """
    return _found(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that with the smallest doc_id. All columns stay.

    Rows that repeat a kept doc_id and text are taken once. A doc_id with several texts is decided for
    each text by itself; if a component's smallest doc_id has several texts in it, one of them stays.
    A row without a doc_id stays only if no row of its component has one, and then one of these does.
    Texts without words all stay.
    """
    found = written(_found(docs), "join-result")
    # Ids of one row are decided by the id alone; the others, and rows without one, by id and text.
    twice = written(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "join-twice")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    gone = written(gone.union(twice).distinct(), "join-gone")
    few = gone.count() <= ID_ROWS
    kept = docs.filter("doc_id is not null").join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    if twice.isEmpty() and found.filter("doc_id is null").isEmpty():
        return kept
    first = found.filter("part is not null").groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id")).alias("s"))
    stay = first.select("s.doc_id", "s.text_id", F.lit(True).alias("__once"))
    stay = stay.union(found.filter("part is null").select("doc_id", "text_id", F.lit(False)).distinct())
    odd = lambda rows: rows.filter("doc_id is null").unionByName(rows.join(twice, "doc_id", "left_semi").select(*rows.columns))
    stay = written(odd(stay), "join-stay")
    rows = odd(docs).withColumns({"__id": F.col("doc_id").cast("long"), "__text_id": text_id()})
    rows = lookup_join(rows, stay.withColumnsRenamed({"doc_id": "__id", "text_id": "__text_id"}), ["__id", "__text_id"], how="inner", salt=F.xxhash64("__text_id"))
    return kept.union(rows.filter("__once").dropDuplicates(["__id", "__text_id"]).select(*docs.columns)).union(rows.filter("not __once").select(*docs.columns))
