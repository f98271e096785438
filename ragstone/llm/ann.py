"""Approximate nearest neighbours by multi-index hashing.

Codes: the signs of several learned rotations of a vector, end to end (iterative quantization: the
rotation that brings the vectors of a bounded sample closest to their own signs). A block of vectors
indexes each 16-bit substring of its codes. By the pigeonhole principle a code within Hamming
distance r of a query's lies within r // m in one of the m substrings (one less for all but the
first r % m + 1 of them), so probing those buckets retrieves every code within the radius; these are
reranked by the exact inner product of the original vectors.

The radius is fitted on the sample: the least at which its own nearest neighbours are found with
the wanted recall (against a smaller set neighbours lie farther away, so it errs to the safe side).
A query with fewer than k codes in its radius within a block takes the block's whole index instead.

Plan: candidate vectors form blocks, queries form blocks; each pair of blocks is one bounded task
that returns its best k per query, and a query's lists are merged by a grouped top-k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import written

ROTATIONS = 4
ITERATIONS = 25
#: Vectors that the rotations and the radius are fitted on.
SAMPLE = 8000
SAMPLE_QUERIES = 400
RECALL = 0.97
BLOCK = 8192
QUERY_BLOCK = 16384
#: Queries that probe an index at once.
AT_ONCE = 64


def learn_rotations(sample: np.ndarray, n: int = ROTATIONS, iterations: int = ITERATIONS, seed: int = 7) -> np.ndarray:
    """(dimensions, n * dimensions): rotations learned from different starts, side by side."""
    rng, d, out = np.random.default_rng(seed), sample.shape[1], []
    for _ in range(n):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(iterations):
            u, _, vt = np.linalg.svd(np.where(sample @ turn >= 0, 1.0, -1.0).T @ sample)
            turn = (u @ vt).T
        out.append(turn)
    return np.hstack(out)


def codes_of(vectors: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """(rows, substrings) of 16 bits each; the last substring is filled up with zeros."""
    bits = np.packbits(vectors @ rotations >= 0, axis=1)
    if bits.shape[1] % 2:
        bits = np.pad(bits, ((0, 0), (0, 1)))
    return np.ascontiguousarray(bits).view("<u2")


class MultiIndex:
    """An index of codes: for each substring its occupied values (buckets), and each row's bucket."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 4)))).view("<u8")
        self.buckets = [np.unique(codes[:, s], return_inverse=True) for s in range(codes.shape[1])]

    def near(self, asked: np.ndarray, radius: int) -> np.ndarray:
        """(queries, rows): which rows' codes are within ``radius`` of each query's; all queries probe at once."""
        near, extra = divmod(radius, len(self.buckets))
        seen = np.zeros((len(asked), len(self.codes)), bool)
        for s, (values, bucket) in enumerate(self.buckets):
            reach = near if s <= extra else near - 1
            if reach >= 0:
                probed = np.bitwise_count(asked[:, s, None] ^ values) <= reach
                seen |= probed[:, bucket]
        whole = np.ascontiguousarray(np.pad(asked, ((0, 0), (0, -asked.shape[1] % 4)))).view("<u8")
        far = np.zeros(seen.shape, np.uint16)
        for w in range(self.codes.shape[1]):
            far += np.bitwise_count(whole[:, w, None] ^ self.codes[:, w])
        return seen & (far <= radius)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within ``radius`` of ``code``, ascending."""
        return np.flatnonzero(self.near(code[None], radius)[0])


def fit(sample: np.ndarray, k: int, recall: float = RECALL) -> tuple[np.ndarray, int]:
    """Rotations, and the least radius that finds ``recall`` of the sample's own k nearest."""
    rotations = learn_rotations(sample)
    codes, at = codes_of(sample, rotations), np.arange(min(len(sample), SAMPLE_QUERIES))
    scores = sample[at] @ sample.T
    scores[at, at] = -np.inf
    best = np.argsort(-scores, axis=1)[:, : max(1, min(k, len(sample) - 1))]
    far = np.zeros(best.shape, np.int64)
    for s in range(codes.shape[1]):
        far += np.bitwise_count(codes[best, s] ^ codes[at, s][:, None])
    return rotations, int(np.quantile(far, recall, method="higher"))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part: not null, not zero, all components finite."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _distinct(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by ascending id, equal rows once."""
    order = np.lexsort((*vectors.T, ids))
    ids, vectors = ids[order], vectors[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(1)
    return ids[new], vectors[new]


def _best(index: MultiIndex, ids: np.ndarray, base: np.ndarray, query_ids: np.ndarray, points: np.ndarray, codes: np.ndarray, radius: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of the best ``k`` rows retrieved; of all rows where fewer are within the radius."""
    near, others = index.near(codes, radius), query_ids[:, None] != ids
    near &= others
    few = near.sum(1) < k
    near[few] = others[few]
    rough = np.where(near, points @ base.T, -np.inf)
    least = -np.partition(-rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
    for point, own, low in zip(points, rough, least, strict=True):
        # The scores themselves are summed in one order for every row, whatever the block.
        rows = np.flatnonzero((own >= low - 1e-9 * abs(low)) & (own > -np.inf)) if low > -np.inf else np.flatnonzero(own > -np.inf)
        score = (base[rows] * point).sum(1)
        best = np.lexsort((ids[rows], -score))[:k]
        yield rows[best], score[best]


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row whose vec_id is divisible by ``every``.

    Score: inner product in double precision; ties to the smaller vec_id. Null, zero and non-finite
    vectors, and null ids, take no part; vectors of another length than the sample's most common one
    neither. A row is no candidate of a query with its own id; repeated candidate rows are taken once
    per id and vector, repeated queries likewise. Fewer than ``k`` other rows: all of them.
    """
    spark = vectors.sparkSession
    rows = written(valid_vectors(vectors), "ann-vectors")
    out = "query_id long, rank int, vec_id long, score double"
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], out)
    d = sizes[0]["d"]
    rows = rows.filter(F.size("embedding") == d)
    # A bounded sample: the least hashes of all ids.
    sample = np.array([r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()])
    rotations, radius = fit(sample, k, recall)
    total, queries = sizes[0]["count"], rows.filter(F.col("vec_id") % every == 0)
    n_blocks, n_query_blocks = -(-total // BLOCK), max(1, -(-queries.count() // QUERY_BLOCK))
    in_block = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n)).cast("int")
    copied = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), in_block(n_query_blocks).alias("query_block"), F.lit(True).alias("query"), "vec_id", "embedding")
    stored = rows.select(in_block(n_blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("query_block"), F.lit(False).alias("query"), "vec_id", "embedding")

    def search(table: pa.Table) -> pa.Table:
        asked, all_ids = table["query"].to_numpy(), table["vec_id"].to_numpy()
        whole = table["embedding"].combine_chunks().flatten().to_numpy().reshape(-1, d)
        (ids, base), (query_ids, points) = _distinct(all_ids[~asked], whole[~asked]), _distinct(all_ids[asked], whole[asked])
        found = []
        if len(ids) and len(query_ids):
            index, codes = MultiIndex(codes_of(base, rotations)), codes_of(points, rotations)
            for at in range(0, len(points), AT_ONCE):
                some = slice(at, at + AT_ONCE)
                found += _best(index, ids, base, query_ids[some], points[some], codes[some], radius, k)
        n = np.array([len(hits) for hits, _ in found], np.int64)
        hits, scores = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in (0, 1))
        return pa.table({"query_id": np.repeat(query_ids, n) if found else np.zeros(0, np.int64), "vec_id": ids[hits.astype(np.int64)], "score": scores})

    best = copied.unionByName(stored).groupBy("block", "query_block").applyInArrow(search, "query_id long, vec_id long, score double")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k)
    lists = best.dropDuplicates(["query_id", "vec_id", "score"]).groupBy("query_id").agg(top.alias("top"))
    return lists.select("query_id", F.posexplode("top").alias("at", "hit")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
