"""Vector retrieval, hashing embedder and ranking metrics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragstone.functions import text

#: Queries that one pass over the index serves, and the size of blocks beyond; rows of a slice of the
#: index that a block meets in one task; rows multiplied at once.
QUERY_BLOCK = 1024
INDEX_SLICE = 65_536
STEP = 4096


def _best(qids: np.ndarray, matrix: np.ndarray, batches: Iterable[pa.RecordBatch], k: int, unit: Callable, others: bool) -> pa.RecordBatch:
    """qid, id, score of the ``k`` best rows of ``batches`` (id, embedding) per query of ``matrix``."""
    best_id, best = np.zeros((len(qids), 0), qids.dtype), np.zeros((len(qids), 0))
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            ids, vectors = _array(part["id"]), unit(_matrix(part["embedding"], matrix.shape[1]))
            # Ids are compared by their places in one sorted list, so text ids are never copied per query.
            names, code = np.unique(np.concatenate([best_id.ravel(), ids]), return_inverse=True)
            mine, new = code[: best_id.size].reshape(best_id.shape), np.broadcast_to(code[best_id.size :], (len(qids), len(ids)))
            codes = np.concatenate([mine, new], axis=1)
            scores = np.concatenate([best, np.round(matrix @ vectors.T, 6) + 0.0], axis=1)
            if others:
                at_own = np.minimum(np.searchsorted(names, qids), len(names) - 1)
                scores[(codes == at_own[:, None]) & (names[at_own] == qids)[:, None]] = -np.inf
            order = np.lexsort((codes, -scores), axis=1)[:, :k]
            best_id, best = names[np.take_along_axis(codes, order, 1)], np.take_along_axis(scores, order, 1)
    keep = best.ravel() != -np.inf
    kind = pa.string() if qids.dtype.kind == "U" else pa.int64()
    columns = [pa.array(np.repeat(qids, best.shape[1])[keep].tolist(), kind), pa.array(best_id.ravel()[keep].tolist(), kind), pa.array(best.ravel()[keep])]
    return pa.RecordBatch.from_arrays(columns, names=["qid", "id", "score"])


def _array(ids) -> np.ndarray:
    return np.array(ids.to_pylist(), dtype="U" if pa.types.is_string(ids.type) or pa.types.is_large_string(ids.type) else "i8")


def _matrix(vectors, width: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten() if isinstance(vectors, pa.ChunkedArray) else vectors.flatten()
    return np.array(flat, dtype="f8").reshape(-1, width)


def dense_topk(queries: DataFrame, index: DataFrame, k: int = 10, normalise: bool = True, others: bool = False, block: int = QUERY_BLOCK) -> DataFrame:
    """qid, id, score (6 decimals), rank of the ``k`` best rows of ``index`` (id, embedding) per query (qid, embedding).

    Up to ``block`` queries, counted first, travel to the index, which is not shuffled: each task
    multiplies its batches by them and passes on its own best ``k`` per query. More are dealt out in
    blocks of about that size, and meet slices of the index in tasks of their own; nothing of them is
    gathered on the driver. Order: score, then id. A zero vector scores 0; null vectors take no part.
    Ids are numbers, or texts on both sides. ``others``: rows with the query's own id do not count.
    """
    kind = "string" if dict(index.dtypes)["id"] == "string" else "long"
    out = f"qid {kind}, id {kind}, score double"
    queries = queries.select(F.col("qid").cast(kind).alias("qid"), "embedding").filter("embedding is not null")
    index = index.select(F.col("id").cast(kind).alias("id"), "embedding").filter("embedding is not null")
    unit = lambda m: m / np.where((norm := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1.0, norm) if normalise else m
    first = queries.orderBy("qid").limit(block + 1).collect()
    if not first:
        return ranked(queries.sparkSession.createDataFrame([], out), k)
    if len(first) <= block:
        qids, matrix = np.array([q[0] for q in first]), unit(np.array([q[1] for q in first], dtype="f8"))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield _best(qids, matrix, batches, k, unit, others)

        return ranked(index.mapInArrow(search, out), k)
    n_blocks, n_slices = -(-queries.count() // block), -(-max(1, index.count()) // INDEX_SLICE)
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = queries.withColumns({"block": deal("qid", n_blocks)}).withColumn("slice", every(n_slices))
    x = index.withColumns({"slice": deal("id", n_slices)}).withColumn("block", every(n_blocks))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([_best(_array(right["id"])[:0], np.zeros((0, 0)), [], k, unit, others)])
        matrix = unit(_matrix(left["embedding"], len(left["embedding"][0])))
        return pa.Table.from_batches([_best(_array(left["qid"]), matrix, right.to_batches(), k, unit, others)])

    return ranked(q.groupBy("block", "slice").cogroup(x.groupBy("block", "slice")).applyInArrow(meet, out), k)


def ranked(scores: DataFrame, k: int, by: str = "id") -> DataFrame:
    """``scores`` (qid, ``by``, score) with the rank of the ``k`` best per query: score descending, then ``by``."""
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), F.asc(by)))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def hash_buckets(words: DataFrame, dimensions: int, seed: int) -> DataFrame:
    """token and bucket of each distinct token: keyed blake2b, so the costly hash runs once per word."""

    @F.udf("int", useArrow=True)
    def bucket(token):
        return int.from_bytes(hashlib.blake2b(f"{seed}:{token}".encode(), digest_size=8).digest(), "big") % dimensions

    return words.select("token").distinct().withColumn("bucket", bucket("token"))


def sparse_vectors(docs: DataFrame, dimensions: int = 256, seed: int = 42, bucket: Column | None = None, normalise: bool = True) -> DataFrame:
    """id, bucket, weight: hashed term frequencies of ``docs`` (id, text), of unit length if ``normalise``.

    ``bucket``: an expression over the column ``token`` that takes the place of blake2b.
    """
    words = docs.select("id", F.explode(text.tokens(F.col("text"))).alias("token")).groupBy("id", "token").agg(F.count(F.lit(1)).alias("n"))
    words = words.withColumn("bucket", bucket) if bucket is not None else words.join(hash_buckets(words, dimensions, seed), "token")
    counts = words.groupBy("id", "bucket").agg(F.sum("n").cast("double").alias("weight"))
    if not normalise:
        return counts
    norms = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return counts.join(norms, "id").select("id", "bucket", (F.col("weight") / F.col("norm")).alias("weight"))


def sparse_topk(queries: DataFrame, index: DataFrame, k: int = 10) -> DataFrame:
    """qid, id, score, rank by the inner product of sparse vectors (id, bucket, weight): a join on the bucket and a sum."""
    q = queries.select(F.col("id").alias("qid"), "bucket", F.col("weight").alias("q"))
    scores = index.join(q, "bucket").groupBy("qid", "id").agg(F.round(F.sum(F.col("weight") * F.col("q")), 6).alias("score"))
    return ranked(scores, k)


def question_metrics(ranking: DataFrame, relevant: DataFrame, served: int = 5, depth: int = 10, totals: DataFrame | None = None) -> DataFrame:
    """Per question of ``relevant`` (qid, id): hit_at_5, reciprocal_rank, recall_at_10, served_recall, first_relevant_rank.

    ``ranking``: qid, id, rank. Repeated relevant ids count once; a question without a hit has zeros
    and a null rank. With ``totals`` (qid, n: how many are relevant) it is per question of these, and
    ``relevant`` needs to hold only ids of the ranking.
    """
    wanted = relevant.select("qid", "id").distinct()
    hits = wanted.join(ranking.select("qid", "id", "rank"), ["qid", "id"], "left")
    within = lambda k: F.count(F.when(F.col("rank") <= k, 1))
    n = F.count(F.lit(1))
    if totals is not None:
        hits, n = totals.join(hits, "qid", "left"), F.max("n")
    return hits.groupBy("qid").agg(
        F.when(within(5) > 0, 1.0).otherwise(0.0).alias("hit_at_5"),
        F.coalesce(1.0 / F.min("rank"), F.lit(0.0)).alias("reciprocal_rank"),
        (within(depth) / n).alias(f"recall_at_{depth}"),
        (within(served) / n).alias("served_recall"),
        F.min("rank").alias("first_relevant_rank"),
    )


def suite_means(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """One row: the mean of each metric (0 over no rows) and n_questions."""
    return scores.agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in metrics], F.count(F.lit(1)).alias("n_questions"))


def missing_gold(relevant: DataFrame, index: DataFrame) -> DataFrame:
    """Relevant (qid, id) that the index does not hold."""
    return relevant.join(index.select("id"), "id", "left_anti").select("qid", "id")
