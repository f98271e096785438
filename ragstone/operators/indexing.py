"""Index of embedded chunks: build, open under guard, search, look up."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragstone import config as configuration
from ragstone.operators import chunking, retrieval
from ragstone.sources import tables

#: Words whose buckets a worker remembers.
REMEMBERED = 100_000


@dataclass(frozen=True)
class Embedder:
    """``embed`` turns a column array<string> into array<array<float>>, one vector of ``dimensions`` per text."""

    embedder_id: str
    dimensions: int
    embed: Callable[[Column], Column]


@functools.lru_cache(REMEMBERED)
def _bucket(token: str, dimensions: int, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{token}".encode(), digest_size=8).digest(), "big") % dimensions


def hashing_embedder(dimensions: int = 256, seed: int = configuration.SEED, normalise: bool = True) -> Embedder:
    """Hashed term counts of ASCII words, of unit length if ``normalise``; null and wordless texts are zero."""

    @F.udf("array<array<float>>", useArrow=True)
    def embed(texts):
        vectors = np.zeros((len(texts), dimensions), "f4")
        for row, x in enumerate(texts):
            for token in re.findall("[a-z0-9]+", (x or "").lower()):
                vectors[row, _bucket(token, dimensions, seed)] += 1
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        return (vectors / np.where(norm == 0, 1, norm) if normalise else vectors).astype("f4").tolist()

    return Embedder(f"hashing-d{dimensions}-s{seed}", dimensions, lambda texts: embed(F.coalesce(texts, F.array().cast("array<string>"))))


def embedder_of(config: dict) -> Embedder:
    """The embedder that ``config`` names; models that are not offered raise NotImplementedError."""
    if config["embedding"]["provider"] != "hashing":
        raise NotImplementedError(f"embedding.provider {config['embedding']['provider']!r}: pass an Embedder instead")
    return hashing_embedder(config["embedding"]["dimensions"], config["seed"], config["retrieval"]["normalize"])


def shape_faults(chunks: DataFrame, dimensions: int) -> DataFrame:
    """chunk_id and n of the vectors that do not have ``dimensions`` components; a null vector has none."""
    n = F.coalesce(F.size("embedding"), F.lit(0))
    return chunks.select("chunk_id", n.alias("n")).filter(F.col("n") != dimensions)


def build_index(pages: DataFrame, config: dict, path: str, embedder: Embedder | None = None) -> DataFrame:
    """Chunk, embed and store ``pages`` (base_path, body; title and url if there); the chunks as stored.

    Raises ValueError if there is nothing to index or a vector has the wrong length. An index is
    written without its meta table first, so that one that failed cannot be opened.
    """
    embedder, spark = embedder or embedder_of(config), pages.sparkSession
    if config["store"]["type"] != "flat":
        raise NotImplementedError(f"store.type {config['store']['type']!r}")
    c = config["chunking"]
    chunks = chunking.chunk_pages(pages, c["splitter"], c["chunk_size"], c["chunk_overlap"], c["separators"])
    about = pages.select(F.col("base_path").alias("page_path"), *[F.col(n) for n in ("title", "url") if n in pages.columns]).dropDuplicates(["page_path"])
    chunks = chunks.join(about, "page_path").withColumn("embedding", embedder.embed(F.array("text"))[0])
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks")
    count = stored.count()
    if not count:
        raise ValueError("no chunks: there are no pages, or all are blank")
    if wrong := shape_faults(stored, embedder.dimensions).head(1):
        raise ValueError(f"vector of {wrong[0].n} components in {wrong[0].chunk_id}, not {embedder.dimensions}")
    tables.save_meta(spark, path, {**_made_by(config, embedder), "count": str(count)})
    return stored


def _made_by(config: dict, embedder: Embedder) -> dict[str, str]:
    return {"store": config["store"]["type"], "dimensions": str(embedder.dimensions), "embedder_id": embedder.embedder_id, "config_fingerprint": configuration.fingerprint(config)}


def open_index(spark: SparkSession, path: str, config: dict, embedder: Embedder | None = None) -> DataFrame:
    """The chunks at ``path``; ValueError if another configuration or embedder made them."""
    return tables.load_index(spark, path, _made_by(config, embedder or embedder_of(config)))


def retrieve(questions: DataFrame, chunks: DataFrame, config: dict, embedder: Embedder | None = None, k: int | None = None) -> DataFrame:
    """qid, id (a chunk_id), score, rank of the ``k`` (else the configured top_k) best chunks per question (qid, question)."""
    if config["retrieval"]["retriever"] != "dense":
        raise NotImplementedError(f"retrieval.retriever {config['retrieval']['retriever']!r}: only dense")
    embedder = embedder or embedder_of(config)
    queries = questions.select("qid", embedder.embed(F.array("question"))[0].alias("embedding"))
    index = chunks.select(F.col("chunk_id").alias("id"), "embedding")
    return retrieval.dense_topk(queries, index, config["retrieval"]["top_k"] if k is None else k, normalise=False)


def looked_up(chunks: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """position, wanted and the chunks found for each of ``wanted``, one row with null chunk columns for none.

    An id gives its chunk; else a name without # gives all chunks of that page in order. ``wanted`` is
    what a person asks for, a short list.
    """
    asked = chunks.sparkSession.createDataFrame(list(enumerate(wanted)), "position int, wanted string")
    by_id = asked.join(chunks, asked.wanted == chunks.chunk_id)
    rest = asked.join(by_id.select("position"), "position", "left_anti")
    by_page = rest.filter(~F.contains("wanted", F.lit("#"))).join(chunks, F.col("wanted") == chunks.page_path)
    found = by_id.unionByName(by_page)
    missing = asked.join(found.select("position"), "position", "left_anti")
    return found.unionByName(missing, allowMissingColumns=True).orderBy("position", "chunk_index")
