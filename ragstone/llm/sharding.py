"""Sharding by best-fit decreasing.

Documents with equal texts form a group that stays in one shard. Groups, largest first, enter the
bin with the least remaining capacity that still holds them; the open bins stand in a balanced
tree, so the tightest fit is one descent. The capacity is the least tried one at which the wanted
number of bins suffices, hence shard sizes come out nearly equal (law ``bytes``).

Scale: what the driver packs is bounded by parameters alone. Groups over ``1 / FINE`` of a shard
are units of their own (by the pigeonhole principle at most ``shards * FINE``); all smaller groups
are gathered by hash into ``shards * PARCELS`` parcels of whole groups. A group larger than a shard
cannot stay whole under any capacity: it alone is cut, by hash of its rows, into pieces of about
``1 / PIECES`` of a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragstone.llm.common import lookup_join, written

FINE = 200
PARCELS = 128
PIECES = 64
#: Shard-local blocks in which slots are counted side by side.
SLOT_BLOCKS = 16
#: Rows of a shard in a block, about, where there are many.
BLOCK_ROWS = 200_000
#: Bytes that a row costs besides its text.
ROW_BYTES = 16


class BalancedTree:
    """An AVL tree of distinct comparable keys with ``add``, ``remove`` and ``ceiling`` in O(log n)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # a node is [key, left, right, height]

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _fixed(self, node):
        """``node`` after its subtrees may differ in height by two."""
        h = self._height
        if h(node[1]) > h(node[2]) + 1:
            if h(node[1][2]) > h(node[1][1]):
                node[1] = self._turned(node[1], 2)
            return self._turned(node, 1)
        if h(node[2]) > h(node[1]) + 1:
            if h(node[2][1]) > h(node[2][2]):
                node[2] = self._turned(node[2], 1)
            return self._turned(node, 2)
        node[3] = max(h(node[1]), h(node[2])) + 1
        return node

    def _turned(self, node, up: int):
        """The child on side ``up`` (1 left, 2 right) takes the node's place."""
        child = node[up]
        node[up] = child[3 - up]
        child[3 - up] = node
        for x in (node, child):
            x[3] = max(self._height(x[1]), self._height(x[2])) + 1
        return child

    def add(self, key) -> None:
        def into(node):
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = into(node[side])
            return self._fixed(node)

        self.root = into(self.root)

    def remove(self, key) -> None:
        def out_of(node, key):
            if key == node[0]:
                if node[1] is None or node[2] is None:
                    return node[1] or node[2]
                least = node[2]
                while least[1]:
                    least = least[1]
                node[0] = least[0]
                node[2] = out_of(node[2], least[0])
            else:
                side = 1 if key < node[0] else 2
                node[side] = out_of(node[side], key)
            return self._fixed(node)

        self.root = out_of(self.root, key)

    def ceiling(self, key):
        """The least key that is not below ``key``, or None."""
        node, best = self.root, None
        while node:
            if node[0] >= key:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size, bins numbered as they open; None if more than ``most`` bins would open.

    Sizes are taken in decreasing order, ties in the order given. No size may exceed the capacity.
    """
    if any(s > capacity for s in sizes):
        return None
    bins, tree, opened = [0] * len(sizes), BalancedTree(), 0
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = tree.ceiling((sizes[at], -1))
        if fit is None:
            if most is not None and opened == most:
                return None
            fit = (capacity, opened)
            opened += 1
        else:
            tree.remove(fit)
        bins[at] = fit[1]
        tree.add((fit[0] - sizes[at], fit[1]))
    return bins


def packed_into(sizes: list[int], n_bins: int) -> list[int]:
    """Best fit into ``n_bins`` bins at nearly the least capacity that suffices (slack doubles from 2**-14)."""
    if not sizes:
        return []
    least = max(-(-sum(sizes) // n_bins), max(sizes))
    slack = 0.0
    while True:
        bins = best_fit_decreasing(sizes, int(least * (1 + slack)), n_bins)
        if bins is not None:
            return bins
        slack = slack * 2 or 2**-14


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Null text: no bytes, crc of the empty text, all null texts one group. Repeated rows and ids each
    get a slot of their own; ties in doc_id within a shard are broken by the row's place in the
    input. An empty table gives an empty result; columns besides doc_id and text are not read.
    """
    placed, _ = _placed(docs.withColumn("__uid", F.monotonically_increasing_id()), n_shards)
    # A row per shard and block: each block's first slot.
    sums = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sums.select("shard", "block", before.alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "uid"))
    return (
        lookup_join(placed.withColumn("rank", rank), written(first, "shard-first"), ["shard", "block"], how="inner", salt=F.xxhash64("uid"))
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank") - 1).alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
    )


def _placed(docs: DataFrame, n_shards: int) -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32, uid, shard, block of every row of ``docs`` (with a column __uid), and the number of blocks in a shard."""
    spark = docs.sparkSession
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.coalesce(F.sha2("text", 256), F.lit("null")).alias("key"),
            F.col("__uid").alias("uid"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_blocks = max(SLOT_BLOCKS, n_rows // (n_shards * BLOCK_ROWS))
    share = -(-total // n_shards)
    parcel = F.concat(F.lit("p"), F.pmod(F.xxhash64("key"), F.lit(n_shards * PARCELS)).cast("string"))
    unit_of = F.when(F.col("bytes") > share // FINE, F.col("key")).otherwise(parcel)
    # At most shards * (FINE + PARCELS) rows, whatever the input.
    units = [(r["unit"], r["bytes"]) for r in groups.groupBy(unit_of.alias("unit")).agg(F.sum("bytes").alias("bytes")).collect()]
    over = [(u, min(-(-b * PIECES // share), n_shards * PIECES)) for u, b in units if b > share and u[0] != "p"]
    cut = spark.createDataFrame(over, "key string, n_pieces long")
    labelled = (
        rows.join(F.broadcast(spark.createDataFrame([(u,) for u, _ in units if u[0] != "p"], "unit string")), F.col("key") == F.col("unit"), "left")
        .join(F.broadcast(cut), "key", "left")
        .withColumn("unit", F.coalesce("unit", parcel))
        .withColumn("piece", F.when(F.col("n_pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("uid"), F.col("n_pieces"))))
    )
    if over:
        pieces = labelled.filter("n_pieces is not null").groupBy("unit", "piece").agg(F.sum("size").alias("bytes")).collect()
        cut_units = {u for u, _ in over}
        packed = [(u, 0, b) for u, b in units if u not in cut_units] + [(r["unit"], r["piece"], r["bytes"]) for r in pieces]
    else:
        packed = [(u, 0, b) for u, b in units]
    packed.sort()
    bins = packed_into([b for *_, b in packed], n_shards)
    places = spark.createDataFrame([(u, p, s) for (u, p, _), s in zip(packed, bins, strict=True)], "unit string, piece long, shard int")
    placed = labelled.join(F.broadcast(places), ["unit", "piece"]).select("doc_id", "size", "text_crc32", "uid", "shard")
    return written(placed.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int")), "shard-places"), n_blocks


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> None:
    """Write every row of ``docs`` with all its columns as one Parquet folder per shard under ``path`` (``shard=<n>/``).

    Rows are placed one by one, so null and repeated ids are kept, and equal ids with different texts
    may part. Where ``docs`` has a column shard of its own, it stays and the folders are named
    ``shard_=<n>/``, with as many underscores as make the name free. An empty table writes
    no folder.
    """
    name = "shard"
    while name in docs.columns:
        name += "_"
    # The numbers of rows must not change between two readings: they are written with the rows.
    rows = written(docs.withColumn("__uid", F.monotonically_increasing_id()), "shard-input")
    placed, n_blocks = _placed(rows, n_shards)
    placed = placed.select(F.col("uid").alias("__uid"), F.col("shard").alias(name), F.col("block").alias("__block"))
    rows.join(placed, "__uid").repartition(n_shards * n_blocks, name, "__block").drop("__uid", "__block").write.partitionBy(name).parquet(path)
