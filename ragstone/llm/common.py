"""What the training-data operators share: the shared folder, written tables, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to this many rows a lookup table is broadcast; beyond it a salted shuffle join takes over.
BROADCAST_ROWS = 50_000
#: Copies of each lookup row in the salted join, so that a hot key is met by as many tasks.
SALTS = 16
#: Rows that a Python worker holds as Python objects at once.
SLICE = 256


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent (local mode, tests) a folder of this machine is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="ragstone-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/ragstone/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", salt: Column | None = None) -> DataFrame:
    """Join ``rows`` with a written ``table`` that has one row per key (null keys match each other).

    The table is broadcast if its counted rows are few; otherwise each of its rows is copied
    ``SALTS`` times and the rows of a key are spread over the copies, so no key needs one task.
    """
    renamed = table.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    drop = [f"__k_{k}" for k in keys]
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(renamed), on, how).drop(*drop)
    salt = F.xxhash64(*rows.columns) if salt is None else salt
    rows = rows.withColumn("__salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    renamed = renamed.withColumn("__k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(renamed, [*on, F.col("__salt") == F.col("__k_salt")], how).drop(*drop, "__salt", "__k_salt")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it; works on executors as on the driver."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def slices(batch, size: int = SLICE) -> Iterable:
    """A record batch in short runs, so that few texts are Python objects at once."""
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)
