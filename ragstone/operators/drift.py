"""Snapshot comparison of page manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """base_path and change (added, removed, changed) between manifests (base_path, content_hash)."""
    o = old.select("base_path", F.col("content_hash").alias("was"), F.lit(True).alias("in_old"))
    n = new.select("base_path", F.col("content_hash").alias("now"), F.lit(True).alias("in_new"))
    change = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    return o.join(n, "base_path", "full_outer").select("base_path", change.alias("change")).filter("change is not null")


def manifest_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (base_path, content_hash, fetched_at) with the old time where the content is the same."""
    o = old.select("base_path", F.col("content_hash").alias("was"), F.col("fetched_at").alias("seen"))
    same = F.col("content_hash").eqNullSafe(F.col("was")) & F.col("seen").isNotNull()
    return new.join(o, "base_path", "left").select("base_path", "content_hash", F.when(same, F.col("seen")).otherwise(F.col("fetched_at")).alias("fetched_at"))
