"""Manifests compared as they arrive: an extension, the batch comparison run by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ragstone.operators import drift


def compare_arrivals(spark: SparkSession, folder: str, schema: str, stored: str, changes: str, checkpoint: str) -> None:
    """Compare each new batch of manifest rows in ``folder`` with the manifest at ``stored``, append the changes, store the batch.

    Runs over what is there and ends. A batch that is repeated after a failure overwrites its own changes.
    """

    def each(batch: DataFrame, number: int) -> None:
        try:
            old = spark.read.schema(batch.schema).parquet(f"{stored}/current-{number - 1}") if number else batch.limit(0)
        except Exception as missing:
            raise RuntimeError(f"the manifest before batch {number} is gone") from missing
        drift.manifest_diff(old, batch).write.mode("overwrite").parquet(f"{changes}/batch={number}")
        merged = drift.manifest_merge(old, batch) if "fetched_at" in batch.columns else batch
        merged.write.mode("overwrite").parquet(f"{stored}/current-{number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
