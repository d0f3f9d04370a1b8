"""Incremental ingest: a stream of documents into a table whose key stays unique.

The table is partitioned by `_batch`, which names the query (its id lives in the checkpoint) and the batch. A batch that
is delivered again, after it was written in part or in whole, takes the keys of all other batches as known and overwrites its
own partition with the rows that it had before: each key comes in once, whenever a run dies. Of the table only the keys
are read. Two streams may feed one table one after the other, not at once: nothing locks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicloom.operators.tables import insert_or_ignore


def land(batch: DataFrame, table: str, keys: list[str], order: str, name: str) -> None:
    """The batch's new keys into its own partition."""
    spark = batch.sparkSession
    try:
        existing = spark.read.parquet(table).where(F.col("_batch") != name)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        existing = batch.limit(0)
    new = insert_or_ignore(existing, batch, keys, order).withColumn("_batch", F.lit(name))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(table)


def ingest(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: str) -> StreamingQuery:
    """Appends each micro-batch's new keys; a batch that is delivered again adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        land(batch, table, keys, order, f"{query}-{number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
