"""Writes that keep keys unique, replacement by run, and run logs, over Parquet tables or frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def insert_or_ignore(existing: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The batch's new rows: the first of each key by `order`, unless the key exists."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return batch.withColumn("_rn", first).where("_rn = 1").drop("_rn").join(existing.select(*keys), keys, "left_anti")


def insert_or_replace(existing: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The whole table after the batch: its last row of each key replaces what was there."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    batch = batch.withColumn("_rn", last).where("_rn = 1").drop("_rn")
    return existing.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def migrated(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the columns of a schema, in its order: what older files lack is null, what they have is cast, what the schema does not name stays behind."""
    there = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(there[f.name.lower()]) if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_run(existing: DataFrame, new: DataFrame, run_id: str) -> DataFrame:
    """The whole table with the run's rows replaced, by none if `new` is empty."""
    return existing.where(F.col("run_id") != run_id).unionByName(new.where(F.col("run_id") == run_id))


def replace_children(children: DataFrame, parents: DataFrame, new: DataFrame, key: str, run_id: str) -> DataFrame:
    """Rows whose parent belongs to the run go, the new ones come."""
    gone = parents.where(F.col("run_id") == run_id).select(key)
    return children.join(gone, key, "left_anti").unionByName(new)


def overwrite_run(table: str, new: DataFrame, run_id: str) -> None:
    """Replaces one partition of a table partitioned by run_id; an empty frame clears it (dynamic overwrite would not). The new files are written whole beside the old ones before these go."""
    spark = new.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, beside = path(f"{table}/run_id={run_id}"), path(f"{table}/_new-{run_id}")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new.drop("run_id").write.mode("overwrite").parquet(f"{table}/_new-{run_id}")
    fs.delete(old, True)
    if not fs.rename(beside, old):
        raise OSError(f"{table}/_new-{run_id} could not take the old partition's place")


def run_status(events: DataFrame) -> DataFrame:
    """Start and finish events of a stage (same id) as one row: what the latest event says of each."""
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    return events.groupBy("id").agg(*[latest(c) for c in events.columns if c not in ("id", "seq")])


def log_message(text, limit: int):
    return F.substring(text, 1, limit)


def evidence(members: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """Of each topic the k members most similar, then most cited."""
    place = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("similarity"), F.desc("citation_count"), "doc_id"))
    return members.join(documents, "doc_id").withColumn("place", place).where(F.col("place") <= k)


def ranked_topics(topics: DataFrame, scores: DataFrame, limit: int | None = None) -> DataFrame:
    found = topics.join(scores, ["topic_id", "run_id"]).orderBy("rank", "topic_id")
    return found.limit(limit) if limit else found


class RunLog:
    """Stage events of a run, appended as Parquet."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id

    def write(self, id_: int, seq: int, stage: str, status: str, message: str = "") -> None:
        row = [(id_, seq, self.run_id, stage, status, message[:2000])]
        self.spark.createDataFrame(row, "id long, seq long, run_id string, stage string, status string, message string").write.mode("append").parquet(self.path)
