"""Connected components of similar pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def component_labels(nodes: DataFrame, pairs: DataFrame, id_: str, max_rounds: int = 50) -> DataFrame:
    """(id, component): the least id reachable over pairs (a, b). Labels jump over labels, so rounds grow with the logarithm of a path."""
    spark = nodes.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    edges = pairs.select("a", "b").union(pairs.select("b", "a")).distinct().checkpoint()
    labels = nodes.select(F.col(id_).alias("n"), F.col(id_).alias("c")).checkpoint()
    for _ in range(max_rounds):
        near = edges.join(labels.withColumnRenamed("n", "b"), "b").groupBy("a").agg(F.min("c").alias("m")).withColumnRenamed("a", "n")
        hooked = labels.join(near, "n", "left").select("n", F.least("c", F.coalesce("m", "c")).alias("c"))
        jumped = hooked.join(hooked.select(F.col("n").alias("c"), F.col("c").alias("up")), "c").select("n", F.least("c", "up").alias("c"))
        new = jumped.checkpoint()
        moved = new.join(labels.withColumnRenamed("c", "old"), "n").where("c <> old").isEmpty()
        labels = new
        if moved:
            return labels.select(F.col("n").alias(id_), F.col("c").alias("component"))
    raise RuntimeError("components did not converge")
