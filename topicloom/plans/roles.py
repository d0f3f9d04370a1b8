"""Test tables in the roles of the engine's own: the same derivations in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.session import read

DOCS = "(SELECT doc_id, source, lang AS steepv, n_chars AS citations, 2018 + doc_id % 9 AS year, text FROM documents)"
BRANDS = "(SELECT p_brand AS topic, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(SUM(l_quantity) AS DOUBLE) AS quantity, ROUND(AVG(l_discount), 8) AS discount, COUNT(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)"
USER_DAYS = "(SELECT user_id AS topic, CAST(ts AS DATE) AS day FROM events)"
ITEM_YEARS = "(SELECT p_brand AS topic, YEAR(l_shipdate) AS slice FROM lineitem JOIN part ON l_partkey = p_partkey)"
POINTS = "(SELECT vec_id, label AS topic, embedding, 2018 + vec_id % 9 AS slice FROM embeddings)"


def docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "source", F.col("lang").alias("steepv"), F.col("n_chars").alias("citations"), (2018 + F.col("doc_id") % 9).alias("year"), "text")


def items(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part").select("p_partkey", F.col("p_brand").alias("topic"))
    return read(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


def brands(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).groupBy("topic").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.sum("l_quantity").cast("double").alias("quantity"), F.round(F.avg("l_discount"), 8).alias("discount"), F.count(F.lit(1)).alias("n"))


def user_days(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(F.col("user_id").alias("topic"), F.to_date("ts").alias("day"))


def points(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select("vec_id", F.col("label").alias("topic"), "embedding", (2018 + F.col("vec_id") % 9).alias("slice"))


def rank_sql(x: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    ties = f"PARTITION BY {by}, {x}" if by else f"PARTITION BY {x}"
    return f"CASE WHEN COUNT(*) OVER ({part}) = 1 THEN 0.5 ELSE ((RANK() OVER ({part} ORDER BY {x}) - 1) + (COUNT(*) OVER ({ties}) - 1) / 2.0) / (COUNT(*) OVER ({part}) - 1) END"
