"""Spark sessions and table reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "topicloom", master: str | None = None, **settings: str) -> SparkSession:
    """UTC, adaptive execution; what the cluster sets otherwise stays."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.master(master) if master else builder
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
