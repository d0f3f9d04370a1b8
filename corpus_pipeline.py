"""The corpus pipeline: toxicity, quality rules, near-duplicates, personal data, packing.

Each stage takes the documents that its predecessor kept and returns documents (the last one: packed
pieces). What one stage returns is written as Parquet in the folder that driver and executors share
and read again as the next one's input, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import jaccard, packing, pii, quality, toxicity
from topicloom.llm.common import new_folder, session, table
from topicloom.llm.queries import held_out


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones among them, scores as toxic go."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a floor or are outliers of their language and source go."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints that differ by two bits at most, by multi-index hashing as in op5, and five-word shingles of Jaccard similarity 0.8 or more both link."""
    return jaccard.representatives(docs, max_bits=2)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is generalised, terms that disclose it are removed."""
    return pii.sanitised(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
#: Not expressible in SQL: a trained model, robust estimates, components and a vocabulary's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    session(spark)
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
