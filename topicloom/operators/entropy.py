"""How evenly a topic's documents are spread over categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalised_entropy(rows: DataFrame, topic: str, category: str, name: str = "entropy") -> DataFrame:
    """(topic, name): -sum p ln p / ln k over the k categories that a topic has, 0 of fewer than two; null where it has none (null categories do not count)."""
    counts = rows.where(F.col(category).isNotNull()).groupBy(topic, category).agg(F.count(F.lit(1)).alias("n"))
    n, k = F.col("n"), F.count(F.lit(1))
    # -sum (n/N) ln (n/N) = ln N - sum n ln n / N, in one aggregate
    spread = (F.log(F.sum("n").cast("double")) - F.sum(n * F.log(n.cast("double"))) / F.sum("n")) / F.log(k.cast("double"))
    entropy = F.when(k < 2, F.lit(0.0)).otherwise(F.least(F.greatest(spread, F.lit(0.0)), F.lit(1.0)))
    return rows.select(topic).distinct().join(counts.groupBy(topic).agg(entropy.alias(name)), topic, "left")


def mean_entropy(rows: DataFrame, topic: str, categories: list[str]) -> DataFrame:
    """(topic, entropy): the mean over those categories (columns; of an array each element counts once a row) that a topic has any of; 0 where it has none."""
    found = rows.select(topic).distinct()
    for k, category in enumerate(categories):
        one = rows.select(topic, F.explode(F.array_distinct(category)).alias(category)) if rows.schema[category].dataType.typeName() == "array" else rows.select(topic, category)
        found = found.join(normalised_entropy(one, topic, category, f"_{k}"), topic, "left")
    parts = F.filter(F.array(*[f"_{k}" for k in range(len(categories))]), lambda x: x.isNotNull())
    mean = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)
    return found.select(topic, F.when(F.size(parts) > 0, mean).otherwise(F.lit(0.0)).alias("entropy"))
