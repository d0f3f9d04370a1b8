"""Topics: average-linkage clusters, labels, numbering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions import text
from topicloom.operators import linkage

def average_linkage(vectors: np.ndarray, threshold: float) -> list[list[int]]:
    """Merges the two groups of highest mean similarity while it reaches the threshold; zero vectors stay out. The plain order of a few vectors; clusters() takes any number."""
    live = [i for i in range(len(vectors)) if np.any(vectors[i])]
    groups = [[i] for i in live]
    if len(groups) < 2:
        return groups
    sims = (vectors[live] @ vectors[live].T).astype(float)
    np.fill_diagonal(sims, -np.inf)
    size, alive = np.ones(len(groups)), np.ones(len(groups), bool)
    best = sims.argmax(1)  # each group's nearest; a merge changes few of them
    top = sims[np.arange(len(sims)), best]
    while True:
        i = int(top.argmax())
        if top[i] < threshold:
            break
        i, j = sorted((i, int(best[i])))
        merged = (size[i] * sims[i] + size[j] * sims[j]) / (size[i] + size[j])
        sims[i], sims[:, i] = merged, merged
        sims[i, i] = -np.inf
        sims[j], sims[:, j] = -np.inf, -np.inf
        groups[i] += groups[j]
        size[i] += size[j]
        alive[j] = False
        lost = np.flatnonzero((best == i) | (best == j))
        lost = np.union1d(lost, [i, j])
        best[lost] = sims[lost].argmax(1)
        top[lost] = sims[lost, best[lost]]
        nearer = np.flatnonzero((sims[:, i] > top) | ((sims[:, i] == top) & (best > i) & alive))
        best[nearer], top[nearer] = i, sims[nearer, i]
    return [sorted(g) for g, a in zip(groups, alive) if a]


def clusters(rows: DataFrame, id_: str, threshold: float, min_size: int, max_topics: int) -> DataFrame:
    """(topic_id, id) of sparse vectors (id, idx, weight): average linkage of any number of vectors; groups of min_size or more, the largest first, of ties that of the least id, numbered T0000 on."""
    found = linkage.clusters(linkage.merges(rows, id_, threshold), rows.select(id_).distinct(), id_, [threshold]).select(id_, F.col("cluster").alias("head"))
    sizes = found.groupBy("head").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= min_size)
    first = sizes.orderBy(F.desc("size"), "head").limit(max_topics)
    named = first.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("size"), "head"))).select("head", F.format_string("T%04d", F.col("rn") - 1).alias("topic_id"))
    return found.join(named, "head").select("topic_id", id_)


def cluster(rows: DataFrame, id_: str, vector: str, component: str, threshold: float, min_size: int, max_topics: int) -> DataFrame:
    """clusters() of dense vectors. Their component is not looked at: the merges find the parts of the graph themselves."""
    entries = rows.select(id_, F.posexplode(vector).alias("idx", "weight")).select(id_, "idx", F.col("weight").cast("double").alias("weight")).where("weight <> 0")
    return clusters(entries, id_, threshold, min_size, max_topics)


def terms(docs: DataFrame, topic: str, body: str, limit: int = 30) -> DataFrame:
    """(topic, term, score, place): words and word pairs used twice or more, by class TF-IDF; ties by term."""
    counts = docs.select(topic, F.explode(text.phrases(text.tokens(F.col(body)))).alias("term")).groupBy(topic, "term").agg(F.count(F.lit(1)).alias("n"))
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("topics"))
    totals = counts.groupBy(topic).agg(F.sum("n").alias("total"))
    n_topics = docs.agg(F.count_distinct(topic).alias("n_topics"))
    scored = counts.where("n >= 2").join(frequency, "term").join(totals, topic).join(F.broadcast(n_topics))
    score = F.col("n") / F.col("total") * F.log(1 + F.col("n_topics") / (1.0 + F.col("topics")))
    scored = scored.withColumn("raw", score)
    place = F.row_number().over(Window.partitionBy(topic).orderBy(F.desc(F.round("raw", 12)), "term"))
    return scored.withColumn("place", place).where(F.col("place") <= limit).select(topic, "term", F.round("raw", 6).alias("score"), "place")


def labels(found: DataFrame, topic: str, min_terms: int = 3) -> DataFrame:
    """(topic, label) of topics with enough different terms."""
    ordered = found.groupBy(topic).agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("t")).select(topic, F.col("t.term").alias("terms"))
    return ordered.where(F.size(F.array_distinct("terms")) >= min_terms).select(topic, text.compose_label(F.col("terms")).alias("label"))


def leader(vectors: np.ndarray, threshold: float, min_size: int, merge: float | None = None) -> list[list[int]]:
    """Sequential leader clustering, one reassignment, then a merge of near centroids; order-dependent by nature."""
    merge = min(threshold + 0.15, 0.95) if merge is None else merge
    unit = lambda v: v / n if (n := np.linalg.norm(v)) > 0 else v
    centres: list[np.ndarray] = []
    sums: list[np.ndarray] = []
    for v in vectors:
        sims = np.array([c @ v for c in centres])
        if len(sims) and sims.max() >= threshold:
            k = int(sims.argmax())
            sums[k] = sums[k] + v
            centres[k] = unit(sums[k])
        else:
            sums.append(v.copy())
            centres.append(unit(v))
    if not centres:
        return []
    sims = vectors @ np.array(centres).T
    owner = np.where(sims.max(1) >= threshold, sims.argmax(1), -1)
    centres = [unit(vectors[owner == k].mean(0)) if (owner == k).any() else np.zeros(vectors.shape[1]) for k in range(len(centres))]
    root = list(range(len(centres)))
    for a in range(len(centres)):
        for b in range(a + 1, len(centres)):
            if centres[a] @ centres[b] >= merge:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    found: dict[int, list[int]] = {}
    for i, k in enumerate(owner):
        if k >= 0:
            found.setdefault(root[k], []).append(i)
    return sorted((g for g in found.values() if len(g) >= min_size), key=lambda g: (-len(g), g[0]))
