"""The similarity join and average linkage in rounds against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import linkage, topics, vectors


def sparse(spark, dense):
    rows = [(i, k, float(x)) for i, v in enumerate(dense) for k, x in enumerate(v) if x]
    return spark.createDataFrame(rows, "id long, idx int, weight double")


def bunched(rng, n, dims, groups, spread):
    v = rng.normal(size=(groups, dims))[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))
    v[rng.random(v.shape) < 0.3] = 0
    v[: n // 10] = v[n // 2 : n // 2 + n // 10]  # equal vectors
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm, norm, 1)


@pytest.mark.parametrize("threshold, cell", [(0.14, 2048), (0.5, 7), (0.9, 3)])
def test_join_equals_all_pairs(spark, threshold, cell):
    v = bunched(np.random.default_rng(int(100 * threshold)), 120, 12, 9, 0.5)
    sims = v @ v.T
    want = {(i, j): s for i in range(120) for j in range(i + 1, 120) if (s := sims[i, j]) >= threshold}
    got = {(r.a, r.b): r.similarity for r in vectors.similar_pairs(sparse(spark, v), "id", threshold, cell).collect()}
    assert got == pytest.approx(want)


def test_an_index_in_all_texts_makes_no_pairs(spark):
    """400 vectors share one light index and nothing else: no pair is looked at."""
    rows = [(i, 0, 0.3) for i in range(400)] + [(i, 1 + i, (1 - 0.09) ** 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, idx int, weight double")
    assert vectors.similar_pairs(df, "id", 0.14).collect() == []
    held = df.where("idx > 0").count()
    assert held == 400  # what the inverted index holds: 400 entries of 400 indices
    assert len(vectors.similar_pairs(df, "id", 0.09).collect()) == 400 * 399 // 2


def trees(found, n, level):
    root = list(range(n))
    for r in sorted(found, key=lambda r: -r.child):
        if r.similarity >= level:
            root[r.child] = r.parent
    for i in range(n):
        root[i] = root[root[i]]
    return sorted(map(tuple, ({k: sorted(i for i in range(n) if root[i] == k) for k in root}).values()))


@pytest.mark.parametrize("seed, local", [(1, 2048), (2, 10)])
def test_rounds_equal_the_sequential_order(spark, seed, local):
    n = 70 if local > 70 else 36
    v = bunched(np.random.default_rng(seed), n, 6, 4, 0.6)
    found = linkage.merges(sparse(spark, v), "id", 0.2, local).collect()
    assert len({r.child for r in found}) == len(found) and all(r.parent < r.child for r in found)
    for level in (0.2, 0.5, 0.8):
        want = topics.average_linkage(v, level)
        got = [g for g in trees(found, n, level) if len(g) > 1]
        assert got == sorted(tuple(g) for g in want if len(g) > 1)


def test_levels_of_one_table(spark):
    v = bunched(np.random.default_rng(5), 60, 6, 5, 0.5)
    rows = sparse(spark, v)
    found, nodes = linkage.merges(rows, "id", 0.2), spark.range(60)
    levels = [0.2, 0.45, 0.7, 0.95]
    figures = {r.level: r for r in linkage.sweep(found, nodes, "id", levels).collect()}
    for level in levels:
        sizes = [len(g) for g in topics.average_linkage(v, level) if len(g) > 1]
        r = figures[level]
        assert (r.clusters, r.members, r.largest) == (len(sizes), sum(sizes), max(sizes, default=0))
        assert r.middle == (np.median(sizes) if sizes else None)
    healthy = linkage.first_healthy(linkage.sweep(found, nodes, "id", levels), 0.5).first()
    assert healthy.level == min(x for x in levels if figures[x].clusters and figures[x].share < 0.5)


def test_many_copies_merge_at_once(spark):
    df = spark.range(3000).select(F.col("id"), F.lit(0).alias("idx"), F.lit(1.0).alias("weight"))
    found = linkage.merges(df, "id", 0.5)
    assert found.count() == 2999 and found.where("parent <> 0 or similarity <> 1").isEmpty()


def test_empty(spark):
    none = spark.createDataFrame([], "id long, idx int, weight double")
    assert linkage.merges(none, "id", 0.5).collect() == [] and vectors.similar_pairs(none, "id", 0.5).collect() == []
