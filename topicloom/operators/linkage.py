"""Average linkage of any number of vectors, as a table of merges that can be cut at every level.

The similarity of two groups is the mean inner product of their members, which is the inner product of their means. Average linkage is
reducible: a merged group is no nearer to a third than the nearer of its parts was. So all pairs of groups that are each
other's nearest can merge at once, and what a merged group is near to, its parts were near to: the pairs that reach the
threshold are an edge table that is found once and then only shrinks. A round merges the reciprocal pairs and renews the edges
that they had, from their parts' edges where these are all there (Lance and Williams), else from the groups' means. Parts
of the graph with at most LOCAL groups are finished in a task each; no merge leaves a part. Equal vectors merge before the rounds.

A merge (child, parent, similarity, size) takes the group whose least id is `child` into that whose least id is `parent`, which
is smaller. A group is a child once at most, so the merges are a forest, and since no later merge of a group is
more similar than an earlier one, the clusters at any level are its trees over the merges of that level or more. Ties go to
smaller ids. Zero vectors (without entries) are in no group. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators import graph, vectors
from topicloom.operators.shared import stored

#: Groups of a part of the graph that is finished in one task; indices that it multiplies at once.
LOCAL, STRIP = 2048, 4096
#: Rounds from one look at the parts to the next.
CALLED = 3
MERGE = "child {0}, parent {0}, similarity double, size long"


def merges_of(ids: list, sims: np.ndarray, sizes: np.ndarray, threshold: float) -> list[tuple]:
    """The merges of groups in order of id with their mean similarities: the most similar pair first, of ties that of the smallest ids."""
    sims, sizes, out = sims.astype(float).copy(), sizes.astype(float).copy(), []
    np.fill_diagonal(sims, -np.inf)
    best = sims.argmax(1) if len(sims) else np.empty(0, int)
    top = sims[np.arange(len(sims)), best]
    while len(sims) > 1:
        i = int(top.argmax())
        if not top[i] >= threshold:
            break
        i, j = sorted((i, int(best[i])))
        out.append((ids[j], ids[i], float(sims[i, j]), int(sizes[i] + sizes[j])))
        merged = (sizes[i] * sims[i] + sizes[j] * sims[j]) / (sizes[i] + sizes[j])
        sims[i], sims[:, i] = merged, merged
        sims[i, i] = -np.inf
        sims[j], sims[:, j] = -np.inf, -np.inf
        sizes[i] += sizes[j]
        lost = np.union1d(np.flatnonzero((best == i) | (best == j)), [i, j])
        best[lost] = sims[lost].argmax(1)
        top[lost] = sims[lost, best[lost]]
        nearer = np.flatnonzero((sims[:, i] > top) | ((sims[:, i] == top) & (best > i) & (top > -np.inf)))
        best[nearer], top[nearer] = i, sims[nearer, i]
    return out


def _finished(groups: DataFrame, kind: str, threshold: float) -> DataFrame:
    """groups (part, node, size, v): the merges within each part."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        rows = np.repeat(np.arange(len(part)), [len(v) for v in part["v"]])
        idx = np.concatenate([[e["idx"] for e in v] for v in part["v"]])
        weights = np.concatenate([[e["weight"] for e in v] for v in part["v"]])
        used, column = np.unique(idx, return_inverse=True)
        sims = np.zeros((len(part), len(part)))
        for a in range(0, len(used), STRIP):
            here = (column >= a) & (column < a + STRIP)
            dense = np.zeros((len(part), min(STRIP, len(used) - a)))
            dense[rows[here], column[here] - a] = weights[here]
            sims += dense @ dense.T
        out = merges_of(part["node"].tolist(), sims, part["size"].to_numpy(), threshold)
        return pd.DataFrame(out, columns=["child", "parent", "similarity", "size"])

    return groups.select("part", "node", "size", "v").groupBy("part").applyInPandas(run, MERGE.format(kind))


def _entries(groups: DataFrame) -> DataFrame:
    return groups.select("node", F.inline("v"))


def _round(groups: DataFrame, edges: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """groups (node, size, v) and edges (a, b, similarity) -> the reciprocal pairs' merges, and both after them."""
    both = edges.union(edges.select("b", "a", "similarity"))
    # doubles are ordered after rounding, so that a similarity is one number from both of its ends
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.max("similarity").alias("s"))
    nearest = both.join(nearest, (both["a"] == nearest["node"]) & (both["similarity"] == nearest["s"])).groupBy("node").agg(F.min("b").alias("to"), F.max("s").alias("similarity"))
    back = nearest.select(F.col("node").alias("to"), F.col("to").alias("back"))
    pairs = nearest.join(back, "to").where((F.col("node") == F.col("back")) & (F.col("node") < F.col("to"))).select(F.col("to").alias("child"), F.col("node").alias("parent"), "similarity")
    sizes = groups.select(F.col("node").alias("child"), F.col("size").alias("n_child"))
    pairs = pairs.join(sizes, "child").join(sizes.select(F.col("child").alias("parent"), F.col("n_child").alias("n_parent")), "parent")
    pairs = stored(pairs.select("child", "parent", "similarity", (F.col("n_child") + F.col("n_parent")).alias("size")))
    moved = pairs.select(F.col("child").alias("node"), F.col("parent").alias("to"), F.col("size").alias("total")).union(pairs.select("parent", "parent", "size"))
    # the merged groups' means
    parts = groups.join(moved, "node")
    means = parts.select(F.col("to").alias("node"), "total", "size", F.inline("v")).groupBy("node", "total", "idx").agg((F.sum(F.col("weight") * F.col("size")) / F.col("total")).alias("weight"))
    means = means.groupBy("node", F.col("total").alias("size")).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("v"))
    after = stored(groups.join(moved, "node", "left_anti").unionByName(means))
    # their edges: a mean over the parts' edges if there is one for each pair of parts
    size = groups.select("node", "size")
    named = edges
    for end in ("a", "b"):
        to = moved.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to")).withColumn(f"{end}_parts", F.lit(2))
        named = named.join(to, end, "left").join(size.select(F.col("node").alias(end), F.col("size").alias(f"{end}_size")), end)
        named = named.withColumn(f"{end}_to", F.coalesce(f"{end}_to", end)).withColumn(f"{end}_parts", F.coalesce(f"{end}_parts", F.lit(1)))
    named = named.where(F.col("a_to") != F.col("b_to"))
    still = named.where("a_parts = 1 and b_parts = 1").select("a", "b", "similarity")
    flip = F.col("a_to") > F.col("b_to")
    touched = named.where("a_parts = 2 or b_parts = 2").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"), (F.col("a_size") * F.col("b_size")).alias("w"), "similarity", (F.col("a_parts") * F.col("b_parts")).alias("parts"), flip.alias("flip"))
    sums = stored(touched.groupBy("a", "b").agg((F.sum(F.col("w") * F.col("similarity")) / F.sum("w")).alias("similarity"), (F.count(F.lit(1)) == F.max("parts")).alias("whole")))
    there = _entries(after.join(sums.where("not whole").select(F.col("a").alias("node")).union(sums.where("not whole").select("b")).distinct(), "node", "left_semi"))
    again = sums.where("not whole").select("a", "b").join(there.select(F.col("node").alias("a"), "idx", F.col("weight").alias("wa")), "a").join(there.select(F.col("node").alias("b"), "idx", F.col("weight").alias("wb")), ["b", "idx"])
    again = again.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("similarity"))
    renewed = sums.where("whole").select("a", "b", "similarity").unionByName(again).withColumn("similarity", F.round("similarity", 12)).where(F.col("similarity") >= threshold)
    return pairs, after, stored(still.unionByName(renewed))


def merges(rows: DataFrame, id_: str, threshold: float, local: int = LOCAL) -> DataFrame:
    """(child, parent, similarity, size) of sparse vectors (id, idx, weight) down to the threshold."""
    kind = rows.schema[id_].dataType.simpleString()
    whole = stored(rows.groupBy(F.col(id_).alias("id")).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("v")))
    groups = stored(whole.groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("size")).select("node", "size", "v"))
    own = F.aggregate("v", F.lit(0.0), lambda s, e: s + e["weight"] * e["weight"])
    twins = whole.join(groups.select("node", "v", "size"), "v").where(F.col("id") != F.col("node")).select(F.col("id").alias("child"), F.col("node").alias("parent"), own.alias("similarity"), "size")
    twins = twins.where(F.col("similarity") >= threshold)
    edges = stored(vectors.similar_pairs(_entries(groups), "node", threshold).withColumn("similarity", F.round("similarity", 12)))
    done = [stored(twins.select("child", "parent", "similarity", "size"))]
    step = -1
    while not edges.isEmpty():
        step += 1
        if step % CALLED:
            found, groups, edges = _round(groups, edges, threshold)
            done.append(found)
            continue
        nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        parts = graph.component_labels(nodes, edges, "node").withColumnRenamed("component", "part")
        small = parts.join(parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= local), "part", "left_semi")
        placed = stored(groups.join(small, "node"))
        done.append(stored(_finished(placed, kind, threshold)))
        # what a task has finished leaves the table
        edges = stored(edges.join(small.select(F.col("node").alias("a")), "a", "left_anti"))
        if edges.isEmpty():
            break
        groups = groups.join(parts.join(small, "node", "left_anti"), "node", "left_semi")
        found, groups, edges = _round(groups, edges, threshold)
        done.append(found)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more.select(*out.columns))
    return out


def clusters(found: DataFrame, nodes: DataFrame, id_: str, levels: list[float], max_rounds: int = 60) -> DataFrame:
    """(level, id, cluster) of nodes (id) at each level: the least id that the merges of that similarity or more reach, by pointer jumping."""
    spark = found.sparkSession
    at = spark.createDataFrame([(float(x),) for x in levels], "level double")
    up = nodes.select(F.col(id_).alias("node")).distinct().join(F.broadcast(at)).join(found.select(F.col("child").alias("node"), "parent", "similarity"), "node", "left")
    up = stored(up.select("level", "node", F.when(F.col("similarity") >= F.col("level"), F.col("parent")).otherwise(F.col("node")).alias("to")))
    for _ in range(max_rounds):
        over = up.select("level", F.col("node").alias("to"), F.col("to").alias("next"))
        new = stored(up.join(over, ["level", "to"]).select("level", "node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
        up = new.drop("moved")
        if new.where("moved").isEmpty():
            return up.select("level", F.col("node").alias(id_), F.col("to").alias("cluster"))
    raise RuntimeError("the merges are no forest")


def sweep(found: DataFrame, nodes: DataFrame, id_: str, levels: list[float], min_size: int = 2) -> DataFrame:
    """A row for each level: (level, clusters, members, largest, middle, share): clusters of min_size or more, their members, the largest and the median size, and the largest's share of the members. One table of merges serves all levels."""
    sizes = clusters(found, nodes, id_, levels).groupBy("level", "cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_size)
    figures = sizes.groupBy("level").agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("members"), F.max("n").alias("largest"), F.median("n").alias("middle"))
    every = found.sparkSession.createDataFrame([(float(x),) for x in levels], "level double")
    figures = every.join(figures, "level", "left").na.fill(0, ["clusters", "members", "largest"])
    return figures.withColumn("share", F.when(F.col("members") > 0, F.col("largest") / F.col("members")))


def first_healthy(figures: DataFrame, most: float = 0.25) -> DataFrame:
    """The row of the lowest level at which clusters exist and the largest holds less than `most` of the members."""
    return figures.where((F.col("clusters") > 0) & (F.col("share") < most)).orderBy("level").limit(1)
