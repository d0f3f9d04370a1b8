"""Exact top-k inner products by columnar branch and bound.

Vectors become integers, floor(256 x). Queries and candidates are dealt over a grid: a query block is
copied to every column of cells, a candidate block to every row, so each pair of blocks meets in one
cell of bounded size and no side is broadcast. A cell keeps its candidates in vertical layout (a row a
dimension). For a query it adds up the products block of dimensions by block; after each, a candidate
whose partial score plus the greatest remainder that Cauchy-Schwarz allows (the product of both
remaining norms) is under the k-th best known is dropped, and the survivors are compacted. The cells'
bests meet per query in one last top k. Ties go to the smaller vec_id.

Vectors that are null or hold null or non-finite components take no part; vectors of different lengths
do not meet. Rows that share the query's vec_id count as its own; each row of a repeated vec_id is a query and
has its own ranks. Components beyond 64 bits saturate; vectors of norm 2^31 or more are scored by whole numbers of
any size, and scores beyond 64 bits saturate, too. An empty table, or one without
queries, gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import cut, session

K, SCALE, QUERY_EVERY, BLOCK_DIMS = 5, 256, 50, 8
#: Rows of a cell: what bounds a task's memory.
CELL_QUERIES, CELL_ROWS = 2_000, 20_000


def cell_top_k(query_ids, queries, ids, vectors, k: int = K, block: int = BLOCK_DIMS, names=None):
    """(query or its name, id, score) of the k best of each query among `vectors`, by (score desc, id asc)."""
    out_q, out_i, out_s = [], [], []
    n, dims = vectors.shape
    columns = np.ascontiguousarray(vectors.T)  # vertical layout
    edges = list(range(0, dims, block)) + [dims]
    squares = np.square(columns, dtype=np.int64)
    tails = [np.sqrt(squares[e:].sum(0, dtype=np.int64)) for e in edges]  # norms of what remains from each edge on
    seed = min(n, max(64, 8 * k))
    probe = np.argpartition(-tails[0], seed - 1)[:seed] if n > seed else np.arange(n)
    for q_id, q, name in zip(query_ids, queries, query_ids if names is None else names):
        own = ids == q_id
        sample = probe[~own[probe]]
        first = np.sort(q @ columns[:, sample])
        least = first[-k] if len(first) >= k else None
        live, score = np.flatnonzero(~own), None
        score = np.zeros(len(live), np.int64)
        for e, (a, b) in enumerate(zip(edges, edges[1:])):
            score = score + q[a:b] @ (columns[a:b, live] if len(live) < n else columns[a:b])
            rest = math.sqrt(float(np.square(q[b:]).sum()))
            bound = score + rest * tails[e + 1][live]
            if len(score) > k:
                # a partial score less the greatest remainder is certain: the k-th of those is a valid bar as well
                sure = np.partition(score - rest * tails[e + 1][live], -k)[-k] - 1
                least = sure if least is None else max(least, sure)
            if least is not None:
                keep = bound + 1 >= least
                if not keep.all():
                    live, score = live[keep], score[keep]
        best = np.lexsort((ids[live], -score))[:k]
        out_q += [name] * len(best)
        out_i += ids[live[best]].tolist()
        out_s += score[best].tolist()
    return out_q, out_i, out_s


def exact_top_k(query_ids, queries, ids, vectors, k: int = K, names=None):
    """As cell_top_k, for vectors whose products may pass 64 bits: (query, id, score), scores cut to 64 bits after they are compared."""
    out = []
    every = [list(map(int, v)) for v in vectors]
    for q_id, q, name in zip(query_ids, queries, query_ids if names is None else names):
        q = list(map(int, q))
        scores = [(-sum(map(int.__mul__, q, v)), int(i)) for i, v in zip(ids, every) if i != q_id]
        out += [(name, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for s, i in heapq.nsmallest(k, scores)]
    return tuple(zip(*out)) if out else ((), (), ())


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vec_id divisible by query_every its k best other rows."""
    session(vectors.sparkSession)
    x = F.col("embedding").cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    rows = cut(rows.withColumn("dims", F.size("v"))).withColumn("row", F.monotonically_increasing_id())
    n, nq = rows.count(), rows.where(F.col("vec_id") % query_every == 0).count()
    across, down = max(1, -(-n // CELL_ROWS)), max(1, -(-nq // CELL_QUERIES))
    across = max(across, min(-(-n // 1000), -(-vectors.sparkSession.sparkContext.defaultParallelism // down)))
    queries = rows.where(F.col("vec_id") % query_every == 0).select("*", F.pmod(F.xxhash64("row"), F.lit(down)).cast("long").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))).alias("j"), F.lit(True).alias("is_query"))
    others = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))).alias("i"), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(across)).cast("long").alias("j"), F.lit(False).alias("is_query"))

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        q, c = cell[cell["is_query"]], cell[~cell["is_query"]]
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []}).astype("int64")
        stack = lambda s: np.stack([np.asarray(v, np.int64) for v in s])
        ids, rows, wanted, others = q["vec_id"].to_numpy(), q["row"].to_numpy(), stack(q["v"]), stack(c["v"])
        theirs = c["vec_id"].to_numpy()
        large = lambda x: np.square(x.astype(float)).sum(1) >= float(1 << 62)
        far, wide, out = large(wanted), large(others), []
        # a repeated vec_id is as many queries: the row names each
        for of, queries_, among in ((cell_top_k, ~far, ~wide), (exact_top_k, ~far, wide), (exact_top_k, far, wide | True)):
            mine = np.flatnonzero(queries_)
            if len(mine) and among.any():
                got, got_i, got_s = of(ids[mine], wanted[mine], theirs[among], others[among], k, names=mine.tolist())
                out += [(int(ids[x]), int(rows[x]), int(y), int(z)) for x, y, z in zip(got, got_i, got_s)]
        return pd.DataFrame(out, columns=["query_id", "row", "vec_id", "score"]).astype("int64")

    found = queries.unionByName(others).groupBy("dims", "i", "j").applyInPandas(run, "query_id long, row long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
