"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import beside_hot, cut, gathered


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) longs, undirected -> (node, root): root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour (an aggregate that combines before the
    shuffle), flattens the hooks by pointer jumping, and contracts the edges onto the roots; a
    component at least halves in a round, so there are logarithmically many. Edges and labels stay
    distributed, in as many tasks as the number of edges asks for; only their counts reach the driver. A centre has all its group's edges, but the other side of each join has a node
    once, so that adaptive execution splits its partition. Self-loops and repeated edges are harmless;
    nulls are dropped; an empty list gives an empty table.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select(F.col("u").cast("long"), F.col("v").cast("long"))
    live = cut(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    # edges only get fewer, and there are two nodes an edge at most
    size = 2 * live.count()
    live, labels = gathered(live, size), None
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        both = live.union(live.select("v", "u"))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("root"))
        hooks = cut(gathered(hooks, size))
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = beside_hot(hooks, up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved"))
            jumped = cut(gathered(jumped, size))
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            labels = cut(gathered(beside_hot(labels, up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), size))
        at_u, at_v = hooks.select(F.col("node").alias("u"), F.col("root").alias("ru")), hooks.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        moved = live.join(at_u, "u").join(at_v, "v").where("ru <> rv")
        live = cut(gathered(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), size))
    else:
        raise RuntimeError("components did not converge")
    if labels is None:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return labels
