"""Exact ranks and quantiles of groups of any size.

Rows are counted by value (an aggregate that combines before it shuffles), the counts are dealt out in ranges, and a
value's place is the sum of what the ranges before hold and of what comes before it in its own. A quantile is selected
from the places. No window and no buffer ever holds a group.

Nulls and groups: a null value has no place and is not counted; a null group is a group of its own. NaN is the greatest value. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.operators.shared import cut


def value_places(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, ties, below, total): of each different value of a group how many rows have it, have less, and are in the group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("ties"))
    ranged = cut(counts.repartitionByRange(*[F.col(c) for c in [*by, value]]).withColumn("_part", F.spark_partition_id()))
    # a row for each range and group in it: of a group that fills many ranges there are as many as ranges
    sums = ranged.groupBy("_part", *by).agg(F.sum("ties").alias("_sum"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_sum").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("_part", *by, before.alias("_before"), F.sum("_sum").over(whole).alias("total"))
    inside = Window.partitionBy("_part", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
    own = sums.select(F.col("_part").alias("_range"), *[F.col(c).alias(f"_{c}") for c in by], "_before", "total")
    met = placed["_part"] == own["_range"]
    for c in by:
        met = met & placed[c].eqNullSafe(own[f"_{c}"])
    return placed.join(own, met).select(*by, value, "ties", (F.col("_before") + F.col("_inside")).alias("below"), "total")


def _beside(rows: DataFrame, places: DataFrame, by: list[str], value: str, rank: Column, name: str) -> DataFrame:
    found = places.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate([*by, value])], rank.alias(name))
    met = F.lit(True)
    for k, c in enumerate([*by, value]):
        met = met & rows[c].eqNullSafe(found[f"_{k}"])
    return rows.join(found, met, "left").drop(*[f"_{k}" for k in range(len(by) + 1)])


def percentile_ranks(rows: DataFrame, value: str, name: str, by: list[str] | None = None) -> DataFrame:
    """rows with `name`: the mean place of a value's ties, scaled to [0, 1]; of a lone value 0.5."""
    by = by or []
    rank = F.when(F.col("total") == 1, F.lit(0.5)).otherwise((F.col("below") + (F.col("ties") - 1) / F.lit(2.0)) / F.greatest(F.col("total") - 1, F.lit(1)))
    return _beside(rows, value_places(rows, by, value), by, value, rank, name)


def shares_at_or_below(rows: DataFrame, value: str, name: str, by: list[str] | None = None) -> DataFrame:
    """rows with `name`: the share of the group's values up to this one; 0.5 for all where the group has one value only."""
    by = by or []
    share = F.when(F.col("ties") == F.col("total"), F.lit(0.5)).otherwise((F.col("below") + F.col("ties")) / F.col("total"))
    return _beside(rows, value_places(rows, by, value), by, value, share, name)


def quantiles(rows: DataFrame, value: str, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by, a column for each share): linear between the two values about the share's place. One row of a group with values; without groups one row, of nulls if there are no values."""
    by = by or []
    places = value_places(rows, by, value)
    x = F.col(value).cast("double")

    def at(share: float) -> Column:
        place = (F.col("total") - 1) * F.lit(float(share))
        holds = lambda p: (F.col("below") <= p) & (p < F.col("below") + F.col("ties"))
        low, high = F.max(F.when(holds(F.floor(place)), x)), F.max(F.when(holds(F.ceil(place)), x))
        return low + (high - low) * F.max(place - F.floor(place))

    return places.groupBy(*by).agg(*[at(q).alias(name) for name, q in shares.items()])


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with `name`: their places, from 1, in an order without ties: rows are dealt out in ranges, and a range starts after those before it."""
    ranged = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # as many rows as ranges
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = sums.select("_part", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(F.broadcast(firsts), "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")
