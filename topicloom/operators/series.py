"""Time series of topics: zero-filled counts, bursts, growth curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def zero_filled(rows: DataFrame, topic: str, slice_: str) -> DataFrame:
    """(topic, slice, n, total): every topic has every slice of the corpus; rows without a slice count nowhere."""
    dated = rows.where(F.col(slice_).isNotNull())
    totals = dated.groupBy(slice_).agg(F.count(F.lit(1)).alias("total"))
    counts = dated.groupBy(topic, slice_).agg(F.count(F.lit(1)).alias("n"))
    # slices are few (a calendar); topics meet them without a cross join by exploding the slices' list
    spine = totals.agg(F.collect_list(F.struct(slice_, "total")).alias("s"))
    topics = dated.select(topic).distinct()
    return topics.join(F.broadcast(spine)).select(topic, F.inline("s")).join(counts, [topic, slice_], "left").na.fill(0, ["n"])


def series(filled: DataFrame, topic: str, slice_: str) -> DataFrame:
    """(topic, slices, counts, totals) in slice order."""
    ordered = F.array_sort(F.collect_list(F.struct(slice_, "n", "total")))
    rows = filled.groupBy(topic).agg(ordered.alias("x"))
    return rows.select(topic, F.col(f"x.{slice_}").alias("slices"), F.col("x.n").cast("array<double>").alias("counts"), F.col("x.total").cast("array<double>").alias("totals"))


def bursts(rows: DataFrame, s: float = 2.0, gamma: float = 1.0) -> DataFrame:
    """rows with p0, p1, states, weights, max_weight, total_weight of counts against totals: the cheapest path of a
    two-state automaton. Ties stay in their state, the last slice's tie is the base state, a start in either state is free."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    rows = rows.withColumns({"_n": F.size("counts"), "_r": total(F.col("counts")), "_d": total(F.col("totals"))})
    rows = rows.withColumn("p0", F.when((F.col("_n") >= 2) & (F.col("_d") > 0) & (F.col("_r") > 0), F.col("_r") / F.col("_d")))
    rows = rows.withColumn("p1", F.least(F.col("p0") * s, F.lit(1 - 1e-9))).withColumn("_live", F.coalesce(F.col("p1") > F.col("p0"), F.lit(False)))
    cost = lambda p: f"-(r * ln(least(greatest({p}, 1e-12D), 1 - 1e-12D)) + (d - r) * ln(1 - least(greatest({p}, 1e-12D), 1 - 1e-12D)))"
    rows = rows.withColumn("_c", F.expr(f"case when _live then zip_with(counts, totals, (r, d) -> struct({cost('p0')} as c0, {cost('p1')} as c1)) end"))
    rows = rows.withColumn("_tau", gamma * F.log(F.greatest(F.col("_n"), F.lit(2)).cast("double")))
    # forward: cost of each state, and for each slice the states that they came from (b0, b1)
    rows = rows.withColumn(
        "_f",
        F.expr(
            "aggregate(slice(_c, 2, greatest(_n - 1, 0)), struct(_c[0].c0 as b0, _c[0].c1 as b1, cast(array() as array<struct<f0:int,f1:int>>) as back),"
            " (a, c) -> struct(least(a.b0, a.b1 + _tau) + c.c0 as b0, least(a.b1, a.b0 + _tau) + c.c1 as b1,"
            " concat(a.back, array(struct(if(a.b0 <= a.b1 + _tau, 0, 1) as f0, if(a.b1 <= a.b0 + _tau, 1, 0) as f1))) as back))"
        ),
    )
    rows = rows.withColumn("_last", F.expr("if(_f.b0 <= _f.b1, 0, 1)"))
    path = F.expr("reverse(aggregate(reverse(_f.back), array(_last), (p, b) -> concat(p, array(if(element_at(p, -1) = 0, b.f0, b.f1)))))")
    rows = rows.withColumn("states", F.when(F.col("_live"), path).otherwise(F.array_repeat(F.lit(0), F.col("_n"))))
    rows = rows.withColumn("weights", F.when(F.col("_live"), F.expr("zip_with(_c, states, (c, s) -> if(s = 1, greatest(c.c0 - c.c1, 0D), 0D))")).otherwise(F.array_repeat(F.lit(0.0), F.col("_n"))))
    rows = rows.withColumn("max_weight", F.coalesce(F.array_max("weights"), F.lit(0.0))).withColumn("total_weight", total(F.col("weights")))
    return rows.drop("_n", "_r", "_d", "_live", "_c", "_tau", "_f", "_last")


#: The grid of a logistic curve's ceiling (multiples of what was seen) and growth rate.
CEILINGS = [1.0 + 0.1 * k for k in range(20)] + [3.0 + 0.5 * k for k in range(35)]
RATES = [0.2 + 0.1 * k for k in range(29)]


def maturity(rows: DataFrame, topic: str) -> DataFrame:
    """(topic, maturity, fit): where the last slice lies on the best logistic curve of the cumulative counts.

    A curve's squared error is y.y - 2K y.L + K^2 L.L for the unit curve L, so each (rate, inflection) needs
    two sums, and the best K follows; the least ceiling wins ties. Series too short, flat or unfit are (0.5, 0).
    """
    rows = rows.withColumn("_cum", F.expr("transform(sequence(1, size(counts)), i -> aggregate(slice(counts, 1, i), 0D, (a, x) -> a + x))"))
    rows = rows.withColumn("_y", F.filter("_cum", lambda x: x > 0)).withColumn("_n", F.size("_y"))
    rows = rows.withColumn("_mean", F.expr("aggregate(_y, 0D, (a, x) -> a + x) / greatest(_n, 1)")).withColumn("_tot", F.expr("aggregate(_y, 0D, (a, x) -> a + (x - _mean) * (x - _mean))"))
    rows = rows.withColumn("_yy", F.expr("aggregate(_y, 0D, (a, x) -> a + x * x)"))
    fit = rows.where((F.size("counts") >= 4) & (F.col("_n") >= 4) & (F.col("_tot") > 0)).select(topic, "_y", "_n", "_tot", "_yy")
    grid = fit.withColumn("rate", F.explode(F.array(*[F.lit(r) for r in RATES]))).withColumn("t0", F.explode(F.expr("transform(sequence(0, 6 * _n - 1), k -> -_n + k * 0.5D)")))
    curve = "1 / (1 + exp(-rate * (i - t0)))"
    sums = grid.select(topic, "_y", "_tot", "_yy", F.expr(f"aggregate(transform(_y, (x, i) -> x * {curve}), 0D, (a, x) -> a + x)").alias("yl"), F.expr(f"aggregate(transform(_y, (x, i) -> pow({curve}, 2D)), 0D, (a, x) -> a + x)").alias("ll"))
    ceilings = F.array(*[F.lit(c) for c in CEILINGS])
    errors = sums.select(topic, "_tot", F.posexplode(F.transform(ceilings, lambda c: F.col("_yy") - 2 * c * F.element_at("_y", -1) * F.col("yl") + F.pow(c * F.element_at("_y", -1), F.lit(2.0)) * F.col("ll"))).alias("k", "sse"))
    best = errors.groupBy(topic, "_tot", "k").agg(F.min("sse").alias("sse")).withColumn("r2", F.round(1 - F.col("sse") / F.col("_tot"), 12))
    best = best.groupBy(topic).agg(F.max_by(F.struct("r2", "k"), F.struct("r2", -F.col("k"))).alias("b"))
    fitted = best.select(topic, F.when(F.col("b.r2") >= 0, 1 / F.element_at(ceilings, F.col("b.k") + 1)).otherwise(F.lit(0.5)).alias("maturity"), F.when(F.col("b.r2") >= 0, F.col("b.r2")).otherwise(F.lit(0.0)).alias("fit"))
    return rows.select(topic).join(fitted, topic, "left").na.fill({"maturity": 0.5, "fit": 0.0})


def cumulative(filled: DataFrame, topic: str, slice_: str) -> DataFrame:
    """Running counts from the first slice that has any."""
    upto = F.sum("n").over(Window.partitionBy(topic).orderBy(slice_))
    return filled.withColumn("cumulative", upto).where("cumulative > 0")


def slice_totals(rows: DataFrame, slice_: str) -> DataFrame:
    """(slice, total, share, place): the rows of each slice, null ones left out, as a share of all and in order; slices are a calendar."""
    totals = rows.where(F.col(slice_).isNotNull()).groupBy(slice_).agg(F.count(F.lit(1)).alias("total"))
    return totals.withColumn("share", F.col("total") / F.sum("total").over(Window.partitionBy(F.lit(0)))).withColumn("place", F.row_number().over(Window.orderBy(slice_)))


def crosstab(rows: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, of_row, of_column): counts of every row and column that occurs, zeros included, beside the marginals. Long, not wide, so that columns may be many."""
    counts = rows.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    of_row, of_column = counts.groupBy(row).agg(F.sum("n").alias(f"of_{row}")), counts.groupBy(column).agg(F.sum("n").alias(f"of_{column}"))
    # the calendar goes beside every column as one list
    every = of_row.agg(F.collect_list(F.struct(row, f"of_{row}")).alias("_r"))
    grid = of_column.join(F.broadcast(every)).select(column, f"of_{column}", F.inline("_r"))
    met = grid[row].eqNullSafe(counts[row]) & grid[column].eqNullSafe(counts[column])
    return grid.join(counts, met, "left").select(grid[row], grid[column], F.coalesce("n", F.lit(0)).alias("n"), f"of_{row}", f"of_{column}")
