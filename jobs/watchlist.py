"""The watch list of a scan: which topics rise, ranked, classed and written by run.

    python -m jobs.watchlist LINEITEM PART SUPPLIER OUT RUN [--config jobs/watchlist.json]

A topic is an item of the catalogue (part), its documents are the line items, dated by shipping year, their sources the return
flags and their actors the suppliers' nations. Of each topic the job takes the yearly counts with zeros, the growth between the
first and last years with a burst's score, the share of the corpus, and the mean entropy of sources and actors. Their percentile
ranks among all topics, weighted, are the emergence; the medians of share and growth class its signal.

    OUT/topics     run_id    the ranked topics                    Parquet
    OUT/shortlist  run_id    the first `shortlist` of them        CSV
    OUT/summary    run_id    a row of figures for each signal     JSON

Each run overwrites its own partitions and leaves other runs': a run repeated over the same tables leaves the same rows. A run
that finds no topic at all writes nothing and leaves what the run had.
Ranks and medians come from counts by value in ranges, so topics may be as many as the catalogue has items. Rows without a date
count nowhere; items that never sold are no topics; ties go to the smaller topic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, log, settings
from topicloom.functions import stats
from topicloom.operators import diagnostics, entropy, ranks, series
from topicloom.operators.shared import cut, stored


@dataclass
class Settings:
    """weights: of the attributes in the emergence; burst: ratio of the states and cost of a change; shortlist: topics of the CSV."""

    weights: dict = field(default_factory=lambda: {"growth": 0.4, "share": 0.25, "uncertainty": 0.15, "worth": 0.2})
    burst_ratio: float = 2.0
    burst_cost: float = 0.5
    shortlist: int = 25


def documents(items: DataFrame, parts: DataFrame, suppliers: DataFrame) -> DataFrame:
    """(topic, slice, source, actor, worth) of the line items of the catalogue."""
    rows = items.where(F.col("l_shipdate").isNotNull()).select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("slice"), F.col("l_returnflag").alias("source"), F.col("l_extendedprice").alias("worth"))
    rows = rows.join(parts.select(F.col("p_partkey").alias("topic")), F.col("l_partkey") == F.col("topic"))
    nations = suppliers.select("s_suppkey", F.col("s_nationkey").cast("string").alias("actor"))
    return rows.join(nations, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("topic", "slice", "source", "actor", "worth")


def attributes(docs: DataFrame, chosen: Settings) -> DataFrame:
    """(topic, documents, first_slice, last_slice, cagr, burst, growth, share, uncertainty, worth), rounded, so that equal ones tie."""
    line = series.series(series.zero_filled(docs, "topic", "slice"), "topic", "slice")
    burst = series.bursts(line, chosen.burst_ratio, chosen.burst_cost)
    held = F.filter(F.transform("slices", lambda s, i: F.when(F.get("counts", i) > 0, s)), lambda s: s.isNotNull())
    shares = F.aggregate(F.zip_with("counts", "totals", lambda c, t: c / t), F.lit(0.0), lambda a, x: a + x) / F.size("counts")
    cagr, score = F.round(stats.cagr(F.col("counts")), 6), F.round(stats.burst_score(F.col("states"), F.col("max_weight")), 6)
    shape = burst.select("topic", F.array_min(held).alias("first_slice"), F.array_max(held).alias("last_slice"), cagr.alias("cagr"), score.alias("burst"), F.round(shares, 9).alias("share"))
    shape = shape.withColumn("growth", F.round(stats.clip(0.6 * stats.squash(F.col("cagr")) + 0.4 * F.col("burst")), 6))
    # whole cents, so that equal means tie whatever the order of the sum
    basic = docs.groupBy("topic").agg(F.count(F.lit(1)).alias("documents"), (F.expr("sum(cast(round(worth * 100) as bigint)) div count(worth)") / 100).alias("worth"))
    mixed = entropy.mean_entropy(docs, "topic", ["source", "actor"]).select("topic", F.round("entropy", 6).alias("uncertainty"))
    return shape.join(basic, "topic").join(mixed, "topic")


def ranked(rows: DataFrame, chosen: Settings) -> DataFrame:
    """rows with emergence, signal and rank."""
    rows = cut(rows)
    middle = ranks.quantiles(rows, "share", {"cut_share": 0.5}).join(ranks.quantiles(rows, "growth", {"cut_growth": 0.5}))
    for name in chosen.weights:
        rows = ranks.percentile_ranks(rows, name, f"r_{name}")
    score = F.round(diagnostics.weighted({a: F.col(f"r_{a}") for a in chosen.weights}, chosen.weights), 6)
    rows = rows.withColumn("emergence", score).drop(*[f"r_{a}" for a in chosen.weights])
    rows = rows.join(F.broadcast(middle)).withColumn("signal", stats.signal_class(F.col("share"), F.col("growth"), F.col("cut_share"), F.col("cut_growth"))).drop("cut_share", "cut_growth")
    return ranks.numbered(rows, [F.desc("emergence"), F.asc("topic")], "rank")


def run(spark: SparkSession, lineitem: str, part: str, supplier: str, out: str, run_id: str, chosen: Settings | None = None) -> DataFrame:
    """Writes the run's partitions and returns its topics as they are read back."""
    chosen = chosen or Settings()
    items, parts, suppliers = (spark.read.parquet(p) for p in (lineitem, part, supplier))
    # joined once: each attribute reads what was kept
    docs = stored(documents(items, parts, suppliers), "watchlist")
    rows = ranked(attributes(docs, chosen), chosen).withColumn("run_id", F.lit(run_id))
    rows.sortWithinPartitions("rank").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{out}/topics")
    found = spark.read.schema(rows.schema).parquet(f"{out}/topics").where(F.col("run_id") == run_id)
    once = lambda df: df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    once(found.where(F.col("rank") <= chosen.shortlist).orderBy("rank")).option("header", "true").csv(f"{out}/shortlist")
    once(found.groupBy("run_id", "signal").agg(F.count(F.lit(1)).alias("topics"), F.sum("documents").alias("documents"), F.max("emergence").alias("highest"))).json(f"{out}/summary")
    log.info("run %s: %d line items, %d topics into %s", run_id, items.count(), found.count(), out)
    return found


if __name__ == "__main__":
    command("watchlist", "Ranked and classed topics of a run", {"lineitem": "Parquet", "part": "Parquet", "supplier": "Parquet", "out": "folder of the outputs", "run": "the run's id"}, lambda spark, a: run(spark, a.lineitem, a.part, a.supplier, a.out, a.run, settings(spark, Settings, a.config)))
