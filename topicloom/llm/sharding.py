"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seeded hash and ranked; rank r of n becomes the fraction
(r - p) / n with a phase p of the source; all rows sorted by fraction are cut into equal runs, so each shard holds every source in
the corpus's proportion and counts differ by one at most. Both ranks are found without ever sorting a
source, or the table, in one task: rows fall into buckets of the (uniform) hash or fraction, bucket
counts are summed up to offsets, and only a bucket's rows are sorted together.

Null texts count as empty, null sources are a stratum of their own. The hash is of doc_id, text and the row's number
among equal ones, so that these are dealt out, too; equal rows are interchangeable. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import beside_hot, cut, ranked, told_apart

SHARDS, SEED, BUCKET_ROWS, MAX_BUCKETS = 16, 17, 20_000, 1 << 16


def shards(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law has none) of each row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(docs["source"].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), docs["source"].cast("string"))).alias("stratum"),
    )
    rows = cut(rows)
    rows = cut(told_apart(rows, ["doc_id", "text_crc32", "size"], "nth"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", "nth"))
    total = rows.count()
    buckets = max(16, min(MAX_BUCKETS, total // BUCKET_ROWS))
    rows = rows.withColumn("hb", F.pmod("h", F.lit(buckets)).cast("int"))
    # sources start at phases dealt evenly over [0, 1), so that sources of a few rows do not meet in the middle
    sizes = cut(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("of")).withColumn("sh", F.xxhash64(F.lit(seed), "stratum")))
    strata = sizes.withColumn("all", F.lit(0)).withColumn("sb", F.pmod(F.shiftrightunsigned("sh", 48), F.lit(1 << 16)).cast("int"))
    sizes = ranked(strata, ["all", "sb"], ["sh", "stratum"], "s").withColumn("phase", (F.col("s") - 0.5) / F.lit(float(max(1, sizes.count())))).select("stratum", "of", "phase")
    dealt = ranked(rows, ["stratum", "hb"], ["h", "doc_id", "text_crc32", "size"], "rank")
    dealt = beside_hot(dealt, sizes, "stratum")
    dealt = dealt.withColumn("fraction", (F.col("rank") - F.col("phase")) / F.col("of"))
    dealt = dealt.withColumn("all", F.lit(0)).withColumn("fb", F.floor(F.col("fraction") * buckets).cast("int"))
    placed = ranked(dealt, ["all", "fb"], ["fraction", "stratum", "h", "doc_id", "text_crc32", "size"], "place")
    place = F.col("place").cast("long") - 1
    placed = placed.withColumn("shard", F.expr(f"cast((place - 1) * {n_shards} div {max(1, total)} as int)"))
    first = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (place - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("stratum").substr(2, 1 << 30).alias("source"))
