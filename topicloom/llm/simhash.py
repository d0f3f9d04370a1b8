"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its word shingles. The
index cuts the 64 bits into max_bits // 2 + 1 segments, so that two fingerprints at that distance or less
differ in one bit at most within some segment. Each segment has a table keyed by its value; a fingerprint is
at home under its own value and visits the values of the segment's Hamming ball of radius 1. Of two that
differ in one bit, the one that has it meets the other by clearing it, so only these members of the ball
are looked up. What meets is verified on the complete distance.

A value that is home to more than HOT fingerprints (a large group of near copies) is hot. All fingerprints
whose balls hold a hot value go by balls over all bits instead, enumerated on both sides: a point is within
half of max_bits of few fingerprints (65 of one bit), however many copies the corpus holds. The other buckets
hold HOT fingerprints at home and as many from each neighbouring value at most. A bucket yields no pairs, only
each member with the first one of those it reaches in the bucket.

Nulls and blank texts have fingerprint zero and link like any other. Rows that repeat a doc_id are rows
of their own; a null doc_id keeps its fingerprint and gets the component of it. An empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import beside_hot, cut, session, spread, text_column
from topicloom.llm.components import components

WORDS, SEED, BLOCK = 3, 42, 1 << 15
#: Fingerprints at home under one value of a segment, beyond which it is hot.
HOT, MOST_BITS = 256, 4


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """bytes.lower() folds A-Z only and bytes.split() parts at the six ASCII spaces, as the contract asks."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = list(zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(spans), BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans[k : k + BLOCK]], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id long, key long, fp long) of each row; key is the text's digest."""
    session(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "key", "fp"])

    text = text_column(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text")).mapInArrow(run, "doc_id long, key long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    ends = np.linspace(0, 64, max_bits // 2 + 2).astype(int).tolist()
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _ball(fps: DataFrame, max_bits: int, clearing: bool) -> DataFrame:
    """(fp, segment, value, home): home's row and the ball's others, those that clear a bit or all."""
    parts = segments(max_bits)
    radius = max_bits // len(parts)
    places = [(k, low, (1 << width) - 1, bit) for k, (low, width) in enumerate(parts) for bit in (0, *(1 << b for b in range(width if radius else 0)))]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("segment"), F.lit(low).alias("low"), F.lit(_signed(mask)).alias("mask"), F.lit(_signed(bit)).alias("bit"), F.lit(_signed(bit << low)).alias("there")) for k, low, mask, bit in places]))
    rows = fps.select("fp", each.alias("p")).select("fp", "p.*")
    if clearing:
        rows = rows.where((F.col("bit") == 0) | (F.col("fp").bitwiseAND(F.col("there")) != 0))
    value = F.expr("shiftrightunsigned(fp, low)").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("bit"))
    return rows.select("fp", "segment", value.alias("value"), (F.col("bit") == 0).alias("home"))


def _joined(max_bits: int):
    """Of buckets (homes, visitors): each fingerprint beside the first of those that it reaches there."""

    def run(batches):
        for batch in batches:
            out_u, out_v = [], []
            for homes, visitors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                every = np.array(homes + visitors, np.int64).view(np.uint64)
                a, b = np.nonzero(np.bitwise_count(every[: len(homes), None] ^ every[None, :]) <= max_bits)
                first, before = np.arange(len(every)), None
                while before is None or (before != first).any():
                    before = first.copy()
                    np.minimum.at(first, b, before[a])
                    np.minimum.at(first, a, first[b])
                other = np.flatnonzero(first != np.arange(len(every)))
                out_u.append(every[first[other]])
                out_v.append(every[other])
            u, v = (np.concatenate([np.empty(0, np.uint64), *x]).view(np.int64) for x in (out_u, out_v))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def links(fps: DataFrame, max_bits: int = 2, hot: int = HOT) -> DataFrame:
    """Different fingerprints (fp) -> (u, v): pairs whose components are those of all pairs at max_bits or less."""
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"max_bits from 0 to {MOST_BITS}")
    fps = spread(fps.select("fp"))
    homes = _ball(fps, max_bits, True).where("home").groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    crowded = cut(homes.select("segment", "value"))
    rows, met = _ball(fps, max_bits, True), None
    if not crowded.isEmpty():
        near = cut(_ball(fps, max_bits, False).join(crowded, ["segment", "value"], "left_semi").select("fp").distinct())
        masks = [sum(1 << b for b in bits) for k in range((max_bits + 1) // 2 + 1) for bits in combinations(range(64), k)]
        points = spread(near).select("fp", F.explode(F.array(*[F.lit(_signed(x)) for x in masks])).alias("flip"))
        points = points.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("point")).agg(F.collect_list("fp").alias("homes"))
        met = points.where("size(homes) > 1").select("homes", F.expr("cast(array() as array<bigint>)").alias("visitors"))
        # what is at home under a hot value, or visits one, is among these
        at_hot = cut(_ball(fps, max_bits, True).where("home").join(crowded, ["segment", "value"], "left_semi").select("fp", "segment"))
        rows = rows.join(at_hot, ["fp", "segment"], "left_anti").join(crowded, ["segment", "value"], "left_anti")
    buckets = rows.groupBy("segment", "value").agg(F.collect_list(F.when(F.col("home"), F.col("fp"))).alias("homes"), F.collect_list(F.when(~F.col("home"), F.col("fp"))).alias("visitors"))
    buckets = buckets.where("size(homes) > 0 and size(homes) + size(visitors) > 1").select("homes", "visitors")
    buckets = buckets if met is None else buckets.union(met)
    return buckets.mapInArrow(_joined(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = 2) -> DataFrame:
    """(doc_id, key, fp, group, component_id) of each row: rows whose fingerprints reach each other over links of at most max_bits differing bits share a group, and component_id is its smallest doc_id."""
    fps = cut(fingerprints(docs, words))
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")))
    found = components(links(reps, max_bits))
    rooted = cut(reps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "rows", F.coalesce("root", "fp").alias("group")))
    least = rooted.groupBy("group").agg(F.min("rep").alias("component_id"))
    rooted = cut(beside_hot(rooted, least, "group"))
    return beside_hot(fps, rooted.select("fp", "group", "component_id"), "fp").select("doc_id", "key", "fp", "group", "component_id")


def representatives(docs: DataFrame, words: int = WORDS, max_bits: int = 2) -> DataFrame:
    """docs without the near copies: of each group the row of the smallest doc_id stays, and all rows of a null doc_id, which nothing can name."""
    return kept(docs, cut(near_duplicates(docs, words, max_bits)))


def kept(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of docs and their (doc_id, key, group): one row of each group, that of the smallest doc_id (of several, of the smallest key), and all of a null doc_id."""
    first = found.where("doc_id is not null").groupBy("group").agg(F.min(F.struct("doc_id", "key")).alias("_first")).select("_first.*")
    first = cut(first)
    again = found.where("doc_id is not null").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # the row travels in one column, so that its names clash with none
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text_column(docs)).alias("key"), F.struct("*").alias("row"))
    unnamed, named = rows.where("doc_id is null"), rows.where("doc_id is not null")
    named = named.join(first, ["doc_id", "key"], "left_semi")
    if not again.isEmpty():  # only then is it worth dealing the texts out once more
        named = named.withColumn("text", F.col("row.text")).dropDuplicates(["doc_id", "text"]).drop("text")
    return named.unionByName(unnamed).select("row.*")
