"""Collocations by pivot partitioning, as in MG-FSM.

A phrase belongs to its rarest word, the pivot. Words of `min_count` or more occurrences in their language have
ids in order of language, falling frequency and the word itself, so that of two words of a language the rarer one has the greater
id. For each occurrence of a word the text is rewritten into the fragment in which the word is the pivot: up to
`longest` - 1 words to either side, cut before a rarer word, a word without id or the end of the piece, and on the left also
before the word itself, so that of a phrase that holds its pivot twice one occurrence counts it. Equal
fragments of a block are combined and routed to their pivot's bucket, where phrases that hold the pivot are counted and those
under `min_count` dropped.

Balance. The commonest words own few fragments, as their neighbours must be as common, and rare words have few
occurrences. A pivot of more than HOT occurrences is dealt over salts by block; its counts are partial then and
are added up by an aggregate that combines before it shuffles. A bucket gets about BUCKET fragments at any size of the corpus.

Words never travel as texts: a block of BLOCK words holds its own vocabulary once and the words as numbers in it, and the ids
come back to it by a join on that vocabulary. No word list is broadcast. A document's words must fit in a task.

Null texts are empty, a null language is `und`. Rows count as often as they come; repeated or missing doc_ids do not matter, further columns
are ignored. Words may be of any length. An empty table, or one without phrases, gives an empty result.
"""

from __future__ import annotations

from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import beside_hot, cut, new_folder, session, text_column

LONGEST, MIN_COUNT, INSIDE, LIMIT = 3, 10, 50, 2000
#: Words of a block; fragments of a bucket; occurrences of a pivot beyond which its fragments are dealt over salts.
BLOCK, BUCKET, HOT = 500_000, 250_000, 125_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\v\f\r" else c for c in range(256))
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _numbered():
    """(lang, text) -> blocks: a vocabulary, how often each of its words came, and the words as numbers in it, -1 between pieces, compressed."""

    def fresh():
        words = defaultdict()
        words.default_factory = words.__len__
        return words, array("i")

    def row(lang, words, ids):
        numbers = np.frombuffer(ids, np.int32)
        counts = np.bincount(numbers[numbers >= 0], minlength=len(words))
        return lang, list(words), counts.tolist(), int(counts.sum()), zstandard.ZstdCompressor(level=1).compress(ids.tobytes())

    def run(batches):
        part, made, held = TaskContext.get().partitionId() << 33, 0, defaultdict(fresh)

        def flush():
            nonlocal made, held
            for lang, (words, ids) in held.items():
                if words:
                    columns = list(zip(row(lang, words, ids)))
                    kinds = [pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([part + made], pa.int64()), *map(pa.array, columns, kinds)], names=["block", "lang", "words", "counts", "n", "ids"])
                    made += 1
            held = defaultdict(fresh)

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, ids = held[lang]
                before = len(ids)
                for piece in text.translate(LOWER).replace(b"\t", b" ").split(b"\n"):
                    if piece:
                        ids.extend(map(words.__getitem__, filter(None, piece.split(b" "))))
                        ids.append(-1)
                size += len(ids) - before
                if size >= BLOCK:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def fragments(words: np.ndarray, longest: int) -> np.ndarray:
    """A row for each word that has a neighbour to own: the word in the middle, what it is a pivot of on both sides, -1 beyond."""
    side = longest - 1
    out = np.full((len(words), 2 * side + 1), -1, np.int64)
    out[:, side] = words
    for step, at in ((-1, side - 1), (1, side + 1)):
        open_ = words >= 0
        for k in range(1, longest):
            other = np.full(len(words), -1, np.int64)
            if k < len(words):
                other[k:] = words[:-k] if step < 0 else other[k:]
                if step > 0:
                    other[:-k] = words[k:]
            open_ = open_ & (other >= 0) & ((other < words) if step < 0 else (other <= words))
            out[:, at + step * (k - 1)] = np.where(open_, other, -1)
    return out[(words >= 0) & ((out[:, side - 1] >= 0) | (out[:, side + 1] >= 0))]


def added(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one with the sum of their counts: by a hash of the row; if two different rows share one, by the rows."""
    if not len(rows):
        return rows, counts
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        h = (h ^ h >> np.uint64(31)) * MIX[k % 5] + rows[:, k].astype(np.uint64) * MIX[(k + 1) % 5]
    order = np.argsort(h)
    rows, h, counts = rows[order], h[order], counts[order]
    other = (rows[1:] != rows[:-1]).any(1)
    if (other & (h[1:] == h[:-1])).any():
        order = np.lexsort(rows.T)
        rows, counts = rows[order], counts[order]
        other = (rows[1:] != rows[:-1]).any(1)
    first = np.flatnonzero(np.concatenate(([True], other)))
    return rows[first], np.add.reduceat(counts, first)


def phrases(rows: np.ndarray, counts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of 2 to `longest` words around the pivots of fragments, padded with -1, with their counts."""
    side, found, weights = longest - 1, [np.empty((0, longest), np.int64)], [np.empty(0, np.int64)]
    for n in range(2, longest + 1):
        for left in range(n):
            a = side - left
            whole = (rows[:, a] >= 0) & (rows[:, a + n - 1] >= 0)
            part = np.full((int(whole.sum()), longest), -1, np.int64)
            part[:, :n] = rows[whole, a : a + n]
            found.append(part)
            weights.append(counts[whole])
    return added(np.concatenate(found), np.concatenate(weights))


def _routed(longest: int, buckets: int):
    """(block, ids, reply) -> (bucket, packed): a block's fragments with counts, compressed, by the bucket of their pivots."""

    def run(batches):
        squeeze, loose = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            replies = batch.column(3)
            ends, flat = replies.offsets.to_numpy(), replies.values
            every = [flat.field(k).to_numpy().astype(np.int64) for k in ("pos", "id", "f")]
            for k, (block, ids, size) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                at, of, often = (x[ends[k] : ends[k + 1]] for x in every)
                # the last is what -1 finds: no word
                global_, often_ = np.full(size + 1, -1, np.int64), np.zeros(size + 1, np.int64)
                global_[at] = of
                words = global_[np.frombuffer(loose(ids), np.int32)]
                rows, counts = added(*(lambda r: (r, np.ones(len(r), np.int64)))(fragments(words, longest)))
                if not len(rows):
                    continue
                pivots = rows[:, longest - 1]
                order = np.argsort(of)
                salts = -(-often[order] // HOT)[np.searchsorted(of[order], pivots)]
                mixed = (pivots.astype(np.uint64) * MIX[0] + (block % salts).astype(np.uint64) * MIX[1]) * MIX[2]
                bucket = ((mixed ^ mixed >> np.uint64(29)) * MIX[3] >> np.uint64(20)).astype(np.int64) % buckets
                order = np.lexsort((pivots, bucket))
                rows, bucket = np.column_stack((rows, counts, salts > 1))[order], bucket[order]
                edges = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
                packed = [squeeze(np.asfortranarray(rows[a:b]).tobytes("F")) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), pa.array(packed, pa.binary())], names=["bucket", "packed"])

    return run


def _mined(longest: int, min_count: int):
    """Of a bucket's fragments: its phrases with their counts, those of pivots with salts whatever they are."""

    def run(table: pa.Table) -> pa.Table:
        width, loose = 2 * longest + 1, zstandard.ZstdDecompressor().decompress
        parts = [np.frombuffer(loose(p), np.int64).reshape(width, -1).T for p in table.column("packed").to_pylist()]
        every = np.concatenate(parts)
        out, sums = [], []
        for salted in (False, True):
            mine = every[every[:, -1] == salted]
            found, n = phrases(mine[:, :-2], mine[:, -2], longest)
            keep = n >= (1 if salted else min_count)
            out.append(found[keep])
            sums.append(n[keep])
        found, n = np.concatenate(out), np.concatenate(sums)
        real = found >= 0
        offsets = np.concatenate(([0], np.cumsum(real.sum(1)))).astype(np.int32)
        return pa.Table.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[real])), pa.array(n, pa.int64())], names=["gram", "n"])

    return run


def ranked_words(frequent: DataFrame) -> DataFrame:
    """(lang, word, f) with ids 0, 1, ... by language, falling f and word. What reaches the driver is a row count for each partition of the sort."""
    spark = frequent.sparkSession
    rows = cut(frequent.sort("lang", F.desc("f"), "word").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())
    firsts, total = [], 0
    for k, n in sizes:
        firsts.append((k, total))
        total += n
    firsts = spark.createDataFrame(firsts, "part long, first long")
    return rows.withColumn("part", part).join(F.broadcast(firsts), "part").select("lang", "word", "f", (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"))


def counted(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, word, f, id) and (gram of ids, n) of all words and phrases of up to `longest` words with min_count or more occurrences, and (lang, n) of all words."""
    if longest < 2 or min_count < 1:
        raise ValueError("longest from 2, min_count from 1")
    spark = session(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_column(docs).cast("binary").alias("text"))
    folder = new_folder(spark, "phrases")
    rows.mapInArrow(_numbered(), "block long, lang string, words array<binary>, counts array<long>, n long, ids binary").write.parquet(folder)
    blocks = spark.read.parquet(folder)
    totals = cut(blocks.groupBy("lang").agg(F.sum("n").alias("n")))
    tally = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    words = cut(ranked_words(tally.where(F.col("f") >= min_count)))
    reply = blocks.select("block", "lang", F.posexplode("words").alias("pos", "word")).join(words, ["lang", "word"])
    reply = reply.groupBy("block").agg(F.collect_list(F.struct("pos", "id", "f")).alias("reply"))
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = -(-n // BUCKET) or 1
    routed = blocks.select("block", "ids", F.size("words").alias("size")).join(reply, "block").select("block", "ids", "size", "reply")
    routed = routed.mapInArrow(_routed(longest, buckets), "bucket long, packed binary")
    found = routed.groupBy("bucket").applyInArrow(_mined(longest, min_count), "gram array<long>, n long")
    grams = cut(found.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    return words, grams, totals


def scored(words: DataFrame, grams: DataFrame, inside: int = INSIDE) -> DataFrame:
    """(gram, a, l, r, score) of the phrases that no longer one with `inside` hundredths of their count holds; score: millionths of a * a / (l * r) at the cut where they are least, exact."""
    parts = cut(grams.union(words.select(F.array("id").alias("gram"), F.col("f").alias("n"))))
    longer = grams.where("size(gram) > 2").select("n", F.explode(F.expr("flatten(transform(sequence(2, size(gram) - 1), k -> transform(sequence(1, size(gram) - k + 1), i -> slice(gram, i, k))))")).alias("gram"))
    longer = longer.groupBy("gram").agg(F.max("n").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    left = grams.join(longer, "gram", "left").where(F.col("most").isNull() | (wide("most") * 100 < wide("n") * inside))
    cuts = left.select("gram", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size(gram) - 1)")).alias("k"))
    cuts = cut(cuts.select("gram", "a", "k", F.expr("slice(gram, 1, k)").alias("first"), F.expr("slice(gram, k + 1, size(gram))").alias("rest")))
    cuts = cut(beside_hot(cuts, parts.select(F.col("gram").alias("first"), F.col("n").alias("l")), "first"))
    cuts = beside_hot(cuts, parts.select(F.col("gram").alias("rest"), F.col("n").alias("r")), "rest")
    cuts = cuts.withColumn("above", wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("below", wide("l") * wide("r")).withColumn("score", F.expr("above div below"))
    least = cuts.groupBy("gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return least.select("gram", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, inside: int = INSIDE, limit: int | None = LIMIT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first `limit` phrases (None: of all, without rank) by score, count and phrase."""
    words, grams, totals = counted(docs, longest, min_count)
    found = cut(scored(words, grams, inside).withColumn("gram_id", F.monotonically_increasing_id()))
    spelt = cut(found.select("gram_id", F.posexplode("gram").alias("pos", "id")))
    spelt = beside_hot(spelt, words.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
    spelt = spelt.groupBy("gram_id").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = found.drop("gram").join(spelt, "gram_id")
    if limit is None:
        return beside_hot(cut(rows), totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = rows.withColumn("salt", F.pmod(F.xxhash64("gram_id"), F.lit(salts))).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = some.where(F.col("nth") <= limit).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
