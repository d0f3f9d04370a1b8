"""Topics against references: cosine blended with lexicon overlap, the best reference of each topic, matches and their bonus, the opportunity index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions import stats
from topicloom.operators import diagnostics, grid

#: References that stand beside every topic in one list (a strategy has dozens; a catalogue, thousands); more meet the topics in cells.
MOST_REFERENCES = 10_000


def word_weights(terms: DataFrame, topic: str) -> DataFrame:
    """terms (topic, term, score) -> (topic, words: map of word to the sum of its terms' scores, total)."""
    each = terms.select(topic, F.explode(F.split("term", " ")).alias("word"), "score").groupBy(topic, "word").agg(F.sum("score").alias("w"))
    words = each.groupBy(topic).agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("words"))
    return words.join(terms.groupBy(topic).agg(F.sum("score").alias("total")), topic)


def lexicon_overlap(words: Column, total: Column, lexicon: Column) -> Column:
    """Entries all of whose words the topic has count with the least weight of these, as a share of all weight."""

    def credit(entry):
        weights = F.transform(F.array_distinct(F.split(entry, " ")), lambda w: F.try_element_at(words, w))
        return F.when(F.forall(weights, lambda w: w.isNotNull()), F.array_min(weights)).otherwise(F.lit(0.0))

    matched = F.aggregate(F.transform(F.coalesce(lexicon, F.array().cast("array<string>")), credit), F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, stats.clip(matched / total)).otherwise(F.lit(0.0))


def blends(topics: DataFrame, topic: str, refs: DataFrame, embedding: float, lexicon: float) -> DataFrame:
    """topics (topic, centroid, words, total) and refs (ref, label, weight, vector, lexicon) -> (topic, ref, label, weight, cosine, blend) of every pair."""
    refs = refs.select("ref", "label", "weight", "vector", "lexicon")
    if refs.limit(MOST_REFERENCES + 1).count() <= MOST_REFERENCES:
        every = refs.agg(F.array_sort(F.collect_list(F.struct(*refs.columns))).alias("_refs"))
        rows = topics.join(F.broadcast(every)).select(topic, "centroid", "words", "total", F.inline("_refs"))
    else:  # both sides in blocks that meet in cells
        down, across = (-(-df.count() // grid.CELL_ROWS) or 1 for df in (topics, refs))
        block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = topics.select(topic, "centroid", "words", "total", block(topic, down).alias("_i"), every(across).alias("_j"))
        right = refs.select("*", block("ref", across).alias("_j"), every(down).alias("_i"))
        rows = left.join(right, ["_i", "_j"]).drop("_i", "_j")
    cosine = F.greatest(stats.dot(F.col("centroid"), F.col("vector").cast("array<double>")), F.lit(0.0))
    rows = rows.withColumn("cosine", cosine)
    return rows.select(topic, "ref", "label", "weight", "cosine", (embedding * F.col("cosine") + lexicon * lexicon_overlap(F.col("words"), F.col("total"), F.col("lexicon"))).alias("blend"))


def best_reference(pairs: DataFrame, topic: str) -> DataFrame:
    """(topic, label, score, cosine) of each topic's best weighted reference; ties go to the lower ref, no positive score has no label."""
    score = F.round(F.col("blend") * F.col("weight"), 9)
    first = F.row_number().over(Window.partitionBy(topic).orderBy(F.desc("score"), "ref"))
    best = pairs.withColumn("score", score).withColumn("_rn", first).where("_rn = 1")
    found = F.col("score") > 0
    return best.select(topic, F.when(found, F.col("label")).otherwise("").alias("label"), stats.clip(F.col("score")).alias("score"), F.when(found, F.col("cosine")).otherwise(0.0).alias("cosine"))


def match(pairs: DataFrame, topic: str, threshold: float | None) -> DataFrame:
    """(topic, match): the label of the best unweighted reference if it reaches the threshold; without a threshold nothing matches."""
    best = pairs.groupBy(topic).agg(F.max(F.struct("blend", (-F.col("ref")).alias("r"), "label")).alias("b"))
    hit = F.lit(False) if threshold is None else F.col("b.blend") >= threshold
    return best.select(topic, F.when(hit, F.col("b.label")).alias("match"))


def with_bonus(fit: Column, match: Column, bonus: float = 0.10) -> Column:
    return stats.clip(fit + F.when(match.isNotNull(), F.lit(bonus)).otherwise(F.lit(0.0)))


def policy_salience(terms: DataFrame, topic: str, counts: DataFrame, enough: int = 50) -> DataFrame:
    """(topic, salience): terms weighted by their score, each by how often its rarest word stands in the corpus (word, n), enough being all."""
    words = terms.select(topic, "term", "score", F.explode(F.split("term", " ")).alias("word")).join(counts, "word", "left")
    least = words.groupBy(topic, "term", "score").agg(F.min(F.coalesce("n", F.lit(0))).alias("least"))
    return least.groupBy(topic).agg(stats.clip(F.sum(F.col("score") * F.least(F.col("least") / float(enough), F.lit(1.0))) / F.sum("score")).alias("salience"))


def source_shares(members: DataFrame, topic: str, kinds: dict[str, tuple[str, ...]]) -> DataFrame:
    """(topic, document_count, a share for each kind) of members (topic, source)."""
    share = lambda names: F.avg(F.col("source").isin(*names).cast("double")) if names else F.lit(0.0)
    return members.groupBy(topic).agg(F.count(F.lit(1)).alias("document_count"), *[share(names).alias(kind) for kind, names in kinds.items()])


def opportunity(rows: DataFrame, weights: dict[str, float], min_documents: int) -> tuple[DataFrame, dict[str, float]]:
    """rows (document_count, a column for each component) with `opportunity`, null for topics of too few documents, and the weights used: those of components that are positive anywhere, to sum one."""
    there = rows.agg(*[F.coalesce(F.max(F.col(c) > 0), F.lit(False)).alias(c) for c in weights]).first().asDict()
    used = diagnostics.redistribute(weights, {c for c, on in there.items() if on})
    if not used:
        return rows.withColumn("opportunity", F.lit(None).cast("double")), used
    ranked = rows.withColumns({f"_{c}": F.round(stats.percentile_rank(F.col(c)), 4) for c in used})
    index = diagnostics.weighted({c: F.col(f"_{c}") for c in used}, used)
    return ranked.withColumn("opportunity", F.when(F.col("document_count") >= min_documents, F.round(index, 6))).drop(*[f"_{c}" for c in used]), used
