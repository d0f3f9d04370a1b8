"""The analytical run: documents and references in, ranked topics out, every step a frame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions import stats, text
from topicloom.operators import diagnostics, entropy, ranks, references, series, topics, vectors


@dataclass
class Settings:
    """Defaults of a run with hashed vectors and average linkage."""

    dim: int = 2048
    threshold: float = 0.14
    min_topic_size: int = 4
    max_topics: int = 120
    attach_ratio: float = 0.6
    forming: tuple[str, ...] = ()
    s: float = 2.0
    gamma: float = 1.0
    research: tuple[str, ...] = ()
    attention: tuple[str, ...] = ()
    patents: tuple[str, ...] = ()
    match: tuple[float, float] = (0.5, 0.5)
    critical_threshold: float | None = 0.25
    min_documents: int = 15
    emergence: dict[str, float] = field(default_factory=lambda: {"novelty": 0.2, "growth": 0.3, "coherence": 0.15, "impact": 0.2, "uncertainty": 0.15})
    index: dict[str, float] = field(default_factory=lambda: {"research_growth": 0.3, "attention": 0.25, "attention_tone": 0.1, "patent_activity": 0.2})
    composite: dict[str, float] = field(default_factory=lambda: {"emergence": 0.4, "fit": 0.35, "leverage": 0.25})


def _dense(sparse: DataFrame, id_: str, dim: int) -> DataFrame:
    """(id, vector) of sparse (id, idx, weight)."""
    rows = sparse.groupBy(id_).agg(F.map_from_entries(F.collect_list(F.struct("idx", "weight"))).alias("m"))
    return rows.select(id_, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.coalesce(F.try_element_at(F.col("m"), k.cast("long")), F.lit(0.0))).alias("vector"))


def topic_model(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """((topic_id, doc_id, similarity, forming), (doc_id, vector)): members of labelled clusters, with documents of the other sources attached to frozen centroids."""
    body = text.document_text(F.col("title"), F.col("abstract"))
    sparse = vectors.tfidf(vectors.features(docs, "doc_id", body, settings.dim, "blake2b"), "doc_id").cache()
    forms = F.col("source").isin(*settings.forming) if settings.forming else F.lit(True)
    forming = docs.where(forms).select("doc_id")
    own = sparse.join(forming, "doc_id")
    dense = _dense(sparse, "doc_id", settings.dim).checkpoint()
    clusters = topics.clusters(own, "doc_id", settings.threshold, settings.min_topic_size, settings.max_topics)
    centres = vectors.centroids(clusters.join(dense, "doc_id"), "topic_id", "vector").checkpoint()
    at = centres.withColumn("ord", F.substring("topic_id", 2, 9).cast("int"))
    members = clusters.join(dense, "doc_id").join(F.broadcast(centres), "topic_id").select("topic_id", "doc_id", stats.dot(F.col("vector"), F.col("centroid")).alias("similarity"), F.lit(True).alias("forming"))
    others = docs.where(~forms).select("doc_id").join(dense, "doc_id")
    attached = vectors.attach(others, "doc_id", "vector", at.select("ord", "centroid"), "ord", settings.threshold * settings.attach_ratio)
    attached = attached.select(F.format_string("T%04d", "ord").alias("topic_id"), "doc_id", "similarity", F.lit(False).alias("forming"))
    return members.unionByName(attached).checkpoint(), dense


def attributes(docs: DataFrame, members: DataFrame, dense: DataFrame, settings: Settings) -> DataFrame:
    """One row a topic: label, counts, growth, burst, maturity, the attributes and the emergence score."""
    joined = members.join(docs, "doc_id")
    body = joined.where("forming").select("topic_id", text.document_text(F.col("title"), F.col("abstract")).alias("body"))
    labels = topics.labels(topics.terms(body, "topic_id", "body"), "topic_id")
    forms = F.col("source").isin(*settings.forming) if settings.forming else F.lit(True)
    totals = docs.where(forms & F.col("time_slice").isNotNull()).groupBy("time_slice").agg(F.count(F.lit(1)).alias("total"))
    counts = joined.where("forming").groupBy("topic_id", "time_slice").agg(F.count(F.lit(1)).alias("n"))
    spine = members.select("topic_id").distinct().join(F.broadcast(totals.agg(F.collect_list(F.struct("time_slice", "total")).alias("s")))).select("topic_id", F.inline("s"))
    line = series.series(spine.join(counts, ["topic_id", "time_slice"], "left").na.fill(0, ["n"]), "topic_id", "time_slice")
    burst = series.bursts(line, settings.s, settings.gamma)
    shape = burst.select("topic_id", stats.cagr(F.col("counts")).alias("cagr"), stats.burst_score(F.col("states"), F.col("max_weight")).alias("burst"), F.col("total_weight").alias("burst_weight"), F.aggregate(F.zip_with("counts", "totals", lambda c, t: F.when(t > 0, c / t).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x).alias("p"), F.size("counts").alias("slices"))
    shape = shape.select("topic_id", "cagr", "burst_weight", (F.col("p") / F.col("slices")).alias("avg_proportion"), stats.clip(0.6 * stats.squash(F.col("cagr")) + 0.4 * F.col("burst")).alias("growth"))
    cited = ranks.shares_at_or_below(docs.select("doc_id", "source", "citation_count"), "citation_count", "cited", ["source"]).select("doc_id", "cited")
    actors = [c for c in ("source", "institutions") if c in docs.columns]
    spread = entropy.mean_entropy(joined, "topic_id", actors).withColumnRenamed("entropy", "uncertainty")
    basic = members.join(cited, "doc_id").groupBy("topic_id").agg(F.count(F.lit(1)).alias("document_count"), F.avg(stats.clip(F.col("similarity"))).alias("coherence"), F.avg("cited").alias("impact"))
    # novelty: distance of a topic's centroid from that of all documents of the first third of the slices
    early = docs.select("time_slice").distinct().where("time_slice is not null").withColumn("r", F.row_number().over(Window.orderBy("time_slice"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    early = early.where(F.col("r") <= F.greatest(F.floor(F.col("n") / 3), F.lit(1))).select("time_slice")
    first = docs.join(F.broadcast(early), "time_slice").select("doc_id").join(dense, "doc_id").withColumn("all", F.lit(1))
    first = vectors.centroids(first, "all", "vector").select(F.col("centroid").alias("first"))
    centres = vectors.centroids(members.join(dense, "doc_id"), "topic_id", "vector")
    novelty = centres.join(F.broadcast(first)).select("topic_id", F.coalesce(stats.clip(1 - stats.dot(F.col("centroid"), F.col("first"))), F.lit(0.5)).alias("novelty"))
    rows = basic.join(labels, "topic_id").join(shape, "topic_id").join(series.maturity(line, "topic_id").withColumnRenamed("fit", "maturity_fit"), "topic_id").join(spread, "topic_id").join(novelty, "topic_id").checkpoint()
    rows = rows.withColumns({f"r_{a}": stats.percentile_rank(F.col(a)) for a in settings.emergence})
    rows = rows.withColumn("emergence", diagnostics.weighted({a: F.col(f"r_{a}") for a in settings.emergence}, settings.emergence)).drop(*[f"r_{a}" for a in settings.emergence])
    cuts = rows.agg(F.median("avg_proportion").alias("cp"), F.median("growth").alias("cg"))
    return rows.join(F.broadcast(cuts)).withColumn("horizon", stats.horizon(F.col("maturity"))).withColumn("signal", stats.signal_class(F.col("avg_proportion"), F.col("growth"), F.col("cp"), F.col("cg"))).drop("cp", "cg")


def reference_scores(docs: DataFrame, members: DataFrame, dense: DataFrame, refs: DataFrame, settings: Settings) -> DataFrame:
    """refs (ref, kind: objective, capability or critical; label, weight, body, lexicon) -> (topic_id, fit, objective, leverage, capability, critical): each topic's best references by vector and lexicon; a critical one that it matches raises its fit."""
    text_of = text.document_text(F.col("title"), F.col("abstract"))
    body = members.where("forming").join(docs, "doc_id").select("topic_id", text_of.alias("body"))
    words = references.word_weights(topics.terms(body, "topic_id", "body"), "topic_id")
    words = words.join(vectors.centroids(members.where("forming").join(dense, "doc_id"), "topic_id", "vector"), "topic_id").checkpoint()
    fitted = vectors.features(docs, "doc_id", text_of, settings.dim, "blake2b").withColumnRenamed("doc_id", "ref")
    sparse = vectors.tfidf(vectors.features(refs, "ref", F.col("body"), settings.dim, "blake2b"), "ref", fitted)
    refs = refs.join(_dense(sparse, "ref", settings.dim), "ref").select("ref", "kind", "label", "weight", "vector", "lexicon").checkpoint()
    pairs = lambda kind: references.blends(words, "topic_id", refs.where(F.col("kind") == kind).drop("kind"), *settings.match)
    best = lambda kind, score: references.best_reference(pairs(kind), "topic_id").select("topic_id", F.col("score").alias(score), F.col("label").alias(kind))
    critical = references.match(pairs("critical"), "topic_id", settings.critical_threshold).withColumnRenamed("match", "critical")
    rows = words.select("topic_id").join(best("objective", "fit"), "topic_id", "left").join(best("capability", "leverage"), "topic_id", "left").join(critical, "topic_id", "left").na.fill(0.0, ["fit", "leverage"])
    return rows.withColumn("fit", references.with_bonus(F.col("fit"), F.col("critical")))


def opportunities(docs: DataFrame, members: DataFrame, rows: DataFrame, settings: Settings) -> tuple[DataFrame, dict[str, float]]:
    """(topic_id, research_growth, attention, attention_tone, patent_activity, opportunity) and the weights used; docs may have a tone, which counts on documents of attention."""
    joined = members.join(docs, "doc_id")
    shares = references.source_shares(joined, "topic_id", {"research": settings.research, "attention": settings.attention, "patent_activity": settings.patents})
    if "tone" in docs.columns:
        tones = joined.groupBy("topic_id").agg(stats.tone_share(F.avg(F.when(F.col("source").isin(*settings.attention), F.col("tone")))).alias("attention_tone"))
        shares = shares.join(tones, "topic_id")
    else:
        shares = shares.withColumn("attention_tone", F.lit(0.0))
    shares = shares.join(rows.select("topic_id", "cagr"), "topic_id").withColumn("research_growth", F.greatest("cagr", F.lit(0.0)) * F.col("research"))
    found, used = references.opportunity(shares, settings.index, settings.min_documents)
    return found.select("topic_id", *settings.index, "opportunity"), used


def ranked(rows: DataFrame, scores: DataFrame, settings: Settings) -> DataFrame:
    """rows of attributes() with scores (topic_id, fit, leverage; missing: 0): composite, rank, quadrant."""
    rows = rows.join(scores, "topic_id", "left").na.fill(0.0, ["fit", "leverage"])
    score = diagnostics.weighted({a: stats.percentile_rank(F.col(a)) for a in settings.composite}, settings.composite)
    rows = rows.withColumn("composite", score).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("composite"), F.desc("emergence"), "topic_id")))
    cuts = rows.agg(F.median("fit").alias("cf"), F.median("leverage").alias("cl"))
    return rows.join(F.broadcast(cuts)).withColumn("quadrant", stats.quadrant(F.col("fit"), F.col("leverage"), F.col("cf"), F.col("cl"), ["monitor", "partner", "extend", "pursue"])).drop("cf", "cl")
