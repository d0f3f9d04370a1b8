"""The queries of this subpackage: one for each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import bpe, collocations, html, ngram, packing, pii, quality, repeats, sharding, simhash, topk, toxicity
from topicloom.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def unseen(doc_id: F.Column) -> F.Column:
    """Rows that the language model does not learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def op2_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, scores = ngram.train_and_score(docs.withColumn("learn", ~unseen(F.col("doc_id"))), "learn", min_count=1)
    return scores.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents")).drop("source")


def held_out(doc_id: F.Column) -> F.Column:
    """Rows whose labels the toxicity model never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("distance2")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_ngram, op3_packing, op4_html, op5_simhash, op6_sharding, op7_toxicity, op8_quality, op9_pii, op10_topk, op11_repeats, op12_collocations)}
#: The others need a vocabulary, XXH64, a trained model or positions of matches, which DuckDB's SQL lacks; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op10_topk": """
WITH v AS (SELECT vec_id, ROW_NUMBER() OVER () AS r, LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(LIST_DOT_PRODUCT(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND LEN(q.v) = LEN(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id, r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op11_repeats": """
WITH b AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY doc_id) AS d, HEX(ENCODE(COALESCE(text, ''))) AS h FROM documents),
k AS (SELECT d, UNNEST(RANGE(0, LENGTH(h), 1000)) AS o, h FROM b),
c AS (SELECT d, o // 2 AS o, h[o + 1 : o + 1200] AS h FROM k),
w AS (SELECT d, o + i AS i, MD5_NUMBER(h[2 * i + 1 : 2 * i + 200]) AS s FROM (SELECT d, o, h, UNNEST(RANGE(0, LEAST(500, LENGTH(h) // 2 - 99))) AS i FROM c)),
g AS (SELECT d, i FROM w QUALIFY ROW_NUMBER() OVER (PARTITION BY s ORDER BY d, i) > 1),
r AS (SELECT d, i, SUM(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY d ORDER BY i) AS run FROM (SELECT d, i, COALESCE(LAG(i) OVER (PARTITION BY d ORDER BY i), -1000) AS before FROM g)),
x AS (SELECT d, MIN(i) AS a, MAX(i) + 100 AS z FROM r GROUP BY d, run),
y AS (SELECT d, LIST(a ORDER BY a) AS a, LIST(z ORDER BY a) AS z, CAST(SUM(z - a) AS BIGINT) AS n_removed, COUNT(*) AS n_spans FROM x GROUP BY d)
SELECT doc_id, LENGTH(h) // 2 AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
 SHA256(UNHEX(CASE WHEN a IS NULL THEN h ELSE ARRAY_TO_STRING(LIST_TRANSFORM(RANGE(0, LEN(a) + 1), lambda j: h[CASE WHEN j = 0 THEN 0 ELSE 2 * z[j] END + 1 : CASE WHEN j = LEN(a) THEN LENGTH(h) ELSE 2 * a[j + 1] END]), '') END)) AS kept_sha256
FROM b LEFT JOIN y ON y.d = b.d""",
    "op12_collocations": """
WITH p AS (SELECT COALESCE(lang, 'und') AS lang, UNNEST(REGEXP_SPLIT_TO_ARRAY(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(piece, '[ \\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, w, k, UNNEST(RANGE(1, LEN(w) - k + 2)) AS i FROM w, (SELECT UNNEST([1, 2, 3]) AS k)),
f AS (SELECT lang, k, ARRAY_TO_STRING(w[i : i + k - 1], ' ') AS phrase, FIRST(w[i : i + k - 1]) AS ws, COUNT(*) AS f FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
gone AS (SELECT lang, UNNEST([ARRAY_TO_STRING(ws[1:2], ' '), ARRAY_TO_STRING(ws[2:3], ' ')]) AS phrase, f FROM c WHERE k = 3),
most AS (SELECT lang, phrase, MAX(f) AS f FROM gone GROUP BY 1, 2),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, u.cut, ARRAY_TO_STRING(c.ws[1 : u.cut], ' ') AS one, ARRAY_TO_STRING(c.ws[u.cut + 1 : c.k], ' ') AS two
 FROM c JOIN (SELECT UNNEST([1, 2]) AS cut) u ON u.cut < c.k LEFT JOIN most m ON m.lang = c.lang AND m.phrase = c.phrase AND c.k = 2 WHERE m.f IS NULL OR 100 * m.f < 50 * c.f),
s AS (SELECT x.lang, x.phrase, a, x.cut, l.f AS l, r.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.one JOIN f r ON r.lang = x.lang AND r.phrase = x.two
 QUALIFY ROW_NUMBER() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, x.cut) = 1)
SELECT s.lang, ROW_NUMBER() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM s JOIN n ON n.lang = s.lang QUALIFY rank <= 2000""",
}
