"""The jobs as queries over the whole tables, with the SQL that DuckDB must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import corpus_feed, watchlist
from topicloom.operators.shared import new_folder
from topicloom.plans.catalog2 import tokens_sql


def job1_corpus_feed(spark: SparkSession, d: str) -> DataFrame:
    """The feed over the documents, run twice; the vocabulary as it stands then."""
    out = new_folder(spark, "job1")
    for _ in range(2):
        corpus_feed.run(spark, f"{d.rstrip('/')}/documents.parquet", f"{out}/tables", f"{out}/checkpoint")
    return corpus_feed.latest(spark, f"{out}/tables")


def job2_watchlist(spark: SparkSession, d: str) -> DataFrame:
    """The watch list of one run, made twice."""
    out, at = new_folder(spark, "job2"), lambda t: f"{d.rstrip('/')}/{t}.parquet"
    for _ in range(2):
        found = watchlist.run(spark, at("lineitem"), at("part"), at("supplier"), out, "scan")
    return found.select("topic", "documents", F.col("first_slice").cast("long").alias("first_slice"), F.col("last_slice").cast("long").alias("last_slice"), "cagr", "burst", "growth", "share", "uncertainty", "worth", "emergence", "signal", "rank", "run_id")


QUERIES = {f.__name__: f for f in (job1_corpus_feed, job2_watchlist)}

_RANK = "CASE WHEN COUNT(*) OVER () = 1 THEN 0.5 ELSE ((RANK() OVER (ORDER BY {0}) - 1) + (COUNT(*) OVER (PARTITION BY {0}) - 1) / 2.0) / (COUNT(*) OVER () - 1) END"
_ENTROPY = "(SELECT topic, CASE WHEN COUNT(*) < 2 THEN 0 ELSE LEAST(GREATEST(-SUM(p * LN(p)) / LN(COUNT(*)), 0), 1) END AS e FROM (SELECT topic, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY topic) AS p FROM docs WHERE {0} IS NOT NULL GROUP BY topic, {0}) GROUP BY topic)"

ORACLES = {
    "job1_corpus_feed": f"""
WITH b AS (SELECT doc_id, lang, TRIM(REGEXP_REPLACE(COALESCE(text, ''), '\\s+', ' ', 'g')) AS body FROM documents WHERE doc_id IS NOT NULL AND lang IS NOT NULL),
u AS (SELECT lang, body FROM b WHERE body <> '' GROUP BY lang, body),
t AS (SELECT lang, body, UNNEST({tokens_sql('body')}) AS term FROM u),
c AS (SELECT lang, term, COUNT(DISTINCT body) AS docs, COUNT(*) AS uses FROM t GROUP BY lang, term),
n AS (SELECT lang, COUNT(*) AS n FROM u GROUP BY lang)
SELECT c.lang, term, docs, uses, ROUND(LN((1.0 + n) / (1.0 + docs)) + 1, 6) AS idf FROM c JOIN n ON n.lang = c.lang""",
    "job2_watchlist": f"""
WITH RECURSIVE docs AS (SELECT p_partkey AS topic, CAST(YEAR(l_shipdate) AS BIGINT) AS slice, l_returnflag AS source, CAST(s_nationkey AS VARCHAR) AS actor, l_extendedprice AS worth
 FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate IS NOT NULL),
f AS (SELECT t.topic, s.slice, COALESCE(c.n, 0) AS r, s.total AS d, ROW_NUMBER() OVER (PARTITION BY t.topic ORDER BY s.slice) AS i FROM (SELECT DISTINCT topic FROM docs) t
 CROSS JOIN (SELECT slice, COUNT(*) AS total FROM docs GROUP BY slice) s LEFT JOIN (SELECT topic, slice, COUNT(*) AS n FROM docs GROUP BY 1, 2) c ON c.topic = t.topic AND c.slice = s.slice),
p AS (SELECT *, CAST(SUM(r) OVER w AS DOUBLE) / SUM(d) OVER w AS p0, COUNT(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY topic)),
e AS (SELECT topic, i, n, -(r * LN(p0) + (d - r) * LN(1 - p0)) AS c0, -(r * LN(LEAST(p0 * 2, 1 - 1e-9)) + (d - r) * LN(1 - LEAST(p0 * 2, 1 - 1e-9))) AS c1, 0.5 * LN(n) AS tau FROM p),
v AS (SELECT topic, i, c0 AS b0, c1 AS b1, 0 AS f0, 1 AS f1 FROM e WHERE i = 1
 UNION ALL SELECT e.topic, e.i, LEAST(v.b0, v.b1 + tau) + c0, LEAST(v.b1, v.b0 + tau) + c1, CASE WHEN v.b0 <= v.b1 + tau THEN 0 ELSE 1 END, CASE WHEN v.b1 <= v.b0 + tau THEN 1 ELSE 0 END FROM v JOIN e ON e.topic = v.topic AND e.i = v.i + 1),
b AS (SELECT v.topic, v.i, CASE WHEN b0 <= b1 THEN 0 ELSE 1 END AS st FROM v JOIN (SELECT topic, MAX(i) AS last FROM e GROUP BY topic) l ON l.topic = v.topic AND l.last = v.i
 UNION ALL SELECT v.topic, v.i - 1, CASE WHEN b.st = 0 THEN v.f0 ELSE v.f1 END FROM b JOIN v ON v.topic = b.topic AND v.i = b.i WHERE v.i > 1),
w AS (SELECT b.topic, b.i, b.st, CASE WHEN b.st = 1 THEN GREATEST(c0 - c1, 0) ELSE 0 END AS weight, n FROM b JOIN e ON e.topic = b.topic AND e.i = b.i),
burst AS (SELECT topic, ROUND(CASE WHEN MAX(st) = 0 OR MAX(weight) <= 0 THEN 0 ELSE 0.5 * MAX(weight) / (MAX(weight) + 10) + 0.5 * MAX(weight) / (MAX(weight) + 10) * MAX(CASE WHEN st = 1 THEN i END) / MAX(n) END, 6) AS burst FROM w GROUP BY topic),
s AS (SELECT topic, LIST(CAST(r AS DOUBLE) ORDER BY i) AS s, MIN(CASE WHEN r > 0 THEN slice END) AS first_slice, MAX(CASE WHEN r > 0 THEN slice END) AS last_slice, ROUND(AVG(r / d), 9) AS share FROM f GROUP BY topic),
g AS (SELECT topic, first_slice, last_slice, share, ROUND(CAST(CASE WHEN LEN(s) < 4 OR LIST_SUM(s) <= 0 THEN 0 WHEN s[-1] + s[-2] <= 0 THEN -1 ELSE POW(((s[-1] + s[-2]) / 2) / GREATEST((s[1] + s[2]) / 2, 0.5), 1.0 / (LEN(s) - 1)) - 1 END AS DOUBLE), 6) AS cagr FROM s),
a AS (SELECT g.*, burst, ROUND(LEAST(GREATEST(0.6 * CASE WHEN cagr <= 0 THEN 0 ELSE cagr / (cagr + 1) END + 0.4 * burst, 0), 1), 6) AS growth, documents, worth, ROUND((COALESCE(x.e, y.e, 0) + COALESCE(y.e, x.e, 0)) / 2, 6) AS uncertainty
 FROM g JOIN burst USING (topic) JOIN (SELECT topic, COUNT(*) AS documents, SUM(CAST(ROUND(worth * 100) AS BIGINT)) // COUNT(worth) / 100.0 AS worth FROM docs GROUP BY topic) USING (topic)
 LEFT JOIN {_ENTROPY.format('source')} x ON x.topic = g.topic LEFT JOIN {_ENTROPY.format('actor')} y ON y.topic = g.topic),
k AS (SELECT *, ROUND(CAST(0.4 * {_RANK.format('growth')} + 0.25 * {_RANK.format('share')} + 0.15 * {_RANK.format('uncertainty')} + 0.2 * {_RANK.format('worth')} AS DOUBLE), 6) AS emergence, share >= MEDIAN(share) OVER () AS large, growth >= MEDIAN(growth) OVER () AS fast FROM a)
SELECT topic, documents, first_slice, last_slice, cagr, burst, growth, share, uncertainty, worth, emergence, CASE WHEN large AND fast THEN 'strong' WHEN fast THEN 'weak' WHEN large THEN 'latent' ELSE 'noise' END AS signal,
 ROW_NUMBER() OVER (ORDER BY emergence DESC, topic) AS rank, 'scan' AS run_id FROM k""",
}
