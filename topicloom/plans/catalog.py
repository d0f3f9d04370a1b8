"""One query for each operator of the inventory, each with the SQL that DuckDB must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions import stats, text
from topicloom.operators import diagnostics, ranks, series, tables, topics, vectors
from topicloom.plans import roles
from topicloom.plans.roles import BRANDS, DOCS, POINTS, USER_DAYS, rank_sql
from topicloom.session import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- ranked topics: the flagship ------------------------------------------------------------------

COMPOSITE = f"""WITH b AS {BRANDS}, r AS (SELECT *, {rank_sql('revenue')} AS rr, {rank_sql('quantity')} AS rq, {rank_sql('discount')} AS rd FROM b)
SELECT topic, ROUND(CAST(0.5 * rr + 0.3 * rq + 0.2 * rd AS DOUBLE), 6) AS composite FROM r"""


def ranked_axes(spark, d):
    return roles.brands(spark, d).select("*", stats.percentile_rank(F.col("revenue")).alias("rr"), stats.percentile_rank(F.col("quantity")).alias("rq"), stats.percentile_rank(F.col("discount")).alias("rd"))


def composite(spark, d):
    score = diagnostics.weighted({"a": F.col("rr"), "b": F.col("rq"), "c": F.col("rd")}, {"a": 0.5, "b": 0.3, "c": 0.2})
    return ranked_axes(spark, d).select("*", F.round(score, 6).alias("composite"))


@query(f"WITH c AS ({COMPOSITE}) SELECT topic, composite, CAST(ROW_NUMBER() OVER (ORDER BY composite DESC, topic) AS INTEGER) AS rank FROM c QUALIFY rank <= 10")
def w03_f19_h03_composite_shortlist(spark, d):
    place = F.row_number().over(Window.orderBy(F.desc("composite"), "topic"))
    return composite(spark, d).select("topic", "composite", place.alias("rank")).where("rank <= 10")


@query(f"SELECT topic, ROUND(CAST({rank_sql('revenue')} AS DOUBLE), 6) AS revenue_rank, ROUND(CAST({rank_sql('n')} AS DOUBLE), 6) AS n_rank FROM {BRANDS}")
def w01_percentile_rank(spark, d):
    rows = ranks.percentile_ranks(ranks.percentile_ranks(roles.brands(spark, d).cache(), "revenue", "rr"), "n", "rn")
    return rows.select("topic", F.round("rr", 6).alias("revenue_rank"), F.round("rn", 6).alias("n_rank"))


@query(f"SELECT doc_id, ROUND(CASE WHEN MIN(citations) OVER (PARTITION BY source) = MAX(citations) OVER (PARTITION BY source) THEN 0.5 ELSE CUME_DIST() OVER (PARTITION BY source ORDER BY citations) END, 9) AS percentile FROM {DOCS}")
def w02_j14_citation_percentile(spark, d):
    rows = ranks.shares_at_or_below(roles.docs(spark, d).select("doc_id", "source", "citations"), "citations", "p", ["source"])
    return rows.select("doc_id", F.round("p", 9).alias("percentile"))


# ---- scans and reads ----------------------------------------------------------------------------


@query(f"SELECT doc_id, source, year FROM {DOCS} WHERE source IN ('src0', 'src1', 'src2') AND year BETWEEN 2019 AND 2023 ORDER BY year, doc_id")
def a01_document_scan(spark, d):
    return roles.docs(spark, d).where(F.col("source").isin("src0", "src1", "src2") & F.col("year").between(2019, 2023)).select("doc_id", "source", "year").orderBy(F.col("year").asc_nulls_last(), "doc_id")


@query("SELECT COUNT(*) AS n FROM documents")
def a02_count_documents(spark, d):
    return read(spark, d, "documents").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id IN (SELECT doc_id * 3 FROM documents)")
def a03_j12_cached_vectors(spark, d):
    keys = read(spark, d, "documents").select((F.col("doc_id") * 3).alias("vec_id")).distinct()
    return read(spark, d, "embeddings").join(keys, "vec_id").select("vec_id", "label")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id * 2 FROM embeddings)")
def j12_missing_vectors(spark, d):
    return read(spark, d, "documents").select("doc_id").join(read(spark, d, "embeddings").select((F.col("vec_id") * 2).alias("doc_id")), "doc_id", "left_anti")


@query("SELECT p_type AS ref_type, p_name AS code, p_partkey AS ref_id FROM part WHERE p_size < 10 ORDER BY 1, 2, 3")
def a04_reference_scan(spark, d):
    return read(spark, d, "part").where("p_size < 10").select(F.col("p_type").alias("ref_type"), F.col("p_name").alias("code"), F.col("p_partkey").alias("ref_id")).orderBy(*[F.col(c).asc_nulls_last() for c in ("ref_type", "code", "ref_id")])


@query(f"SELECT topic, revenue FROM {BRANDS} WHERE topic LIKE 'Brand%' ORDER BY revenue DESC, topic")
def a05_topics_of_run(spark, d):
    return roles.brands(spark, d).where(F.col("topic").startswith("Brand")).select("topic", "revenue").orderBy(F.desc("revenue"), "topic")


@query("SELECT item_id, CAST(SUM(CASE WHEN LENGTH(text) < 300 THEN 1 ELSE 0 END) AS BIGINT) AS short, COUNT(*) AS copies FROM benchmark GROUP BY item_id HAVING COUNT(*) > 1 OR SUM(CASE WHEN LENGTH(text) < 300 THEN 1 ELSE 0 END) > 0")
def a08_validate_references(spark, d):
    found = read(spark, d, "benchmark").groupBy("item_id").agg(F.count_if(F.length("text") < 300).alias("short"), F.count(F.lit(1)).alias("copies"))
    return found.where("copies > 1 or short > 0")


@query("SELECT item_id, SUBSTRING(SHA256(LOWER(text)), 1, 16) AS fingerprint FROM benchmark")
def a10_fingerprint(spark, d):
    return read(spark, d, "benchmark").select("item_id", F.substring(F.sha2(F.lower("text"), 256), 1, 16).alias("fingerprint"))


@query("SELECT user_id, ARRAY_TO_STRING(LIST(DISTINCT event_type ORDER BY event_type), ';') AS kinds FROM events GROUP BY user_id")
def a23_csv_list_column(spark, d):
    return read(spark, d, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ";").alias("kinds"))


# ---- writes --------------------------------------------------------------------------------------

BATCH = "(SELECT doc_id, source, 1 AS seq FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id + 100, lang, 2 FROM documents WHERE doc_id % 2 = 0)"


def _batch(spark, d):
    docs = read(spark, d, "documents")
    return docs.where("doc_id % 3 = 0").select("doc_id", "source", F.lit(1).alias("seq")).union(docs.where("doc_id % 2 = 0").select(F.col("doc_id") + 100, "lang", F.lit(2)))


def _existing(spark, d):
    return read(spark, d, "documents").where("doc_id % 5 = 0").select("doc_id", "source", F.lit(0).alias("seq"))


@query(f"SELECT doc_id, source, seq FROM {BATCH} b WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 5 = 0) QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY seq) = 1")
def u01_insert_or_ignore(spark, d):
    return tables.insert_or_ignore(_existing(spark, d), _batch(spark, d), ["doc_id"], "seq")


@query(f"WITH b AS (SELECT * FROM {BATCH} QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY seq DESC) = 1) SELECT doc_id, source, 0 AS seq FROM documents WHERE doc_id % 5 = 0 AND doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT doc_id, source, seq FROM b")
def u02_insert_or_replace(spark, d):
    return tables.insert_or_replace(_existing(spark, d), _batch(spark, d), ["doc_id"], "seq")


@query("SELECT doc_id, source AS run_id FROM documents WHERE source <> 'src3' UNION ALL SELECT doc_id + 1000000, 'src3' FROM documents WHERE source = 'src4'")
def u03_u05_replace_by_run(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.col("source").alias("run_id"))
    new = rows.where("run_id = 'src4'").select((F.col("doc_id") + 1000000).alias("doc_id"), F.lit("src3").alias("run_id"))
    return tables.replace_run(rows, new, "src3")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') UNION ALL SELECT -1, -1")
def u04_j04_replace_children(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    parents = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("run_id"))
    return tables.replace_children(orders, parents, spark.createDataFrame([(-1, -1)], "o_orderkey long, o_custkey long"), "o_custkey", "BUILDING")


@query("SELECT user_id AS id, MAX_BY(event_type, event_id) AS status, SUBSTRING(MAX_BY(props, event_id), 1, 5) AS message FROM events GROUP BY user_id")
def u06_u07_run_log(spark, d):
    events = read(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"), F.col("props").alias("message"))
    return tables.run_status(events).select("id", "status", tables.log_message(F.col("message"), 5).alias("message"))


# ---- filters -------------------------------------------------------------------------------------


@query("SELECT SUBSTRING(SHA256(source || CHR(0) || CAST(doc_id AS VARCHAR)), 1, 32) AS id, TRIM(text) AS title, 2018 + doc_id % 9 AS year, CAST(2018 + doc_id % 9 AS VARCHAR) AS time_slice FROM documents")
def c01_x14_normalise_document(spark, d):
    docs = roles.docs(spark, d)
    return docs.select(text.document_id(F.col("source"), F.col("doc_id").cast("string")).alias("id"), F.trim("text").alias("title"), "year", F.col("year").cast("string").alias("time_slice"))


@query("SELECT doc_id, TRIM(COALESCE(text, '') || '. ' || COALESCE(lang, '')) AS body, SHA256('key' || CHR(0) || COALESCE(lang, '')) AS hash FROM documents")
def c02_x15_document_text(spark, d):
    return read(spark, d, "documents").select("doc_id", text.document_text(F.col("text"), F.col("lang")).alias("body"), text.content_hash(F.lit("key"), F.coalesce("lang", F.lit(""))).alias("hash"))


@query(f"SELECT doc_id, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'forming' ELSE 'attached' END AS role FROM {DOCS}")
def c03_role_split(spark, d):
    return roles.docs(spark, d).select("doc_id", F.when(F.col("source").isin("src1", "src2", "src3"), "forming").otherwise("attached").alias("role"))


RANKED = "(SELECT source, doc_id, CAST(citations AS DOUBLE) AS score, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id) AS pos, COUNT(*) OVER (PARTITION BY source) AS n FROM %s)" % DOCS
FLOORED = f"(SELECT *, MAX(CASE WHEN pos = LEAST(10, n) THEN score END) OVER (PARTITION BY source) * 0.2 AS floor FROM {RANKED})"


def _floored(spark, d):
    frame = Window.partitionBy("source")
    rows = roles.docs(spark, d).select("source", "doc_id", F.col("citations").cast("double").alias("score"))
    rows = rows.withColumn("pos", F.row_number().over(frame.orderBy("doc_id"))).withColumn("n", F.count(F.lit(1)).over(frame))
    return rows.withColumn("floor", F.max(F.when(F.col("pos") == F.least(F.lit(10), F.col("n")), F.col("score"))).over(frame) * 0.2)


@query(f"SELECT source, doc_id FROM {FLOORED} WHERE score >= floor")
def c04_relevance_floor(spark, d):
    return _floored(spark, d).where("score >= floor").select("source", "doc_id")


@query(f"SELECT source, doc_id FROM (SELECT *, MAX(CASE WHEN score < floor THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY pos) AS cut FROM {FLOORED}) WHERE cut = 0")
def c05_prefix_cut(spark, d):
    upto = Window.partitionBy("source").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return _floored(spark, d).withColumn("cut", F.max(F.col("score") < F.col("floor")).over(upto)).where("not cut").select("source", "doc_id")


@query("SELECT p_partkey FROM part WHERE LOWER(TRIM(p_type)) NOT IN ('standard brass', 'small steel') AND p_brand <> 'Brand#11'")
def c06_exclusions(spark, d):
    return read(spark, d, "part").where(~F.lower(F.trim("p_type")).isin("standard brass", "small steel") & (F.col("p_brand") != "Brand#11")).select("p_partkey")


def _hits(column, words):
    return sum((F.contains(column, F.lit(w)).cast("int") for w in words), F.lit(0))


@query("SELECT doc_id FROM (SELECT doc_id, LOWER(text) AS t FROM documents) WHERE CAST(CONTAINS(t, 'idiot') AS INT) + CAST(CONTAINS(t, 'thank') AS INT) + CAST(CONTAINS(t, 'license') AS INT) >= 1")
def c07_term_match(spark, d):
    return read(spark, d, "documents").where(_hits(F.lower("text"), ["idiot", "thank", "license"]) >= F.least(F.lit(1), F.lit(3))).select("doc_id")


@query("SELECT p_brand AS frame, p_partkey, score FROM (SELECT p_brand, p_partkey, 3 * CAST(CONTAINS(LOWER(p_name), 'a') AS INT) + CAST(CONTAINS(LOWER(p_type), 'steel') AS INT) AS score, p_size FROM part) WHERE score >= 1 QUALIFY ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY score DESC, p_size DESC, p_partkey) <= 5")
def c08_catalogue_match(spark, d):
    score = 3 * _hits(F.lower("p_name"), ["a"]) + _hits(F.lower("p_type"), ["steel"])
    rows = read(spark, d, "part").select(F.col("p_brand").alias("frame"), "p_partkey", "p_size", score.alias("score")).where("score >= 1")
    place = F.row_number().over(Window.partitionBy("frame").orderBy(F.desc("score"), F.desc("p_size"), "p_partkey"))
    return rows.withColumn("rn", place).where("rn <= 5").select("frame", "p_partkey", "score")


@query("SELECT doc_id FROM documents WHERE 2018 + doc_id % 9 BETWEEN 2020 AND 2022 AND LOWER(TRIM(COALESCE(lang, ''))) IN ('', 'english', 'en') AND source IN ('src1', 'src5')")
def c09_c11_window_language_frame(spark, d):
    rows = roles.docs(spark, d).where(F.col("year").between(2020, 2022) & F.lower(F.trim(F.coalesce("steepv", F.lit("")))).isin("", "english", "en"))
    return rows.join(F.broadcast(spark.createDataFrame([("src1",), ("src5",)], "source string")), "source", "left_semi").select("doc_id")


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#22') AND CONTAINS(LOWER(CONCAT_WS(' ', p_name, p_type)), 'st') AND (p_size IS NULL OR p_size BETWEEN 5 AND 30)")
def c12_c13_explorer_filters(spark, d):
    return read(spark, d, "part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#22") & F.contains(F.lower(F.concat_ws(" ", "p_name", "p_type")), F.lit("st")) & (F.col("p_size").isNull() | F.col("p_size").between(5, 30))).select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE CONTAINS(LOWER(CAST(c_custkey AS VARCHAR)), '12') OR CONTAINS(LOWER(c_name), '12') OR CONTAINS(LOWER(c_mktsegment), '12')")
def c14_any_column_search(spark, d):
    fields = F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    return read(spark, d, "customer").where(F.exists(fields, lambda c: F.contains(F.lower(c), F.lit("12")))).select("c_custkey")


@query(f"SELECT source, steepv, doc_id FROM {DOCS} QUALIFY ROW_NUMBER() OVER (PARTITION BY source, steepv ORDER BY doc_id) <= 3")
def c15_sample_cap(spark, d):
    place = F.row_number().over(Window.partitionBy("source", "steepv").orderBy("doc_id"))
    return roles.docs(spark, d).withColumn("rn", place).where("rn <= 3").select("source", "steepv", "doc_id")


# ---- joins ---------------------------------------------------------------------------------------


@query("SELECT l_suppkey AS topic_id, o_orderkey AS doc_id, ROUND(l_extendedprice, 2) AS similarity FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, o_totalprice DESC, o_orderkey) <= 5")
def j01_h04_evidence(spark, d):
    members = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("topic_id"), F.col("l_orderkey").alias("doc_id"), F.col("l_extendedprice").alias("similarity"))
    docs = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("citation_count"))
    return tables.evidence(members, docs, 5).select("topic_id", "doc_id", F.round("similarity", 2).alias("similarity"))


@query("SELECT c_mktsegment, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def j02_j05_j07_memberships(spark, d):
    customers = read(spark, d, "customer")
    return read(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query(f"WITH c AS ({COMPOSITE}) SELECT b.topic, c.composite, b.revenue FROM {BRANDS} b JOIN c ON b.topic = c.topic ORDER BY composite DESC, b.topic LIMIT 7")
def j03_j06_ranked_topics(spark, d):
    return roles.brands(spark, d).join(composite(spark, d).select("topic", "composite"), "topic").select("topic", "composite", "revenue").orderBy(F.desc("composite"), "topic").limit(7)


@query("SELECT n_nationkey, COALESCE(s.n, 0) AS suppliers, COALESCE(c.n, 0) AS customers FROM nation LEFT JOIN (SELECT s_nationkey, COUNT(*) n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey LEFT JOIN (SELECT c_nationkey, COUNT(*) n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) c ON c_nationkey = n_nationkey")
def j08_j11_left_merge(spark, d):
    suppliers = read(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    customers = read(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return read(spark, d, "nation").select("n_nationkey").join(suppliers, "n_nationkey", "left").join(customers, "n_nationkey", "left").na.fill(0, ["suppliers", "customers"])


CENTROIDS = f"(SELECT topic, LIST(x / norm ORDER BY k) AS centroid FROM (SELECT *, SQRT(SUM(x * x) OVER (PARTITION BY topic)) AS norm FROM (SELECT topic, k, AVG(CAST(embedding[k] AS DOUBLE)) AS x FROM {POINTS} p, (SELECT UNNEST(RANGE(1, 65)) AS k) GROUP BY topic, k)) GROUP BY topic)"


def _centroids(spark, d):
    return vectors.centroids(roles.points(spark, d), "topic", "embedding")


@query(f"SELECT vec_id, topic, ROUND(s, 6) AS similarity FROM (SELECT p.vec_id, c.topic, LIST_DOT_PRODUCT(CAST(p.embedding AS DOUBLE[]), c.centroid) AS s FROM {POINTS} p, {CENTROIDS} c) QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY s DESC, topic) = 1 AND s >= 0.3")
def j09_attach_nearest(spark, d):
    return vectors.attach(roles.points(spark, d), "vec_id", "embedding", _centroids(spark, d), "topic", 0.3).select("vec_id", "topic", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT topic, ROUND(LIST_DOT_PRODUCT(centroid, centroid), 6) AS length, ROUND(centroid[1], 6) AS first FROM {CENTROIDS}")
def g17_x09_centroid(spark, d):
    return _centroids(spark, d).select("topic", F.round(stats.dot(F.col("centroid"), F.col("centroid")), 6).alias("length"), F.round(F.col("centroid")[0], 6).alias("first"))


@query(f"SELECT topic, ROUND(AVG(LEAST(GREATEST(LIST_DOT_PRODUCT(CAST(p.embedding AS DOUBLE[]), c.centroid), 0), 1)), 6) AS coherence FROM {POINTS} p JOIN {CENTROIDS} c USING (topic) GROUP BY topic")
def g18_x10_coherence(spark, d):
    rows = roles.points(spark, d).join(_centroids(spark, d), "topic")
    return rows.groupBy("topic").agg(F.round(F.avg(stats.clip(stats.dot(F.col("embedding").cast("array<double>"), F.col("centroid")))), 6).alias("coherence"))


@query(f"WITH c AS {CENTROIDS}, e AS (SELECT LIST(x / norm ORDER BY k) AS early FROM (SELECT *, SQRT(SUM(x * x) OVER ()) AS norm FROM (SELECT k, AVG(CAST(embedding[k] AS DOUBLE)) AS x FROM {POINTS} p, (SELECT UNNEST(RANGE(1, 65)) AS k) WHERE slice < 2021 GROUP BY k))) SELECT topic, ROUND(LEAST(GREATEST(1 - LIST_DOT_PRODUCT(centroid, early), 0), 1), 6) AS novelty FROM c, e")
def f04_novelty(spark, d):
    early = vectors.centroids(roles.points(spark, d).where("slice < 2021").withColumn("all", F.lit(1)), "all", "embedding").select(F.col("centroid").alias("early"))
    return _centroids(spark, d).join(F.broadcast(early)).select("topic", F.round(stats.clip(1 - stats.dot(F.col("centroid"), F.col("early"))), 6).alias("novelty"))


@query(f"SELECT a.vec_id AS a, b.vec_id AS b, ROUND(LIST_DOT_PRODUCT(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM {POINTS} a JOIN {POINTS} b ON a.vec_id <> b.vec_id QUALIFY ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY LIST_DOT_PRODUCT(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) <= 5")
def w14_j15_nearest_neighbours(spark, d):
    rows = roles.points(spark, d)
    return vectors.nearest(rows, "vec_id", "embedding", 5).select("a", "b", F.round(-F.col("distance"), 6).alias("similarity"))


@query(f"WITH k AS (SELECT a.vec_id AS a, a.topic AS ta, b.topic AS tb FROM {POINTS} a JOIN {POINTS} b ON a.vec_id <> b.vec_id QUALIFY ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY LIST_DOT_PRODUCT(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) <= 5) SELECT ta AS topic, ROUND(AVG(CASE WHEN ta = tb THEN 1.0 ELSE 0.0 END), 6) AS purity FROM k GROUP BY ta")
def k12_neighbour_purity(spark, d):
    rows = roles.points(spark, d)
    near = vectors.nearest(rows, "vec_id", "embedding", 5)
    at = rows.select(F.col("vec_id").alias("a"), "topic").alias("x")
    other = rows.select(F.col("vec_id").alias("b"), F.col("topic").alias("topic_b"))
    return near.join(at, "a").join(other, "b").groupBy("topic").agg(F.round(F.avg((F.col("topic") == F.col("topic_b")).cast("double")), 6).alias("purity"))


@query("WITH s AS (SELECT l_suppkey, l_partkey, MAX_BY(l_quantity, l_shipdate::VARCHAR || LPAD(CAST(l_orderkey AS VARCHAR), 10, '0') || l_linenumber) AS latest FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_partkey, latest, p_brand FROM s JOIN part ON p_partkey = l_partkey")
def j13_latest_release(spark, d):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    latest = read(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max_by("l_quantity", order).alias("latest"))
    return latest.join(read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").select("l_suppkey", "l_partkey", "latest", "p_brand")
