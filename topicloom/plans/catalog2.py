"""The catalog's second part: aggregates, scores, series, text, diagnostics. Importing it registers the queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from topicloom.functions import stats, text
from topicloom.operators import diagnostics, entropy, linkage, ranks, references, series, topics, vectors
from topicloom.plans import roles
from topicloom.plans.catalog import CENTROIDS, COMPOSITE, composite, query, ranked_axes
from topicloom.plans.roles import BRANDS, DOCS, ITEM_YEARS, POINTS, USER_DAYS, rank_sql
from topicloom.session import read

# ---- aggregates ----------------------------------------------------------------------------------


@query("SELECT o_orderpriority AS source, o_orderstatus AS status, COUNT(*) AS n, CAST(SUM(o_custkey) AS BIGINT) AS records FROM orders GROUP BY 1, 2")
def g01_collection_summary(spark, d):
    return read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("records"))


@query("SELECT o_custkey AS source, CAST(SUM(o_orderkey) AS BIGINT) AS records, MIN(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS worst FROM orders GROUP BY o_custkey ORDER BY records DESC, source")
def g02_worst_status(spark, d):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return read(spark, d, "orders").groupBy(F.col("o_custkey").alias("source")).agg(F.sum("o_orderkey").alias("records"), F.min(rank).alias("worst")).orderBy(F.desc("records"), "source")


@query(f"SELECT source, COUNT(*) AS n, MIN(year) AS first_year, MAX(year) AS last_year, COUNT(DISTINCT steepv) AS frames, MIN(steepv) AS some_frame FROM {DOCS} WHERE source IS NOT NULL GROUP BY source")
def g03_g04_per_source(spark, d):
    return roles.docs(spark, d).where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_distinct("steepv").alias("frames"), F.min("steepv").alias("some_frame"))


@query(f"SELECT year, steepv, COUNT(*) AS n FROM {DOCS} GROUP BY year, steepv")
def g05_g13_g36_counts(spark, d):
    return roles.docs(spark, d).groupBy("year", "steepv").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_type AS ref_type, COUNT(*) AS n, ROUND(AVG(p_size), 2) AS weight FROM part GROUP BY p_type")
def g06_references_by_type(spark, d):
    return read(spark, d, "part").groupBy(F.col("p_type").alias("ref_type")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_size"), 2).alias("weight"))


@query("SELECT MIN(c_acctbal) AS low, MAX(c_acctbal) AS high, CASE WHEN MAX(c_nationkey) = MIN(c_nationkey) THEN MIN(c_nationkey) + 1e-9 ELSE CAST(MAX(c_nationkey) AS DOUBLE) END AS widened FROM customer")
def g07_g33_extents(spark, d):
    low, high = F.min("c_nationkey"), F.max("c_nationkey")
    return read(spark, d, "customer").agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"), F.when(low == high, low + 1e-9).otherwise(high.cast("double")).alias("widened"))


@query("SELECT COUNT(*) FILTER (WHERE o_totalprice < 50000) AS suppressed, COUNT(*) FILTER (WHERE ABS(o_totalprice - 100000) < 500 OR ABS(o_totalprice - 200000) < 500) AS borderline FROM orders")
def g08_g09_conditional_counts(spark, d):
    price = F.col("o_totalprice")
    return read(spark, d, "orders").agg(F.count_if(price < 50000).alias("suppressed"), F.count_if((F.abs(price - 100000) < 500) | (F.abs(price - 200000) < 500)).alias("borderline"))


@query("SELECT DISTINCT o_orderpriority AS run_id FROM orders ORDER BY run_id DESC")
def g10_run_ids(spark, d):
    return read(spark, d, "orders").select(F.col("o_orderpriority").alias("run_id")).distinct().orderBy(F.desc("run_id"))


@query("SELECT user_id, MAX_BY(props, event_id) AS snapshot, MAX(event_id) AS id FROM events WHERE props <> '' GROUP BY user_id")
def g11_latest_snapshot(spark, d):
    return read(spark, d, "events").where("props <> ''").groupBy("user_id").agg(F.max_by("props", "event_id").alias("snapshot"), F.max("event_id").alias("id"))


@query("SELECT user_id, ROUND(DATE_DIFF('millisecond', MIN(ts), MAX(ts)) / 1000, 1) AS seconds FROM events GROUP BY user_id")
def g12_durations(spark, d):
    return read(spark, d, "events").groupBy("user_id").agg(F.round(F.timestamp_diff("MILLISECOND", F.min("ts"), F.max("ts")) / F.lit(1000.0), 1).alias("seconds"))


@query(f"SELECT year AS slice, COUNT(*) AS total, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share, CAST(ROW_NUMBER() OVER (ORDER BY year) AS INTEGER) AS place FROM {DOCS} WHERE year IS NOT NULL GROUP BY year")
def g13_slice_totals(spark, d):
    totals = series.slice_totals(roles.docs(spark, d), "year")
    return totals.select(F.col("year").alias("slice"), "total", F.round("share", 6).alias("share"), "place")


@query(f"WITH s AS (SELECT steepv AS topic, source AS c FROM {DOCS}), y AS (SELECT steepv AS topic, year AS c FROM {DOCS}), e AS (SELECT k, topic, CASE WHEN COUNT(*) < 2 THEN 0 ELSE -SUM(p * LN(p)) / LN(COUNT(*)) END AS e FROM (SELECT k, topic, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY k, topic) AS p FROM (SELECT 1 AS k, * FROM s UNION ALL SELECT 2, * FROM y) WHERE c IS NOT NULL GROUP BY k, topic, c) GROUP BY k, topic) SELECT topic, ROUND(MAX(CASE WHEN k = 1 THEN e END), 6) AS entropy, ROUND(AVG(e), 6) AS uncertainty FROM e GROUP BY topic")
def g20_g21_entropy(spark, d):
    rows = roles.docs(spark, d).withColumnRenamed("steepv", "topic")
    one, mean = entropy.normalised_entropy(rows, "topic", "source"), entropy.mean_entropy(rows, "topic", ["source", "year"]).withColumnRenamed("entropy", "uncertainty")
    return one.join(mean, "topic").select("topic", F.round("entropy", 6).alias("entropy"), F.round("uncertainty", 6).alias("uncertainty"))


@query(f"SELECT steepv AS topic, ROUND(AVG(p), 6) AS impact FROM (SELECT steepv, CUME_DIST() OVER (PARTITION BY source ORDER BY citations) AS p FROM {DOCS}) GROUP BY steepv")
def g19_impact(spark, d):
    rows = ranks.shares_at_or_below(roles.docs(spark, d).select("steepv", "source", "citations"), "citations", "p", ["source"])
    return rows.groupBy(F.col("steepv").alias("topic")).agg(F.round(F.avg("p"), 6).alias("impact"))


YEARS = f"(SELECT DISTINCT slice FROM {ITEM_YEARS})"
FILLED = f"(SELECT t.topic, s.slice, COALESCE(c.n, 0) AS n, s.total FROM (SELECT DISTINCT topic FROM {ITEM_YEARS}) t CROSS JOIN (SELECT slice, COUNT(*) AS total FROM {ITEM_YEARS} GROUP BY slice) s LEFT JOIN (SELECT topic, slice, COUNT(*) AS n FROM {ITEM_YEARS} GROUP BY 1, 2) c ON c.topic = t.topic AND c.slice = s.slice)"


def _item_years(spark, d):
    return roles.items(spark, d).select("topic", F.year("l_shipdate").cast("long").alias("slice"))


def _filled(spark, d):
    return series.zero_filled(_item_years(spark, d), "topic", "slice")


@query(f"SELECT topic, CAST(day AS VARCHAR) AS day, n, total FROM (SELECT t.topic, s.day, COALESCE(c.n, 0) AS n, s.total FROM (SELECT DISTINCT topic FROM {USER_DAYS}) t CROSS JOIN (SELECT day, COUNT(*) AS total FROM {USER_DAYS} GROUP BY day) s LEFT JOIN (SELECT topic, day, COUNT(*) AS n FROM {USER_DAYS} GROUP BY 1, 2) c ON c.topic = t.topic AND c.day = s.day)")
def w04_a06_zero_filled(spark, d):
    return series.zero_filled(roles.user_days(spark, d), "topic", "day").select("topic", F.col("day").cast("string").alias("day"), "n", "total")


@query(f"SELECT topic, slice, CAST(cumulative AS BIGINT) AS cumulative FROM (SELECT topic, slice, SUM(n) OVER (PARTITION BY topic ORDER BY slice) AS cumulative FROM {FILLED}) WHERE cumulative > 0")
def w05_cumulative(spark, d):
    return series.cumulative(_filled(spark, d), "topic", "slice").select("topic", "slice", "cumulative")


@query(f"SELECT topic, ROUND(AVG(CASE WHEN total > 0 THEN n / total ELSE 0 END), 6) AS proportion, MIN(CASE WHEN n > 0 THEN slice END) AS first_slice, MAX(CASE WHEN n > 0 THEN slice END) AS last_slice FROM {FILLED} GROUP BY topic")
def g22_g23_proportion(spark, d):
    share = F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(0.0)
    held = F.when(F.col("n") > 0, F.col("slice"))
    return _filled(spark, d).groupBy("topic").agg(F.round(F.avg(share), 6).alias("proportion"), F.min(held).alias("first_slice"), F.max(held).alias("last_slice"))


SERIES = f"(SELECT topic, LIST(CAST(n AS DOUBLE) ORDER BY slice) AS s FROM {FILLED} GROUP BY topic)"
CAGR = f"(SELECT topic, CASE WHEN LEN(s) < 4 OR LIST_SUM(s) <= 0 THEN 0 WHEN s[-1] + s[-2] <= 0 THEN -1 ELSE POW(((s[-1] + s[-2]) / 2) / GREATEST((s[1] + s[2]) / 2, 0.5), 1.0 / (LEN(s) - 1)) - 1 END AS cagr FROM {SERIES})"


#: Counts (topic, slice, n, total) to states and weights of the two-state automaton, with s = 2 and gamma = 0.5.
BURST_STEPS = """f AS (SELECT topic, n AS r, total AS d, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY slice) AS i FROM {0}),
p AS (SELECT *, CAST(SUM(r) OVER w AS DOUBLE) / SUM(d) OVER w AS p0, COUNT(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY topic)),
e AS (SELECT topic, i, n, -(r * LN(p0) + (d - r) * LN(1 - p0)) AS c0, -(r * LN(LEAST(p0 * 2, 1 - 1e-9)) + (d - r) * LN(1 - LEAST(p0 * 2, 1 - 1e-9))) AS c1, 0.5 * LN(n) AS tau FROM p),
v AS (SELECT topic, i, c0 AS b0, c1 AS b1, 0 AS f0, 1 AS f1 FROM e WHERE i = 1
 UNION ALL SELECT e.topic, e.i, LEAST(v.b0, v.b1 + tau) + c0, LEAST(v.b1, v.b0 + tau) + c1, CASE WHEN v.b0 <= v.b1 + tau THEN 0 ELSE 1 END, CASE WHEN v.b1 <= v.b0 + tau THEN 1 ELSE 0 END FROM v JOIN e ON e.topic = v.topic AND e.i = v.i + 1),
h AS (SELECT v.topic, v.i, CASE WHEN b0 <= b1 THEN 0 ELSE 1 END AS st FROM v JOIN (SELECT topic, MAX(i) AS last FROM e GROUP BY topic) l ON l.topic = v.topic AND l.last = v.i
 UNION ALL SELECT v.topic, v.i - 1, CASE WHEN h.st = 0 THEN v.f0 ELSE v.f1 END FROM h JOIN v ON v.topic = h.topic AND v.i = h.i WHERE v.i > 1),
w AS (SELECT h.topic, h.i, h.st, CASE WHEN h.st = 1 THEN GREATEST(c0 - c1, 0) ELSE 0 END AS weight, n FROM h JOIN e ON e.topic = h.topic AND e.i = h.i)"""


@query(f"""WITH RECURSIVE {BURST_STEPS.format(FILLED)}, b AS (SELECT topic, CASE WHEN MAX(st) = 0 OR MAX(weight) <= 0 THEN 0 ELSE 0.5 * MAX(weight) / (MAX(weight) + 10) + 0.5 * MAX(weight) / (MAX(weight) + 10) * MAX(CASE WHEN st = 1 THEN i END) / MAX(n) END AS burst FROM w GROUP BY topic)
SELECT topic, ROUND(CAST(cagr AS DOUBLE), 6) AS cagr, ROUND(CAST(CASE WHEN cagr <= 0 THEN 0 ELSE cagr / (cagr + 1) END AS DOUBLE), 6) AS squashed, ROUND(burst, 6) AS burst, ROUND(CAST(LEAST(GREATEST(0.6 * CASE WHEN cagr <= 0 THEN 0 ELSE cagr / (cagr + 1) END + 0.4 * burst, 0), 1) AS DOUBLE), 6) AS growth FROM {CAGR} JOIN b USING (topic)""")
def f01_f02_f03_growth(spark, d):
    rows = series.bursts(series.series(_filled(spark, d), "topic", "slice"), 2.0, 0.5)
    rows = rows.select("topic", stats.cagr(F.col("counts")).alias("c"), stats.burst_score(F.col("states"), F.col("max_weight")).alias("b"))
    squashed = stats.squash(F.col("c"))
    return rows.select("topic", F.round("c", 6).alias("cagr"), F.round(squashed, 6).alias("squashed"), F.round("b", 6).alias("burst"), F.round(stats.clip(0.6 * squashed + 0.4 * F.col("b")), 6).alias("growth"))


BURSTS = f"""WITH RECURSIVE f AS (SELECT t.topic, s.day, COALESCE(c.n, 0) AS r, s.total AS d, ROW_NUMBER() OVER (PARTITION BY t.topic ORDER BY s.day) AS i FROM (SELECT DISTINCT topic FROM {USER_DAYS}) t CROSS JOIN (SELECT day, COUNT(*) AS total FROM {USER_DAYS} GROUP BY day) s LEFT JOIN (SELECT topic, day, COUNT(*) AS n FROM {USER_DAYS} GROUP BY 1, 2) c ON c.topic = t.topic AND c.day = s.day),
p AS (SELECT *, CAST(SUM(r) OVER w AS DOUBLE) / SUM(d) OVER w AS p0, COUNT(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY topic)),
e AS (SELECT topic, i, n, -(r * LN(p0) + (d - r) * LN(1 - p0)) AS c0, -(r * LN(LEAST(p0 * 2, 1 - 1e-9)) + (d - r) * LN(1 - LEAST(p0 * 2, 1 - 1e-9))) AS c1, 0.5 * LN(n) AS tau FROM p),
v AS (SELECT topic, i, c0 AS b0, c1 AS b1, 0 AS f0, 1 AS f1 FROM e WHERE i = 1
 UNION ALL SELECT e.topic, e.i, LEAST(v.b0, v.b1 + tau) + c0, LEAST(v.b1, v.b0 + tau) + c1, CASE WHEN v.b0 <= v.b1 + tau THEN 0 ELSE 1 END, CASE WHEN v.b1 <= v.b0 + tau THEN 1 ELSE 0 END FROM v JOIN e ON e.topic = v.topic AND e.i = v.i + 1),
b AS (SELECT v.topic, v.i, CASE WHEN b0 <= b1 THEN 0 ELSE 1 END AS st FROM v JOIN (SELECT topic, MAX(i) AS last FROM e GROUP BY topic) l ON l.topic = v.topic AND l.last = v.i
 UNION ALL SELECT v.topic, v.i - 1, CASE WHEN b.st = 0 THEN v.f0 ELSE v.f1 END FROM b JOIN v ON v.topic = b.topic AND v.i = b.i WHERE v.i > 1),
w AS (SELECT b.topic, b.i, b.st, CASE WHEN b.st = 1 THEN GREATEST(c0 - c1, 0) ELSE 0 END AS weight, n FROM b JOIN e ON e.topic = b.topic AND e.i = b.i)
SELECT topic, STRING_AGG(CAST(st AS VARCHAR), '' ORDER BY i) AS states, ROUND(SUM(weight), 6) AS total_weight, ROUND(CASE WHEN MAX(st) = 0 OR MAX(weight) <= 0 THEN 0 ELSE 0.5 * MAX(weight) / (MAX(weight) + 10) + 0.5 * MAX(weight) / (MAX(weight) + 10) * MAX(CASE WHEN st = 1 THEN i END) / MAX(n) END, 6) AS score FROM w GROUP BY topic"""


@query(BURSTS)
def w06_w07_w08_f21_bursts(spark, d):
    filled = series.zero_filled(roles.user_days(spark, d), "topic", "day")
    rows = series.bursts(series.series(filled, "topic", "day"), 2.0, 0.5)
    return rows.select("topic", F.array_join(F.col("states").cast("array<string>"), "").alias("states"), F.round("total_weight", 6).alias("total_weight"), F.round(stats.burst_score(F.col("states"), F.col("max_weight")), 6).alias("score"))


MATURITY = f"""WITH y AS (SELECT topic, LIST(CAST(c AS DOUBLE) ORDER BY slice) AS y FROM (SELECT topic, slice, SUM(n) OVER (PARTITION BY topic ORDER BY slice) AS c FROM {FILLED}) WHERE c > 0 GROUP BY topic),
s AS (SELECT *, LEN(y) AS n, LIST_SUM(LIST_TRANSFORM(y, lambda x: x * x)) AS yy, LIST_SUM(LIST_TRANSFORM(y, lambda x: (x - LIST_AVG(y)) * (x - LIST_AVG(y)))) AS tot FROM y),
g AS (SELECT topic, y, n, yy, tot, CAST(0.2 + 0.1 * r AS DOUBLE) AS rate, -n + k * CAST(0.5 AS DOUBLE) AS t0 FROM s, (SELECT UNNEST(RANGE(29)) AS r), (SELECT topic AS tt, UNNEST(RANGE(6 * n)) AS k FROM s) WHERE tt = topic AND n >= 4 AND tot > 0),
u AS (SELECT topic, y[-1] AS last, yy, tot, LIST_SUM(LIST_TRANSFORM(y, lambda x, i: x / (1 + EXP(-rate * (i - 1 - t0))))) AS yl, LIST_SUM(LIST_TRANSFORM(y, lambda x, i: POW(1 / (1 + EXP(-rate * (i - 1 - t0))), 2))) AS ll FROM g),
m AS (SELECT CAST(CASE WHEN j < 20 THEN 1 + 0.1 * j ELSE 3 + 0.5 * (j - 20) END AS DOUBLE) AS m, j FROM (SELECT UNNEST(RANGE(55)) AS j)),
r AS (SELECT topic, j, m, ROUND(1 - MIN(yy - 2 * m * last * yl + m * last * m * last * ll) / MAX(tot), 12) AS r2 FROM u, m GROUP BY topic, j, m)
SELECT topic, ROUND(CASE WHEN r2 >= 0 THEN 1 / m ELSE 0.5 END, 6) AS maturity, ROUND(GREATEST(r2, 0), 6) AS fit, CASE WHEN 1 / m >= 0.75 THEN 'H1' WHEN 1 / m >= 0.35 THEN 'H2' ELSE 'H3' END AS horizon FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY r2 DESC, j) = 1"""


@query(MATURITY)
def k08_f05_maturity(spark, d):
    fitted = series.maturity(series.series(_filled(spark, d), "topic", "slice"), "topic")
    return fitted.select("topic", F.round("maturity", 6).alias("maturity"), F.round("fit", 6).alias("fit"), stats.horizon(F.col("maturity")).alias("horizon"))


@query(f"SELECT MEDIAN(revenue) AS middle, QUANTILE_CONT(CAST(quantity AS DOUBLE), 0.6) AS p60, QUANTILE_CONT(CAST(discount AS DOUBLE), 0.25) AS p25 FROM {BRANDS}")
def g26_g27_percentiles(spark, d):
    rows = roles.brands(spark, d).cache()
    one = lambda value, name, q: ranks.quantiles(rows, value, {name: q})
    return one("revenue", "middle", 0.5).join(one("quantity", "p60", 0.6)).join(one("discount", "p25", 0.25))


@query(f"SELECT topic, CASE WHEN large AND fast THEN 'strong' WHEN fast THEN 'weak' WHEN large THEN 'latent' ELSE 'noise' END AS signal, CASE WHEN large AND fast THEN 'd' WHEN fast THEN 'c' WHEN large THEN 'b' ELSE 'a' END AS quadrant FROM (SELECT topic, revenue >= MEDIAN(revenue) OVER () AS large, discount >= MEDIAN(discount) OVER () AS fast FROM {BRANDS})")
def f06_f20_classes(spark, d):
    rows = roles.brands(spark, d)
    cuts = rows.agg(F.median("revenue").alias("cr"), F.median("discount").alias("cd"))
    rows = rows.join(F.broadcast(cuts))
    args = (F.col("revenue"), F.col("discount"), F.col("cr"), F.col("cd"))
    return rows.select("topic", stats.signal_class(*args).alias("signal"), stats.quadrant(*args, ["a", "b", "c", "d"]).alias("quadrant"))


@query(f"WITH r AS (SELECT topic, {rank_sql('revenue')} AS a, {rank_sql('quantity')} AS b, {rank_sql('discount')} AS c, {rank_sql('n')} AS e FROM {BRANDS}) SELECT topic, ROUND(CAST(0.25 * a + 0.25 * b + 0.2 * c + 0.3 * e AS DOUBLE), 6) AS emergence FROM r")
def f07_emergence(spark, d):
    rows = ranked_axes(spark, d).withColumn("rn", stats.percentile_rank(F.col("n")))
    score = diagnostics.weighted({"a": F.col("rr"), "b": F.col("rq"), "c": F.col("rd"), "d": F.col("rn")}, {"a": 0.25, "b": 0.25, "c": 0.2, "d": 0.3})
    return rows.select("topic", F.round(score, 6).alias("emergence"))


@query(f"WITH r AS (SELECT topic, n, {rank_sql('revenue')} AS a, {rank_sql('quantity')} AS b FROM {BRANDS}) SELECT topic, CASE WHEN n < 2380 THEN NULL ELSE ROUND(CAST(ROUND(a, 4) * 0.4 / 0.7 + ROUND(b, 4) * 0.3 / 0.7 AS DOUBLE), 6) END AS opportunity, n < 2380 AS suppressed FROM r")
def f17_f18_g25_opportunity_index(spark, d):
    weights = diagnostics.redistribute({"a": 0.4, "b": 0.3, "c": 0.3}, {"a", "b"})
    index = diagnostics.weighted({"a": F.round("rr", 4), "b": F.round("rq", 4)}, weights)
    low = F.col("n") < 2380
    return ranked_axes(spark, d).select("topic", F.when(~low, F.round(index, 6)).alias("opportunity"), low.alias("suppressed"))


@query("""WITH y AS (SELECT event_type AS topic, CAST(DATE_TRUNC('month', ts) AS DATE) AS slice, COUNT(*) AS n FROM events GROUP BY 1, 2), f AS (SELECT t.topic, s.slice, COALESCE(y.n, 0) AS n FROM (SELECT DISTINCT topic FROM y) t CROSS JOIN (SELECT DISTINCT slice FROM y) s LEFT JOIN y ON y.topic = t.topic AND y.slice = s.slice),
s AS (SELECT topic, LIST(CAST(n AS DOUBLE) ORDER BY slice) AS s FROM f GROUP BY topic), c AS (SELECT topic, CASE WHEN LEN(s) < 4 OR LIST_SUM(s) <= 0 THEN 0 WHEN s[-1] + s[-2] <= 0 THEN -1 ELSE POW(((s[-1] + s[-2]) / 2) / GREATEST((s[1] + s[2]) / 2, 0.5), 1.0 / (LEN(s) - 1)) - 1 END AS cagr FROM s)
SELECT topic, research, attention, tone, ROUND(CAST(GREATEST(cagr, 0) * research / total AS DOUBLE), 6) AS research_growth FROM (SELECT event_type AS topic, COUNT(*) AS total, COUNT(*) FILTER (WHERE user_id < 50) AS research, COUNT(*) FILTER (WHERE user_id BETWEEN 50 AND 99) AS attention, ROUND(COALESCE(LEAST(GREATEST((AVG(CASE WHEN user_id BETWEEN 50 AND 99 THEN value - 50 END) + 10) / 20, 0), 1), 0.5), 6) AS tone FROM events GROUP BY event_type) JOIN c USING (topic)""")
def g24_f14_f15_source_split(spark, d):
    rows = read(spark, d, "events").select(F.col("event_type").alias("topic"), F.trunc("ts", "month").alias("slice"), "user_id", "value")
    research, attention = F.col("user_id") < 50, F.col("user_id").between(50, 99)
    tone = stats.tone_share(F.avg(F.when(attention, F.col("value") - 50)))
    split = rows.groupBy("topic").agg(F.count_if(research).alias("research"), F.count_if(attention).alias("attention"), F.round(tone, 6).alias("tone"), F.count(F.lit(1)).alias("total"))
    growth = series.series(series.zero_filled(rows, "topic", "slice"), "topic", "slice").select("topic", stats.cagr(F.col("counts")).alias("cagr"))
    grown = stats.research_growth(F.col("cagr"), F.col("research") / F.col("total"))
    return split.join(growth, "topic").select("topic", "research", "attention", "tone", F.round(grown, 6).alias("research_growth"))


@query(f"SELECT year, source, COUNT(d.year) AS n, ANY_VALUE(of_year) AS of_year, ANY_VALUE(of_source) AS of_source FROM (SELECT year, COUNT(*) AS of_year FROM {DOCS} GROUP BY year) CROSS JOIN (SELECT source, COUNT(*) AS of_source FROM {DOCS} GROUP BY source) LEFT JOIN {DOCS} d USING (year, source) GROUP BY year, source")
def g28_crosstab(spark, d):
    return series.crosstab(roles.docs(spark, d), "year", "source")


@query("SELECT l_linenumber AS threshold, COUNT(*) AS clusters, CAST(SUM(n) AS BIGINT) AS docs, MAX(n) AS largest, MEDIAN(n) AS middle, ROUND(MAX(n) / SUM(n), 6) AS share FROM (SELECT l_linenumber, l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_linenumber")
def g29_k24_sweep_summary(spark, d):
    sizes = read(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("threshold"), "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("threshold").agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("docs"), F.max("n").alias("largest"), F.median("n").alias("middle"), F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query("SELECT MIN_BY(threshold, threshold) AS first_healthy FROM (SELECT l_linenumber AS threshold, MAX(n) / SUM(n) AS share FROM (SELECT l_linenumber, l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1) WHERE share < 0.25")
def h10_first_healthy(spark, d):
    return g29_k24_sweep_summary(spark, d).where("share < 0.25").agg(F.min_by("threshold", "threshold").alias("first_healthy"))


@query("SELECT cut, ROUND(AVG(CASE WHEN c_acctbal >= cut THEN 1.0 ELSE 0.0 END), 6) AS share, ROUND(QUANTILE_CONT(c_acctbal, 0.1), 4) AS p10, ROUND(QUANTILE_CONT(c_acctbal, 0.9), 4) AS p90 FROM customer, (SELECT UNNEST([0, 2500, 5000]) AS cut) GROUP BY cut")
def g30_distribution(spark, d):
    rows = read(spark, d, "customer").select("c_acctbal", F.explode(F.array(F.lit(0), F.lit(2500), F.lit(5000))).alias("cut"))
    shares = rows.groupBy("cut").agg(F.round(F.avg((F.col("c_acctbal") >= F.col("cut")).cast("double")), 6).alias("share"))
    tails = ranks.quantiles(read(spark, d, "customer"), "c_acctbal", {"p10": 0.1, "p90": 0.9})
    return shares.join(tails).select("cut", "share", F.round("p10", 4).alias("p10"), F.round("p90", 4).alias("p90"))


@query(f"WITH r AS (SELECT {rank_sql('revenue')} AS a, {rank_sql('quantity')} AS b FROM {BRANDS}), s AS (SELECT 'a' AS axis, STDDEV_POP(a) AS sd, 0.6 AS w FROM r UNION ALL SELECT 'b', STDDEV_POP(b), 0.4 FROM r) SELECT axis, ROUND(sd, 6) AS sd, ROUND(w * sd / SUM(w * sd) OVER (), 6) AS share FROM s")
def g31_influence(spark, d):
    ranks = ranked_axes(spark, d).select(F.col("rr").alias("a"), F.col("rq").alias("b"))
    return diagnostics.influence(ranks, {"a": 0.6, "b": 0.4}).select("axis", F.round("sd", 6).alias("sd"), F.round("share", 6).alias("share"))


@query("SELECT c_mktsegment AS horizon, c_nationkey % 4 AS signal, COUNT(*) AS n FROM customer GROUP BY 1, 2")
def g32_distribution_counts(spark, d):
    return read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("horizon"), (F.col("c_nationkey") % 4).alias("signal")).agg(F.count(F.lit(1)).alias("n"))


# ---- sorts, limits, sets -------------------------------------------------------------------------


@query(f"SELECT doc_id, citations FROM {DOCS} ORDER BY CASE WHEN citations % 5 = 0 THEN NULL ELSE citations END DESC NULLS LAST, doc_id LIMIT 100 OFFSET 100")
def h06_h07_sorted_page(spark, d):
    key = F.when(F.col("citations") % 5 != 0, F.col("citations"))
    return roles.docs(spark, d).orderBy(key.desc_nulls_last(), "doc_id").offset(100).limit(100).select("doc_id", "citations")


@query("SELECT l_suppkey AS topic, l_orderkey, l_linenumber FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY COALESCE(NULLIF(l_discount, 0), 0) DESC, l_orderkey, l_linenumber) <= 40")
def h05_members(spark, d):
    place = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(0.0)).desc(), "l_orderkey", "l_linenumber"))
    return read(spark, d, "lineitem").withColumn("rn", place).where("rn <= 40").select(F.col("l_suppkey").alias("topic"), "l_orderkey", "l_linenumber")


@query("SELECT doc_id FROM documents ORDER BY CASE WHEN source IN ('src0', 'src1') THEN 0 ELSE 1 END, SHA256('run' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 150")
def h08_h09_seeded_sample(spark, d):
    first = F.when(F.col("source").isin("src0", "src1"), 0).otherwise(1)
    return read(spark, d, "documents").orderBy(first, F.sha2(F.concat(F.lit("run"), F.col("doc_id").cast("string")), 256), "doc_id").limit(150).select("doc_id")


@query("SELECT source FROM documents EXCEPT SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND lang = 'fr'")
def s02_difference(spark, d):
    docs = read(spark, d, "documents")
    return docs.select("source").subtract(docs.where("lang = 'fr'").join(read(spark, d, "labels").where("toxic = 1"), "doc_id").select("source"))


@query("SELECT source, 'a' AS side FROM documents UNION ALL SELECT lang, 'b' FROM documents")
def s01_union(spark, d):
    docs = read(spark, d, "documents")
    return docs.select("source", F.lit("a").alias("side")).unionByName(docs.select(F.col("lang").alias("source"), F.lit("b").alias("side")))


@query("SELECT user_id, LEN(LIST_INTERSECT(LIST(DISTINCT event_type), ['click', 'view', 'none'])) AS common FROM events GROUP BY user_id")
def s03_s05_intersection(spark, d):
    kinds = F.array_distinct(F.collect_list("event_type"))
    return read(spark, d, "events").groupBy("user_id").agg(F.size(F.array_intersect(kinds, F.array(F.lit("click"), F.lit("view"), F.lit("none")))).cast("long").alias("common"))


@query(f"WITH c AS ({COMPOSITE}), o AS (SELECT composite, LAG(composite) OVER (ORDER BY composite DESC, topic) - composite AS gap FROM c) SELECT ROUND(MEDIAN(gap), 6) AS middle, ROUND(MAX(gap), 6) AS widest FROM o WHERE gap IS NOT NULL")
def w12_score_gaps(spark, d):
    gap = F.lag("composite").over(Window.orderBy(F.desc("composite"), "topic")) - F.col("composite")
    return composite(spark, d).select(gap.alias("gap")).where(F.col("gap").isNotNull()).agg(F.round(F.median("gap"), 6).alias("middle"), F.round(F.max("gap"), 6).alias("widest"))


@query(f"SELECT topic, FORMAT('T{{:04d}}', ROW_NUMBER() OVER (ORDER BY n DESC, topic) - 1) AS topic_id FROM {BRANDS} WHERE n > 2000 QUALIFY ROW_NUMBER() OVER (ORDER BY n DESC, topic) <= 20")
def w10_w11_h02_numbering(spark, d):
    place = F.row_number().over(Window.orderBy(F.desc("n"), "topic"))
    return roles.brands(spark, d).where("n > 2000").withColumn("rn", place).where("rn <= 20").select("topic", F.format_string("T%04d", F.col("rn") - 1).alias("topic_id"))


@query("SELECT o_orderkey, CAST(YEAR(o_orderdate) AS VARCHAR) AS year, CAST(YEAR(o_orderdate) AS VARCHAR) || 'Q' || CAST(QUARTER(o_orderdate) AS VARCHAR) AS quarter FROM orders")
def w16_time_slices(spark, d):
    return read(spark, d, "orders").select("o_orderkey", text.time_slice(F.col("o_orderdate")).alias("year"), text.time_slice(F.col("o_orderdate"), True).alias("quarter"))


# ---- text ----------------------------------------------------------------------------------------

_STOPS = "[" + ", ".join(f"'{w}'" for w in text.STOPS) + "]"
SINGULAR = "CASE WHEN LENGTH(w) <= 3 OR NOT w LIKE '%s' THEN w WHEN w LIKE '%ies' AND LENGTH(w) > 4 THEN w[:-4] || 'y' WHEN regexp_matches(w, '(sses|shes|ches|xes|zes)$') THEN w[:-3] WHEN regexp_matches(w, '(ss|us|is|as|os)$') THEN w ELSE w[:-2] END"
_TOKENS = "LIST_FILTER(LIST_TRANSFORM(REGEXP_EXTRACT_ALL(LOWER(COALESCE(@, '')), '[a-z0-9]+(?:[''\\-][a-z0-9]+)*'), lambda w: " + SINGULAR + f"), lambda t: LENGTH(t) > 1 AND NOT LIST_CONTAINS({_STOPS}, t) AND NOT (LENGTH(REGEXP_REPLACE(t, '[^0-9]', '', 'g')) > 0 AND LENGTH(REGEXP_REPLACE(t, '[^0-9]', '', 'g')) >= LENGTH(t) - 2))"


def tokens_sql(column: str) -> str:
    return _TOKENS.replace("@", column)


@query(f"SELECT doc_id, LEN(t) AS n_tokens, MD5(ARRAY_TO_STRING(t, ' ')) AS digest FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)")
def x01_x02_x03_x04_tokens(spark, d):
    rows = read(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


PHRASES = f"SELECT item_id, topic, UNNEST(t || LIST_TRANSFORM(RANGE(1, LEN(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM (SELECT item_id, item_id % 4 AS topic, {tokens_sql('text')} AS t FROM benchmark)"
TERMS = f"WITH p AS ({PHRASES}), c AS (SELECT topic, term, COUNT(*) AS n FROM p GROUP BY 1, 2), s AS (SELECT topic, term, n, n / SUM(n) OVER (PARTITION BY topic) * LN(1 + (SELECT COUNT(DISTINCT topic) FROM c) / (1.0 + COUNT(*) OVER (PARTITION BY term))) AS score FROM c) SELECT topic, term, ROUND(score, 6) AS score, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY ROUND(score, 12) DESC, term) AS place FROM s WHERE n >= 2 QUALIFY place <= 30"


def _benchmark_terms(spark, d):
    docs = read(spark, d, "benchmark").select((F.col("item_id") % 4).alias("topic"), "text")
    return topics.terms(docs, "topic", "text")


@query(f"SELECT topic, term, CAST(score AS DOUBLE) AS score, CAST(place AS INTEGER) AS place FROM ({TERMS})")
def k07_x05_x11_g14_g16_h01_topic_terms(spark, d):
    return _benchmark_terms(spark, d)


@query(f"WITH RECURSIVE t AS ({TERMS}), l AS (SELECT topic, [term] AS chosen, CAST(1 AS BIGINT) AS place FROM t WHERE place = 1 UNION ALL SELECT t.topic, CASE WHEN LEN(chosen) >= 4 OR LEN(LIST_FILTER(chosen, lambda c: CONTAINS(c, t.term) OR CONTAINS(t.term, c))) > 0 THEN chosen ELSE LIST_APPEND(chosen, t.term) END, t.place FROM l JOIN t ON t.topic = l.topic AND t.place = l.place + 1) SELECT topic, ARRAY_TO_STRING(MAX_BY(chosen, place), ' / ') AS label FROM l GROUP BY topic HAVING MAX(place) >= 3")
def x12_x13_labels(spark, d):
    return topics.labels(_benchmark_terms(spark, d), "topic")


FEATURES = f"(SELECT item_id, CAST(('0x' || SUBSTRING(MD5(feature), 1, 15)) AS UBIGINT) % 256 AS idx, COUNT(*) AS tf FROM (SELECT item_id, UNNEST(t || LIST_TRANSFORM(RANGE(1, LEN(t)), lambda i: t[i] || '_' || t[i + 1])) AS feature FROM (SELECT item_id, {tokens_sql('text')} AS t FROM benchmark)) GROUP BY 1, 2)"
TFIDF = f"(SELECT item_id, idx, w / SQRT(SUM(w * w) OVER (PARTITION BY item_id)) AS weight FROM (SELECT item_id, idx, (1 + LN(tf)) * (LN((1.0 + (SELECT COUNT(DISTINCT item_id) FROM f)) / (1.0 + COUNT(*) OVER (PARTITION BY idx))) + 1) AS w FROM f))"


def _benchmark_vectors(spark, d):
    return vectors.tfidf(vectors.features(read(spark, d, "benchmark"), "item_id", F.col("text"), 256), "item_id")


@query(f"WITH f AS {FEATURES} SELECT item_id, CAST(idx AS BIGINT) AS idx, ROUND(CAST(weight AS DOUBLE), 6) AS weight FROM {TFIDF}")
def k01_x06_x07_x08_tfidf(spark, d):
    return _benchmark_vectors(spark, d).select("item_id", "idx", F.round("weight", 6).alias("weight"))


@query(f"WITH f AS {FEATURES}, v AS {TFIDF} SELECT a.item_id AS a, b.item_id AS b, ROUND(CAST(SUM(a.weight * b.weight) AS DOUBLE), 6) AS similarity FROM v a JOIN v b ON a.idx = b.idx AND a.item_id < b.item_id GROUP BY 1, 2 HAVING SUM(a.weight * b.weight) >= 0.1")
def j15_similar_pairs(spark, d):
    return vectors.similar_pairs(_benchmark_vectors(spark, d), "item_id", 0.1).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("SELECT event_id, CAST(JSON_EXTRACT(props, '$.k') AS BIGINT) AS k, SUBSTRING(MD5(props), 1, 8) AS h FROM events")
def x28_x30_json(spark, d):
    return read(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.substring(F.md5("props"), 1, 8).alias("h"))


@query("SELECT p_partkey, ARRAY_TO_STRING(LIST_TRANSFORM(STRING_SPLIT(REPLACE(p_type, ' ', '/'), '/')[1:3], lambda x: TRIM(x)), ' · ') AS label, TRIM(REGEXP_REPLACE('  ' || p_name || '   ' || p_brand, '\\s+', ' ', 'g')) AS collapsed FROM part")
def x29_x33_short_label(spark, d):
    return read(spark, d, "part").select("p_partkey", text.short_label(F.replace("p_type", F.lit(" "), F.lit("/"))).alias("label"), text.collapse(F.concat(F.lit("  "), "p_name", F.lit("   "), "p_brand")).alias("collapsed"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN SUBSTRING(url, 1, 20) END AS safe, REGEXP_EXTRACT(url, '://([^/?#]+)', 1) AS host, REGEXP_EXTRACT(url, '/([a-z]{2})/', 1) AS lang FROM pages")
def x26_x36_urls(spark, d):
    return read(spark, d, "pages").select("page_id", F.when(F.col("url").rlike("^https?://"), F.substring("url", 1, 20)).alias("safe"), F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed, CAST(MAKE_DATE(YEAR(o_orderdate), MONTH(o_orderdate), 1) AS VARCHAR) AS from_parts FROM orders")
def x16_x17_dates(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    parts = F.array(F.year("o_orderdate"), F.month("o_orderdate"))
    return read(spark, d, "orders").select("o_orderkey", text.parse_date(day).cast("string").alias("parsed"), text.date_from_parts(parts).cast("string").alias("from_parts"))


@query("""WITH w AS (SELECT doc_id, LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(COALESCE(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents), o AS (SELECT o_orderkey AS doc_id, o_orderdate AS stop, 1 + o_orderkey % 4 AS k FROM orders)
SELECT 'text' AS kind, doc_id AS id, 0 AS place, MD5(ARRAY_TO_STRING(w, ' ')) AS value FROM w WHERE LEN(w) > 0
UNION ALL SELECT 'window', doc_id, CAST(i AS INTEGER), STRFTIME(stop - TO_SECONDS(CAST(s * (k - i) // k AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '/' || STRFTIME(stop - TO_SECONDS(CAST(s * (k - i - 1) // k AS BIGINT)), '%Y-%m-%dT%H:%M:%S') FROM (SELECT *, CAST(6 * 2630016 AS BIGINT) AS s, UNNEST(RANGE(k)) AS i FROM o)""")
def x21_x34_rebuild(spark, d):
    """Texts from the positions of their words, and the windows of half a year before each order."""
    words = read(spark, d, "documents").select("doc_id", F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda x: x != "").alias("w"))
    texts = words.where("size(w) > 0").select(F.lit("text").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).alias("place"), F.md5(text.rebuild_abstract(F.to_json(text.inverted("w")))).alias("value"))
    spans = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.posexplode(text.time_windows(F.col("o_orderdate"), 6, 1 + F.col("o_orderkey") % 4)).alias("place", "x"))
    show = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return texts.union(spans.select(F.lit("window"), "id", "place", F.concat(show(F.col("x.start")), F.lit("/"), show(F.col("x.stop")))))


@query("SELECT user_id, ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(LIST(event_type)))[1:20], ',') AS kinds FROM events GROUP BY user_id")
def x27_sorted_set(spark, d):
    return read(spark, d, "events").groupBy("user_id").agg(F.array_join(text.sorted_set(F.collect_list(F.array("event_type"))), ",").alias("kinds"))


# ---- scores against references -------------------------------------------------------------------

BEST = f"""WITH t AS (SELECT topic, term, score, place FROM ({TERMS})),
w AS (SELECT topic, token, SUM(score) AS weight FROM (SELECT topic, score, UNNEST(STRING_SPLIT(term, ' ')) AS token FROM t) GROUP BY 1, 2),
x AS (SELECT topic, SUM(score) AS total FROM t GROUP BY topic), c AS {CENTROIDS},
r AS (SELECT n_nationkey AS ref, n_name AS label, (1 + n_nationkey % 3) / 3 AS weight, CAST(embedding AS DOUBLE[]) AS vec, term AS entry FROM nation JOIN embeddings ON vec_id = n_nationkey JOIN t ON t.topic = n_nationkey % 4 AND t.place = 1 + n_nationkey % 7),
l AS (SELECT ref, w.topic, MIN(w.weight) AS least FROM (SELECT ref, LEN(LIST_DISTINCT(STRING_SPLIT(entry, ' '))) AS n, UNNEST(LIST_DISTINCT(STRING_SPLIT(entry, ' '))) AS token FROM r) u JOIN w USING (token) GROUP BY ref, w.topic, n HAVING COUNT(*) = n),
s AS (SELECT x.topic, r.ref, r.label, r.weight, 0.6 * GREATEST(LIST_DOT_PRODUCT(c.centroid, r.vec), 0) + 0.4 * LEAST(COALESCE(least, 0) / total, 1) AS blend FROM x JOIN c ON c.topic = x.topic CROSS JOIN r LEFT JOIN l ON l.ref = r.ref AND l.topic = x.topic),
b AS (SELECT topic, label, ROUND(blend * weight, 9) AS score FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY ROUND(blend * weight, 9) DESC, ref) = 1), k AS (SELECT topic, MAX(blend) AS top FROM s GROUP BY topic)
SELECT topic, CASE WHEN score > 0 THEN label ELSE '' END AS best, ROUND(CAST(LEAST(GREATEST(score, 0), 1) AS DOUBLE), 6) AS fit, ROUND(CAST(LEAST(GREATEST(score, 0) + CASE WHEN top >= 0.25 THEN 0.1 ELSE 0 END, 1) AS DOUBLE), 6) AS boosted FROM b JOIN k USING (topic)"""


@query(BEST)
def j10_f09_f11_f12_best_reference(spark, d):
    terms = _benchmark_terms(spark, d)
    words = references.word_weights(terms, "topic").join(vectors.centroids(roles.points(spark, d), "topic", "embedding"), "topic")
    entries = terms.select((F.col("topic")).alias("t"), "place", F.array("term").alias("lexicon"))
    refs = read(spark, d, "nation").join(read(spark, d, "embeddings"), F.col("vec_id") == F.col("n_nationkey"))
    refs = refs.join(entries, (F.col("t") == F.col("n_nationkey") % 4) & (F.col("place") == 1 + F.col("n_nationkey") % 7))
    refs = refs.select(F.col("n_nationkey").alias("ref"), F.col("n_name").alias("label"), ((1 + F.col("n_nationkey") % 3) / 3.0).alias("weight"), F.col("embedding").alias("vector"), "lexicon")
    pairs = references.blends(words, "topic", refs, 0.6, 0.4)
    rows = references.best_reference(pairs, "topic").join(references.match(pairs, "topic", 0.25), "topic")
    return rows.select("topic", F.col("label").alias("best"), F.round("score", 6).alias("fit"), F.round(references.with_bonus(F.col("score"), F.col("match")), 6).alias("boosted"))


@query(f"WITH t AS (SELECT topic, term, score FROM ({TERMS})), w AS (SELECT topic, UNNEST(STRING_SPLIT(term, ' ')) AS token, score FROM t), m AS (SELECT topic, token, SUM(score) AS weight FROM w GROUP BY 1, 2), x AS (SELECT topic, SUM(score) AS total FROM t GROUP BY topic), e AS (SELECT DISTINCT term AS entry FROM ({PHRASES})) SELECT entry, topic, ROUND(CAST(MIN(weight) / MAX(total) AS DOUBLE), 6) AS overlap FROM (SELECT entry, LEN(LIST_DISTINCT(STRING_SPLIT(entry, ' '))) AS n, UNNEST(LIST_DISTINCT(STRING_SPLIT(entry, ' '))) AS token FROM e) JOIN m USING (token) JOIN x USING (topic) GROUP BY entry, topic, n HAVING COUNT(*) = n")
def f08_f16_lexicon_overlap(spark, d):
    terms = _benchmark_terms(spark, d)
    weights = terms.select("topic", F.explode(F.split("term", " ")).alias("token"), "score").groupBy("topic", "token").agg(F.sum("score").alias("weight"))
    totals = terms.groupBy("topic").agg(F.sum("score").alias("total"))
    entries = read(spark, d, "benchmark").select(F.explode(text.phrases(text.tokens(F.col("text")))).alias("entry")).distinct()
    words = F.array_distinct(F.split("entry", " "))
    tokens = entries.select("entry", F.size(words).alias("n"), F.explode(words).alias("token"))
    met = tokens.join(weights, "token").join(totals, "topic").groupBy("entry", "topic", "n").agg(F.count(F.lit(1)).alias("found"), F.min("weight").alias("least"), F.max("total").alias("total"))
    return met.where("found = n").select("entry", "topic", F.round(F.col("least") / F.col("total"), 6).alias("overlap"))


@query(f"WITH c AS (SELECT token, COUNT(*) AS n FROM (SELECT UNNEST({tokens_sql('text')}) AS token FROM documents) GROUP BY token), t AS (SELECT topic, term, score FROM ({TERMS})), k AS (SELECT topic, term, score, MIN(COALESCE(n, 0)) AS least FROM (SELECT topic, term, score, UNNEST(STRING_SPLIT(term, ' ')) AS token FROM t) LEFT JOIN c USING (token) GROUP BY 1, 2, 3) SELECT topic, ROUND(CAST(SUM(score * LEAST(least / 50.0, 1)) / SUM(score) AS DOUBLE), 6) AS salience FROM k GROUP BY topic")
def f16_g35_policy_salience(spark, d):
    counts = read(spark, d, "documents").select(F.explode(text.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = references.policy_salience(_benchmark_terms(spark, d), "topic", counts.withColumnRenamed("token", "word"))
    return found.select("topic", F.round("salience", 6).alias("salience"))


@query("SELECT n_nationkey, n_name || ' ' || r_name AS label, LOWER(r_name) || ':' || CAST(n_nationkey AS VARCHAR) AS ref_id FROM nation JOIN region ON r_regionkey = n_regionkey")
def f10_f13_reference_labels(spark, d):
    rows = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", F.concat_ws(" ", "n_name", "r_name").alias("label"), F.concat_ws(":", F.lower("r_name"), F.col("n_nationkey").cast("string")).alias("ref_id"))


# ---- diagnostics ---------------------------------------------------------------------------------

LATTICE = "(SELECT i, j, i / 20 AS wa, j / 20 AS wb, (20 - i - j) / 20 AS wc FROM (SELECT UNNEST(RANGE(21)) AS i), (SELECT UNNEST(RANGE(21)) AS j) WHERE i + j <= 20)"
STABLE = f"WITH b AS {BRANDS}, r AS (SELECT topic AS pos, {rank_sql('revenue')} AS ra, {rank_sql('quantity')} AS rb, {rank_sql('discount')} AS rc FROM b), s AS (SELECT i, j, pos, ROW_NUMBER() OVER (PARTITION BY i, j ORDER BY ROUND(wa * ra + wb * rb + wc * rc, 12) DESC, pos) AS place FROM r, {LATTICE})"


def _stable(spark, d):
    rows = ranked_axes(spark, d).select(F.col("topic").alias("pos"), F.col("rr").alias("ra"), F.col("rq").alias("rb"), F.col("rd").alias("rc"))
    return diagnostics.stability(rows, diagnostics.simplex(rows, 20), 5)


@query(f"WITH c AS ({COMPOSITE}), b AS {BRANDS}, r AS (SELECT topic, {rank_sql('revenue')} AS rr, {rank_sql('quantity')} AS rq, {rank_sql('discount')} AS rd FROM b) SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, ROUND(CAST(MAX(wa * rr + wb * rq + wc * rd) AS DOUBLE), 9) AS best FROM {LATTICE}, r GROUP BY i, j")
def k16_simplex(spark, d):
    """Over each cell of the weights' lattice the best of the topics' weighted scores."""
    axes = ranked_axes(spark, d)
    score = F.col("wa") * F.col("rr") + F.col("wb") * F.col("rq") + F.col("wc") * F.col("rd")
    return axes.join(F.broadcast(diagnostics.simplex(axes, 20))).groupBy("i", F.col("j").cast("int").alias("j")).agg(F.round(F.max(score), 9).alias("best"))


@query(f"{STABLE} SELECT pos, CAST(MIN(place) AS INTEGER) AS best, CAST(MAX(place) AS INTEGER) AS worst, ROUND(AVG(CASE WHEN place <= 5 THEN 1.0 ELSE 0.0 END), 6) AS share_top, ROUND(AVG(CASE WHEN place = 1 THEN 1.0 ELSE 0.0 END), 6) AS share_first FROM s GROUP BY pos")
def k17_w13_k18_stability(spark, d):
    return _stable(spark, d)[0].select("pos", "best", "worst", F.round("share_top", 6).alias("share_top"), F.round("share_first", 6).alias("share_first"))


@query(f"{STABLE} SELECT pos AS winner, COUNT(*) AS cells, ROUND(AVG(i), 6) AS mi, ROUND(AVG(j), 6) AS mj, ROUND(COUNT(*) / 231, 6) AS share FROM s WHERE place = 1 GROUP BY pos")
def g34_winner_regions(spark, d):
    return _stable(spark, d)[1].groupBy("winner").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("i"), 6).alias("mi"), F.round(F.avg("j"), 6).alias("mj"), F.round(F.count(F.lit(1)) / 231, 6).alias("share"))


PAIRS = "(SELECT a.vec_id AS a, b.vec_id AS b, 1 - LIST_DOT_PRODUCT(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS high, POW(CAST(a.embedding[1] AS DOUBLE) - b.embedding[1], 2) + POW(CAST(a.embedding[2] AS DOUBLE) - b.embedding[2], 2) AS low FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"
RANKS = f"(SELECT a, b, ROW_NUMBER() OVER (PARTITION BY a ORDER BY high, b) AS rh, ROW_NUMBER() OVER (PARTITION BY a ORDER BY low, b) AS rl FROM {PAIRS})"


N = "(SELECT COUNT(*) FROM embeddings)"


@query(f"SELECT ROUND(1 - 2.0 / ({N} * 10 * (2 * {N} - 30 - 1)) * SUM(CASE WHEN rl <= 10 THEN GREATEST(rh - 10, 0) ELSE 0 END), 6) AS trust, ROUND(1 - 2.0 / ({N} * 10 * (2 * {N} - 30 - 1)) * SUM(CASE WHEN rh <= 10 THEN GREATEST(rl - 10, 0) ELSE 0 END), 6) AS continuity FROM {RANKS}")
def k11_k13_w15_fidelity(spark, d):
    rows = read(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("high"), F.slice("embedding", 1, 2).alias("low"))
    found = diagnostics.fidelity(rows, "vec_id", ("high", "inner"), ("low", "euclidean"), 10)
    return found.select(F.round("trust", 6).alias("trust"), F.round("continuity", 6).alias("continuity"))


@query("SELECT label AS topic, ROUND(MAX(mx), 6) AS cx, ROUND(QUANTILE_CONT(SQRT(POW(x - mx, 2) + POW(y - my, 2)), 0.9), 6) AS spread FROM (SELECT label, x, y, MEDIAN(x) OVER (PARTITION BY label) AS mx, MEDIAN(y) OVER (PARTITION BY label) AS my FROM (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)) GROUP BY label")
def k15_map_centres(spark, d):
    rows = read(spark, d, "embeddings").select(F.col("label").alias("topic"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    found = diagnostics.map_centres(rows, "topic", "x", "y")
    return found.select("topic", F.round("cx", 6).alias("cx"), F.round("spread", 6).alias("spread"))


@query(f"WITH c AS ({COMPOSITE}), s AS (SELECT topic, composite + CASE WHEN topic = (SELECT MAX(topic) FROM c) THEN 0.25 ELSE 0 END AS stored FROM c WHERE topic <> (SELECT MIN(topic) FROM c)) SELECT COUNT(*) AS n, ROUND(MAX(ABS(stored - composite)), 6) AS deviation, COUNT(*) FILTER (WHERE stored IS NULL) AS unpaired, MAX(ABS(stored - composite)) <= 1e-6 AND COUNT(*) FILTER (WHERE stored IS NULL) = 0 AS ok, COUNT(*) FILTER (WHERE ABS(stored - composite) > 1e-6 OR stored IS NULL) AS different FROM c LEFT JOIN s USING (topic)")
def k20_k21_k22_audit(spark, d):
    """What was stored, with a wrong score and a lost row, against scores recomputed in another way: a count of smaller and equal values instead of window ranks."""
    first, last = composite(spark, d).agg(F.min("topic"), F.max("topic")).first()
    stored = composite(spark, d).where(F.col("topic") != first).select("topic", F.round(F.col("composite") + F.when(F.col("topic") == last, 0.25).otherwise(0.0), 6).alias("composite"))
    recomputed = diagnostics.recomputed(roles.brands(spark, d), "topic", {"revenue": 0.5, "quantity": 0.3, "discount": 0.2}).select("topic", F.round("score", 6).alias("composite"))
    close = diagnostics.verify_close(stored, recomputed, ["topic"], "composite", 1e-6)
    return close.withColumn("deviation", F.round("deviation", 6)).join(diagnostics.verify_identical(stored, recomputed, ["topic"], "composite").select("different"))


@query(f"""WITH b AS {BRANDS}, y AS (SELECT source, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM {DOCS} GROUP BY source)
SELECT 'thin' AS rule, topic AS subject, 'Only ' || n || ' documents' AS finding FROM b WHERE n < 2380
UNION ALL SELECT 'borderline', topic, 'A discount of ' || PRINTF('%.4f', discount) || ' lies within 0.0002 of 0.05' FROM b WHERE ABS(discount - 0.05) < 0.0002
UNION ALL SELECT 'dominant', source, PRINTF('%.1f', 100.0 * n / total) || ' percent of all documents' FROM y WHERE n > 0.2 * total""")
def k23_observations(spark, d):
    rows, counts = roles.brands(spark, d), roles.docs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return diagnostics.observations(rows, "topic", "n", "discount", 2380, (0.05, 0.0002), counts, 0.2)


@query(f"""WITH p AS (SELECT vec_id, topic, CAST(embedding AS DOUBLE[]) AS v FROM {POINTS}),
s AS (SELECT a.vec_id, AVG(CASE WHEN a.topic = a.tb THEN 1.0 ELSE 0.0 END) AS p FROM (SELECT a.vec_id, a.topic, b.topic AS tb, ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY ROUND(LIST_DOT_PRODUCT(a.v, b.v), 9) DESC, b.vec_id) AS place FROM p a JOIN p b ON a.vec_id <> b.vec_id) a WHERE place <= 5 GROUP BY a.vec_id),
m AS (SELECT a.vec_id, AVG(CASE WHEN a.topic = a.tb THEN 1.0 ELSE 0.0 END) AS p FROM (SELECT a.vec_id, a.topic, b.topic AS tb, ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY ROUND(POW(a.v[1] - b.v[1], 2) + POW(a.v[2] - b.v[2], 2), 9), b.vec_id) AS place FROM p a JOIN p b ON a.vec_id <> b.vec_id) a WHERE place <= 5 GROUP BY a.vec_id)
SELECT s.vec_id, ROUND(s.p, 6) AS space_purity, ROUND(m.p, 6) AS map_purity, ROUND(s.p - m.p, 3) AS distortion FROM s JOIN m USING (vec_id)""")
def f22_distortion(spark, d):
    """How much purer a point's neighbourhood is in the space than on the map of its first two components."""
    rows = roles.points(spark, d).withColumn("map", F.slice("embedding", 1, 2))
    return diagnostics.distortion(rows, "vec_id", "topic", ("embedding", "inner"), ("map", "euclidean"), 5).select("vec_id", F.round("space_purity", 6).alias("space_purity"), F.round("map_purity", 6).alias("map_purity"), F.round("distortion", 3).alias("distortion"))


@query(None)
def k04_k24_threshold_sweep(spark, d):
    """Average linkage of the benchmark's texts once, cut at six levels."""
    rows = _benchmark_vectors(spark, d)
    figures = linkage.sweep(linkage.merges(rows, "item_id", 0.1), rows.select("item_id"), "item_id", [0.1, 0.15, 0.2, 0.3, 0.4, 0.6])
    return figures.select("level", "clusters", "members", "largest", "middle", F.round("share", 6).alias("share"))


@query("""WITH p AS (SELECT label AS topic, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
m AS (SELECT topic, vec_id, x, y, SQRT(POW(x - MEDIAN(x) OVER (PARTITION BY topic), 2) + POW(y - MEDIAN(y) OVER (PARTITION BY topic), 2)) AS far FROM p),
q AS (SELECT topic, QUANTILE_CONT(far, 0.9) AS most FROM m GROUP BY topic), t AS (SELECT m.* FROM m JOIN q USING (topic) WHERE far <= most),
e AS (SELECT a.topic, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM t a JOIN t b ON a.topic = b.topic AND a.vec_id <> b.vec_id WHERE NOT EXISTS (SELECT 1 FROM t c WHERE c.topic = a.topic AND (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0))
SELECT topic, CAST(COUNT(*) AS INTEGER) AS corners, ROUND(SUM(x1 * y2 - x2 * y1) / 2, 6) AS area FROM e GROUP BY topic""")
def k14_hulls(spark, d):
    rows = read(spark, d, "embeddings").select(F.col("label").alias("topic"), F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return diagnostics.hulls(rows, "topic", "x", "y", 0.1).select("topic", "corners", F.round("area", 6).alias("area"))


@query(f"""WITH b AS {BRANDS}, r AS (SELECT topic, 0.5 * {rank_sql('revenue')} + 0.5 * {rank_sql('n')} AS emergence, 0.6 * {rank_sql('quantity')} + 0.4 * {rank_sql('discount')} AS idx FROM b), m AS ({MATURITY}), x AS (SELECT MIN(topic) AS low, MAX(topic) AS high FROM b)
SELECT 'emergence' AS audit, COUNT(*) AS n, ROUND(CAST(MAX(CASE WHEN topic = high THEN 0.25 ELSE 0 END) AS DOUBLE), 6) AS deviation, COUNT(*) FILTER (WHERE topic = high) AS different, FALSE AS ok FROM r, x
UNION ALL SELECT 'index', COUNT(*), ROUND(CAST(MAX(ABS(s.idx - r.idx)) AS DOUBLE), 6), COUNT(*) FILTER (WHERE s.idx IS NULL OR ABS(s.idx - r.idx) > 1e-9), COUNT(*) FILTER (WHERE s.idx IS NULL OR ABS(s.idx - r.idx) > 1e-9) = 0 FROM r LEFT JOIN (SELECT r.* FROM r, x WHERE topic <> low) s USING (topic)
UNION ALL SELECT 'horizon', COUNT(*), NULL, COUNT(*) FILTER (WHERE horizon <> stored), COUNT(*) FILTER (WHERE horizon <> stored) = 0 FROM (SELECT horizon, CASE WHEN topic = low THEN 'H0' ELSE horizon END AS stored FROM m, x)
UNION ALL SELECT 'unchanged', COUNT(*), 0.0, 0, TRUE FROM r""")
def k22_audits(spark, d):
    """Four stored results against scores computed again from counts: a wrong score, a lost row, a wrong class, and one as it should be."""
    rows = roles.brands(spark, d).cache()
    low, high = rows.agg(F.min("topic"), F.max("topic")).first()

    def scores(weights):
        found = rows
        for a in weights:
            found = ranks.percentile_ranks(found, a, f"r_{a}")
        return found.select("topic", F.round(diagnostics.weighted({a: F.col(f"r_{a}") for a in weights}, weights), 9).alias("score"))

    def check(name, weights, spoil):
        again = diagnostics.recomputed(rows, "topic", weights).select("topic", F.round("score", 9).alias("score"))
        return diagnostics.audit(name, spoil(scores(weights)), again, "topic", "score", 1e-9)

    emergence, index = {"revenue": 0.5, "n": 0.5}, {"quantity": 0.6, "discount": 0.4}
    fitted = series.maturity(series.series(_filled(spark, d), "topic", "slice"), "topic").select("topic", stats.horizon(F.col("maturity")).alias("horizon"))
    spoilt = fitted.withColumn("horizon", F.when(F.col("topic") == low, F.lit("H0")).otherwise(F.col("horizon")))
    parts = [check("emergence", emergence, lambda x: x.withColumn("score", F.round(F.col("score") + F.when(F.col("topic") == high, 0.25).otherwise(0.0), 9))), check("index", index, lambda x: x.where(F.col("topic") != low)), diagnostics.audit("horizon", spoilt, fitted, "topic", "horizon", 0.0), check("unchanged", emergence, lambda x: x)]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(f"""SELECT 'catalogue' AS kind, o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS value FROM orders
UNION ALL SELECT 'mail', o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders
UNION ALL SELECT 'name', c_custkey, CASE WHEN c_custkey % 4 < 3 THEN 'E ' || c_name ELSE c_mktsegment END FROM customer
UNION ALL SELECT 'csv', doc_id, MD5(CASE WHEN REGEXP_MATCHES(text, '[",\\n\\r]') THEN '"' || REPLACE(text, '"', '""') || '"' ELSE text END) FROM documents
UNION ALL SELECT 'bar', CAST(REGEXP_EXTRACT(topic, '[0-9]+') AS BIGINT), CAST(CAST(ROUND(20.0 * n / MAX(n) OVER ()) AS INTEGER) AS VARCHAR) FROM {BRANDS}""")
def x18_x25_x32_f23_fields(spark, d):
    orders, customers, docs, brands = read(spark, d, "orders"), read(spark, d, "customer"), read(spark, d, "documents"), roles.brands(spark, d)
    row = lambda df, kind, key, value: df.select(F.lit(kind).alias("kind"), key.cast("long").alias("id"), value.cast("string").alias("value"))
    stamp, mail = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX"), F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss")
    language = F.element_at(F.array(*[F.lit(x) for x in ("en", "en-GB", "en-US", "de")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    names = F.create_map(F.lit("fr"), F.concat(F.lit("F "), "c_name"), language, F.concat(F.lit("E "), "c_name"))
    found = row(orders, "catalogue", F.col("o_orderkey"), text.catalogue_date(stamp)).union(row(orders, "mail", F.col("o_orderkey"), text.mail_date(mail)))
    found = found.union(row(customers, "name", F.col("c_custkey"), text.localised_name(names, F.col("c_mktsegment")))).union(row(docs, "csv", F.col("doc_id"), F.md5(text.csv_field(F.col("text")))))
    peak = brands.agg(F.max("n").alias("peak"))
    return found.union(row(brands.join(F.broadcast(peak)), "bar", F.regexp_extract("topic", "[0-9]+", 0), stats.bar(F.col("n"), F.col("peak"))))
