"""Properties of the engine's operators on small, hand-made inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom import schemas
from topicloom.functions import stats, text
from topicloom.operators import diagnostics, series, tables, topics, vectors
from topicloom.plans import catalog2
from topicloom.streaming.ingest import ingest


def ranks(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    return [r.r for r in df.select("i", stats.percentile_rank(F.col("v")).alias("r")).orderBy("i").collect()]


def test_percentile_rank(spark):
    assert ranks(spark, [3, 1, 2]) == [1.0, 0.0, 0.5]
    assert ranks(spark, [7]) == [0.5]
    assert ranks(spark, []) == []
    assert ranks(spark, [0, 0, 0, 0, 9]) == [0.375] * 4 + [1.0]


def burst(spark, counts, totals, s=2.0, gamma=1.0):
    df = spark.createDataFrame([([float(x) for x in counts], [float(x) for x in totals])], "counts array<double>, totals array<double>")
    r = series.bursts(df, s, gamma).withColumn("score", stats.burst_score(F.col("states"), F.col("max_weight"))).first()
    return r.states, r.max_weight, r.score


def test_bursts(spark):
    assert burst(spark, [50] * 8, [1000] * 8)[0] == [0] * 8
    up = [20, 20, 22, 21, 25, 60, 120, 200]
    late, w1, s1 = burst(spark, up, [1000] * 8)
    assert late[7] == 1 and late[0] == 0
    early, w2, s2 = burst(spark, up[::-1], [1000] * 8)
    assert w1 == pytest.approx(w2) and s2 < s1
    assert not any(burst(spark, [10 * 2**k for k in range(8)], [100 * 2**k for k in range(8)])[0])
    for counts in ([], [10], [0, 0, 0]):
        assert not any(burst(spark, counts, [10] * len(counts))[0])
    assert not any(burst(spark, [10] * 4, [10] * 4)[0])
    spike = [20, 20, 20, 200, 20, 20, 20, 20]
    assert any(burst(spark, spike, [1000] * 8, gamma=0.5)[0]) and not any(burst(spark, spike, [1000] * 8, gamma=50)[0])


def brute_states(counts, totals, s, gamma):
    from itertools import product
    from math import log

    p0 = sum(counts) / sum(totals)
    p = [p0, min(p0 * s, 1 - 1e-9)]
    cost = lambda k, t: -(counts[t] * log(p[k]) + (totals[t] - counts[t]) * log(1 - p[k]))
    paths = product((0, 1), repeat=len(counts))
    return min(sum(cost(k, t) for t, k in enumerate(q)) + gamma * log(len(counts)) * sum(a != b for a, b in zip(q, q[1:])) for q in paths)


def test_burst_path_is_cheapest(spark):
    from math import log

    rng = np.random.default_rng(1)
    for _ in range(5):
        totals, counts = rng.integers(50, 99, 8).tolist(), rng.integers(0, 30, 8).tolist()
        states, _, _ = burst(spark, counts, totals, 2.0, 0.3)
        p0 = sum(counts) / sum(totals)
        p = [p0, min(2 * p0, 1 - 1e-9)]
        own = sum(-(c * log(p[k]) + (t - c) * log(1 - p[k])) for c, t, k in zip(counts, totals, states)) + 0.3 * log(8) * sum(a != b for a, b in zip(states, states[1:]))
        assert own == pytest.approx(brute_states(counts, totals, 2.0, 0.3))


def test_maturity(spark):
    cases = {"young": [0, 0, 1, 1, 2, 4, 8, 20], "old": [100, 100, 100, 100, 100, 20, 5, 1], "middle": [1, 2, 5, 15, 40, 80, 120, 140], "short": [1, 2]}
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in cases.items()], "topic string, counts array<double>")
    got = {r.topic: (r.maturity, r.fit) for r in series.maturity(df, "topic").collect()}
    assert got["young"][0] < 0.2 and got["young"][1] > 0.8
    assert got["old"][0] > 0.9
    assert 0.35 <= got["middle"][0] < 0.75
    assert got["short"] == (0.5, 0.0)


def test_tokens_and_labels(spark):
    df = spark.createDataFrame([("Technologies, classes & business models of the patents in 2020's 750 000km",)], "t string")
    assert df.select(text.tokens(F.col("t"))).first()[0] == ["technology", "class", "business", "patent"]
    terms = spark.createDataFrame([(["patent", "patent examination", "design", "trade mark", "seed", "pest"],)], "t array<string>")
    assert terms.select(text.compose_label(F.col("t"))).first()[0] == "patent / design / trade mark / seed"
    assert spark.createDataFrame([(None,)], "t string").select(text.tokens(F.col("t"))).first()[0] == []


def test_dates_and_texts(spark):
    df = spark.createDataFrame([("2021-03-04",), ("2021-03-04T05:06:07Z",), ("20210304T050607Z",), ("2021-03",), ("2021",), ("2021-03-04T05:06:07.123+10:00",), ("soon",), (None,)], "d string")
    got = [str(r[0]) for r in df.select(text.parse_date(F.col("d"))).collect()]
    assert got == ["2021-03-04", "2021-03-04", "2021-03-04", "2021-03-01", "2021-01-01", "2021-01-01", "None", "None"]
    one = spark.createDataFrame([('["a", "", null, "b"]', "&lt;p&gt;A &amp; B&lt;/p&gt;", "ti:solar AND (the cells)")], "j string, m string, q string")
    row = one.select(text.json_list(F.col("j")), text.strip_markup(F.col("m")), text.query_terms(F.col("q"), ["the"])).first()
    assert row[0] == ["a", "b"] and row[1] == "A & B" and row[2] == ["solar", "cells"]


def test_writes(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 0)], "k int, v string, seq int")
    new = spark.createDataFrame([(1, "b", 1), (2, "c", 2), (2, "d", 3)], "k int, v string, seq int")
    assert [(r.k, r.v) for r in tables.insert_or_ignore(old, new, ["k"], "seq").collect()] == [(2, "c")]
    assert sorted((r.k, r.v) for r in tables.insert_or_replace(old, new, ["k"], "seq").collect()) == [(1, "b"), (2, "d")]
    path = str(tmp_path / "t")
    tables.overwrite_run(path, spark.createDataFrame([(1, "r1"), (2, "r1")], "x int, run_id string"), "r1")
    tables.overwrite_run(path, spark.createDataFrame([(3, "r2")], "x int, run_id string"), "r2")
    assert spark.read.parquet(path).count() == 3
    tables.overwrite_run(path, spark.createDataFrame([], "x int, run_id string"), "r1")
    assert [r.x for r in spark.read.parquet(path).collect()] == [3]


def test_linkage_against_naive():
    rng = np.random.default_rng(0)
    for _ in range(10):
        v = rng.normal(size=(18, 6)) + np.repeat(rng.normal(size=(3, 6)) * 2, 6, 0)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        groups, sims = [[i] for i in range(18)], v @ v.T
        while len(groups) > 1:
            best = max(((np.mean(sims[np.ix_(a, b)]), -i, -j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
            if best[0] < 0.5:
                break
            i, j = -best[1], -best[2]
            groups[i] += groups.pop(j)
        assert sorted(map(sorted, groups)) == sorted(map(sorted, topics.average_linkage(v, 0.5)))


def test_cluster_and_leader(spark):
    rng = np.random.default_rng(2)
    base = np.eye(3)
    v = np.concatenate([base[[k] * n] + rng.normal(0, 0.02, (n, 3)) for k, n in enumerate((6, 4, 2))])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "id long, vec array<double>, part int")
    got = {}
    for r in topics.cluster(df, "id", "vec", "part", 0.8, 3, 10).collect():
        got.setdefault(r.topic_id, []).append(r.id)
    assert {k: sorted(x) for k, x in got.items()} == {"T0000": list(range(6)), "T0001": list(range(6, 10))}
    assert topics.leader(v, 0.8, 3) == [list(range(6)), list(range(6, 10))]


def test_feature_hashing(spark):
    df = spark.createDataFrame([("quantum",)], "f string")
    assert df.select(text.feature_bucket(F.col("f"), 2048)).first()[0] == 740
    import hashlib

    want = int.from_bytes(hashlib.blake2b(b"quantum", digest_size=8).digest(), "big") % 2048
    assert df.select(vectors.blake_bucket("f", F.lit(2048))).first()[0] == want


def test_geometry_and_weights(spark):
    square = np.array([[0, 0], [1, 0], [1, 1], [0, 1], [0.5, 0.5]])
    assert len(diagnostics.hull(square)) == 4
    assert len(diagnostics.trimmed_hull(np.concatenate([square, [[50, 50]]]))) == 4
    assert sum(diagnostics.redistribute({"a": 0.4, "b": 0.3, "c": 0.3}, {"a", "b"}).values()) == pytest.approx(1)
    assert diagnostics.redistribute({"a": 0.4}, set()) == {}
    rows = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(6)], "id int, v array<double>")
    flat = diagnostics.pca_2d(rows, "id", "v").toPandas()
    assert np.allclose(np.abs(flat.x.diff().dropna()), 5**0.5) and np.allclose(flat.y, 0)


def test_schemas():
    assert set(schemas.KEYS) <= set(schemas.TABLES)
    assert [f.name for f in schemas.schema("topic_documents")] == ["topic_id", "doc_id", "similarity"]


def test_ingest_is_idempotent(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id int, v string")
    one.coalesce(1).write.parquet(source)
    for turn in range(2):
        stream = spark.readStream.schema(one.schema).parquet(source)
        ingest(stream, table, str(tmp_path / f"c{turn}"), ["doc_id"], "v").awaitTermination()
    assert sorted((r.doc_id, r.v) for r in spark.read.parquet(table).collect()) == [(1, "a"), (2, "c")]


def test_a_batch_that_dies_halfway_adds_each_key_once(spark, tmp_path, monkeypatch):
    from topicloom.streaming import ingest as module

    source, table, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    rows = lambda *r: spark.createDataFrame(list(r), "doc_id int, v string").coalesce(1).write.mode("append").parquet(source)
    run = lambda: ingest(spark.readStream.schema("doc_id int, v string").parquet(source), table, marks, ["doc_id"], "v").awaitTermination()
    rows((1, "a"), (2, "b"))
    run()
    rows((2, "later"), (3, "c"))
    true = module.land

    def dies(*args):
        true(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "land", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(module, "land", true)
    run()
    run()
    assert sorted((r.doc_id, r.v) for r in spark.read.parquet(table).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_older_rows_take_the_new_schema(spark):
    from pyspark.sql.types import _parse_datatype_string

    old = spark.createDataFrame([(1, "7", "gone")], "a int, B string, c string")
    row = tables.migrated(old, _parse_datatype_string("b int, a long, d array<string>")).first()
    assert tuple(row) == (7, 1, None) and row.__fields__ == ["b", "a", "d"]


def test_hulls_as_an_aggregate(spark):
    rng = np.random.default_rng(8)
    points = [(t, *rng.normal(size=2).tolist()) for t in "ab" for _ in range(500)] + [("c", 1.0, 1.0), ("c", 2.0, 2.0), (None, 0.0, 0.0), ("a", None, 9.0)]
    df = spark.createDataFrame(points, "t string, x double, y double").repartition(7)
    for drop in (0.0, 0.1):
        for r in diagnostics.hulls(df, "t", "x", "y", drop).collect():
            own = np.array([p[1:] for p in points if p[0] == r.t and None not in p])
            want = diagnostics.trimmed_hull(own, drop) if drop else diagnostics.hull(own)
            assert sorted((p.x, p.y) for p in r.points) == sorted(map(tuple, want.tolist())) and r.corners == len(want)
            assert (r.area > 0) == (r.t != "c")


def test_cached_encode(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id int, body string")
    seen = []

    def encode(rows):
        seen.append(sorted(r.text for r in rows.collect()))
        return rows.select("content_hash", F.array(F.length("text").cast("double")).alias("vector"))

    cache = spark.createDataFrame([], "content_hash string, backend string, dimensions int, vector array<double>")
    for want, more in ((["a", "b", "c"], []), ([], []), (["d"], [(5, "d")])):
        now = docs.union(spark.createDataFrame(more, "id int, body string")) if more else docs
        found, new = vectors.cached_encode(now, F.col("body"), cache, "len", encode)
        assert seen[-1] == want and all(r.vector == [1.0] for r in found.collect()) and found.count() == now.count()
        cache = cache.unionByName(new)
    assert cache.count() == 4
    vectors.cached_encode(docs, F.col("body"), cache, "other", encode)
    assert seen[-1] == ["a", "b", "c"]


def test_many_references_meet_in_cells(spark, monkeypatch):
    from topicloom.operators import grid, references

    topics_ = spark.createDataFrame([(f"t{i}", [float(i), 1.0], {"solar": 1.0}, 2.0) for i in range(9)], "topic_id string, centroid array<double>, words map<string,double>, total double")
    refs = spark.createDataFrame([(k, f"r{k}", 1.0, [0.1, 0.1 * k], ["solar"] if k % 2 else None) for k in range(11)], "ref int, label string, weight double, vector array<double>, lexicon array<string>")
    found = lambda: sorted(tuple(r) for r in references.blends(topics_, "topic_id", refs, 0.5, 0.5).collect())
    want = found()
    monkeypatch.setattr(references, "MOST_REFERENCES", 5)
    monkeypatch.setattr(grid, "CELL_ROWS", 3)
    assert found() == want and len(want) == 99


def test_inverted_words_need_no_shuffle(spark):
    """Positions by word within the row, also of long texts; the rebuilt text is the text, and no row leaves its task."""
    texts = ["b a b c a b", "", "x", " ".join(f"w{k % 997}" for k in range(20_000)), 'say "hi" \\ é']
    df = spark.createDataFrame([(1, t.split()) for t in texts], "id int, w array<string>").where("size(w) > 0")
    found = df.select(text.inverted("w").alias("m"), text.rebuild_abstract(F.to_json(text.inverted("w"))).alias("t"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert rows[0].m == {"a": [1, 4], "b": [0, 2, 5], "c": [3]}
    assert [r.t for r in rows] == [t for t in texts if t]


def test_rebuilt_texts_are_not_shuffled(spark, data):
    """Rows that repeat a doc_id stay apart, as in the SQL."""
    plan = catalog2.x21_x34_rebuild(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
