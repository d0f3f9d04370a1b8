"""SimHash, components, sharding, top k, and the pipeline."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from topicloom.llm import jaccard, queries, sharding, simhash, topk
from topicloom.llm.components import components


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in fps}


def test_simhash_against_brute_force(spark, frame):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") for _ in range(120)) for _ in range(8)]
    texts = [None, "", "  \n", "one", "one two", "one two three", "A b\tC d", *base]
    for b in base:
        for _ in range(6):
            w = b.split()
            w[rng.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    texts += [base[0]] * 40
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(texts)).collect()}
    fps = {i: brute_fp(t) for i, t in enumerate(texts)}
    assert {i: got[i].fp % 2**64 for i in got} == fps
    assert {i: got[i].component_id for i in got} == brute_components(fps)
    kept = simhash.representatives(frame(texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(fps).values()))
    assert kept.columns == frame(texts).columns
    assert simhash.near_duplicates(frame([])).collect() == []


def test_links_hold_near_fingerprints(spark):
    rng = random.Random(5)
    fps = [0, 1, 3, 7, 2**63, 2**63 + 2**62, 2**31, 2**32, 2**31 + 2**32 + 5]
    for _ in range(40):
        x = rng.getrandbits(64)
        fps += [x, x ^ 1 << rng.randrange(64), x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)]
    fps = sorted(set(fps))
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    frame = spark.createDataFrame(signed, "fp long")
    want = brute_components(dict(enumerate(fps)))
    for hot in (simhash.HOT, 1):  # buckets that are hot lose no link
        roots = {r.node % 2**64: r.root for r in components(simhash.links(frame, hot=hot)).collect()}
        groups = {}
        for i, x in enumerate(fps):
            groups.setdefault(roots.get(x, x - 2**64 if x >= 2**63 else x), []).append(i)
        assert {i: min(g) for g in groups.values() for i in g} == want


@pytest.mark.parametrize("max_bits", [1, 4])
def test_links_at_other_distances(spark, max_bits):
    rng = random.Random(max_bits)
    fps = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        fps |= {x, *(x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(6))}
    frame = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {frozenset(y for y in fps if find(y) == r) for r in map(find, fps)}
    for hot in (simhash.HOT, 2) if max_bits < 3 else (simhash.HOT,):
        roots = {r.node % 2**64: r.root % 2**64 for r in components(simhash.links(frame, max_bits, hot)).collect()}
        assert {frozenset(y for y in fps if roots.get(y, y) == r) for r in (roots.get(x, x) for x in fps)} == want


def test_rows_that_share_an_id_keep_different_texts(spark):
    texts = ["a b c d e f g", "q r s t u v w", "q r s t u v w", "one two three four five six"]
    df = spark.createDataFrame([(1, texts[0], 5), (1, texts[1], 6), (2, texts[2], 7), (1, texts[0], 8), (3, texts[3], 9)], "doc_id long, text string, fp long")
    for module in (simhash, jaccard):
        assert sorted((r.doc_id, r.text) for r in module.representatives(df).collect()) == [(1, texts[0]), (1, texts[1]), (3, texts[3])]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5), (7, 6), (1001, 1000)]
    roots = {r.node: r.root for r in components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    assert all(roots[i] == 0 for i in range(201)) and all(roots[1000 + k] == 1000 for k in range(300))
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_repeated_and_unnamed_rows(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "q r s t")], "doc_id long, text string")
    assert sorted((r.doc_id or -1) for r in simhash.representatives(df).collect()) == [-1, 1]


def test_sharding(spark):
    rows = [(i, None if i % 50 == 0 else f"text {i}", "en", None if i % 40 == 0 else f"s{min(i % 10, 3)}", 0) for i in range(1003)]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, lang string, source string, shard long")
    got = sharding.shards(df).toPandas()
    assert len(got) == 1008
    sizes = got.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    mix = got.groupby(["shard", "source"], dropna=False).size().unstack(fill_value=0)
    whole = got.groupby("source").size() / 16
    assert (abs(mix - whole) <= 2).all().all()
    assert sharding.shards(df.limit(0)).collect() == []
    again = sharding.shards(df.repartition(7)).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert got[key].sort_values(key).to_numpy().tolist() == again[key].sort_values(key).to_numpy().tolist()


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(6)
    vectors = np.round(rng.normal(size=(700, 16)), 1)
    vectors[10] = vectors[11] = vectors[12]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(701, None), (702, [1.0] * 15 + [float("nan")]), (703, [1.0] * 15 + [float("inf")]), (704, [1.0] * 15 + [None]), (None, [0.0] * 16), (750, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, query_every=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    x = np.floor(256 * vectors).astype(int)
    for q in range(0, 700, 7):
        s = x @ x[q]
        want = sorted(((i, int(s[i])) for i in range(700) if i != q), key=lambda p: (-p[1], p[0]))[:5]
        assert got[q] == want
    assert set(got) == set(range(0, 700, 7))
    assert topk.top_k(df.limit(0)).collect() == []


def test_top_k_of_repeated_ids_and_wide_numbers(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 2.0]), (3, [1e17, -1e17]), (100, [1e17, 1e17]), (4, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, k=3).collect())
    top = (1 << 63) - 1
    floors = {i: [min(top, int(256 * x)) for x in v] for i, v in rows if i not in (50, 100)} | {100: [min(top, int(256 * 1e17))] * 2}
    want = []
    for i, q in rows:
        if i % 50 == 0:
            w = [min(top, int(256 * x)) for x in q]
            scores = sorted((-(w[0] * v[0] + w[1] * v[1]), j) for j, v in [*floors.items(), *((50, [256 * int(a) for a in x]) for y, x in rows if y == 50)] if j != i)[:3]
            want += [(i, k + 1, j, max(-top - 1, min(top, -s))) for k, (s, j) in enumerate(scores)]
    # cut scores tie and go by id, as they do in the result's own order
    assert sorted((q, s) for q, _, _, s in got) == sorted((q, s) for q, _, _, s in want)
    assert [r for r in got if r[0] == 50] == sorted(r for r in want if r[0] == 50)


def test_rows_without_an_id_are_dealt_out(spark):
    df = spark.createDataFrame([(None, "same text", "en", "s", "x")] * 900 + [(1, "a", "en", "s", "y")], "doc_id long, text string, lang string, source string, h string")
    got = sharding.shards(df).toPandas()
    assert len(got) == 901 and sorted(got.groupby("shard").size().unique().tolist()) in ([56, 57], [56], [57])
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in got.groupby("shard"))
    assert simhash.near_duplicates(df).where("doc_id is null and component_id = 1").count() == 0


def test_cell_prunes_nothing_it_needs():
    rng = np.random.default_rng(7)
    x = rng.integers(-20, 20, (300, 24))
    q, i, s = topk.cell_top_k(np.arange(20), x[:20], np.arange(300), x, 5, 4)
    for k in range(20):
        mine = [(a, b) for c, a, b in zip(q, i, s) if c == k]
        scores = x @ x[k]
        assert mine == sorted(((j, int(scores[j])) for j in range(300) if j != k), key=lambda p: (-p[1], p[0]))[:5]


def test_queries_run(spark, data):
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    got = queries.op5_simhash(spark, data)
    assert got.count() == n and got.where(F.length("fingerprint") != 16).count() == 0
    assert queries.op6_sharding(spark, data).count() == n
    assert queries.op10_topk(spark, data).count() == 50


def test_pipeline(spark, data):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "pii", "packing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    packed = corpus_pipeline.run(spark, data).toPandas()
    quality = queries.op8_quality(spark, data).toPandas().set_index("doc_id").kept
    assert set(packed.doc_id) <= set(quality[quality].index)
    near = queries.op5_simhash(spark, data).toPandas().set_index("doc_id").component_id
    assert len(set(packed.doc_id)) == len(set(near[list(set(packed.doc_id))]))
    assert len(set(packed.doc_id)) > 0.5 * docs.count()


def test_small_sources_are_spread(spark):
    rows = [(i, f"text {i}", f"only{i}" if i < 400 else f"s{i % 3}") for i in range(4000)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("doc_id < 400").groupBy("shard").count().collect()
    counts = [r["count"] for r in got]
    assert len(counts) == 16 and max(counts) - min(counts) <= 2


def test_equal_rows_are_dealt_out(spark):
    from topicloom.llm import packing
    from topicloom.llm.common import told_apart

    df = spark.range(20_000).selectExpr("7L as doc_id", "'a few words' as text", "'s' as source").repartition(8)
    numbers = told_apart(df.checkpoint(), ["doc_id", "text"], "nth").agg(F.min("nth"), F.max("nth"), F.count_distinct("nth")).first()
    assert tuple(numbers) == (1, 20_000, 20_000)
    parts = packing.pack(df).selectExpr("sequence_id >> 32 as part").groupBy("part").count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 2400
    shards = sharding.shards(df).groupBy("shard").count().collect()
    assert [r["count"] for r in shards] == [1250] * 16
    same = spark.createDataFrame([(50, [1.0, float(i)]) for i in range(300)] + [(3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(same).groupBy("vec_id").count().collect()[0]["count"] == 300
