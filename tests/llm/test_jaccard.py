"""Near copies of the pipeline: all pairs of the similarity, against brute force."""

import random

import corpus_pipeline
from topicloom.llm import jaccard, simhash
from topicloom.llm.common import TASK_ROWS
from topicloom.llm.components import components


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def copies():
    rng = random.Random(7)
    texts = [None, "", " ", "one", "one two", "a b c d e", "A b c d  e", "a b c d e f"]
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 100, 300]))]
        for _ in range(12):  # chains too: some are near each other over others only
            w = list(base)
            for _ in range(rng.randrange(len(w) // 25 + 2)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            texts.append(" ".join(w))
            base = w if rng.random() < 0.3 else base
    return texts + [" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(40)]


def test_all_pairs_of_the_similarity(spark, frame, monkeypatch):
    texts = copies()
    want = brute(texts)
    for common in (jaccard.COMMON, 1):  # the order has no influence
        monkeypatch.setattr(jaccard, "COMMON", common)
        got = {r.doc_id: r.component_id for r in jaccard.near_copies(frame(texts)).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_pipeline_stage_takes_near_copies(spark, frame):
    words = [f"w{i}" for i in range(300)]
    changed = [*words[:90], "x", *words[91:180], "y", *words[181:250], "z", *words[251:]]  # similarity 0.90
    half = [*words[:150], *(f"v{i}" for i in range(150))]
    docs = frame([" ".join(x) for x in (words, changed, half)])
    rows = docs.union(docs.limit(1)).union(docs.selectExpr("cast(null as long)", *docs.columns[1:]))
    kept = corpus_pipeline.near_duplicate_stage(spark, rows, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (False, 2), (True, 0), (True, 0), (True, 0)]
    assert jaccard.near_copies(frame([])).collect() == []


def test_lists_in_blocks_lose_no_pair(spark, frame, monkeypatch):
    rng = random.Random(3)
    shared = [f"s{k}" for k in range(40)]
    texts = copies()[:60] + [" ".join([*shared, *(f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 12)))]) for _ in range(90)]
    want = brute(texts)
    monkeypatch.setattr(jaccard, "COMMON", 0)  # shingles of all texts stand anywhere
    for block in (3, 16):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {r.doc_id: r.component_id for r in jaccard.near_copies(frame(texts)).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_a_template_makes_few_candidates(spark, frame, monkeypatch):
    """3,000 texts share 100 words and have 14 of their own: none is similar to another at 0.8."""
    rng = random.Random(1)
    template = " ".join(f"t{k}" for k in range(100))
    texts = [template + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(14)) for _ in range(3000)]
    seen, sketched, verified = [], jaccard._sketched, jaccard._verified
    monkeypatch.setattr(jaccard, "_sketched", lambda pairs, *a: seen.append(pairs.count()) or sketched(pairs, *a))
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    got = jaccard.near_copies(frame(texts)).collect()
    assert all(r.doc_id == r.component_id for r in got) and sum(seen) < 10_000


def test_names_that_clash(spark):
    row = ("a b c d e f g", 1, 2, 3, 4, 5, 6, 7, 8)
    df = spark.createDataFrame([(k, *row) for k in (2, 1)] + [(3, "other", *row[1:])], "doc_id long, text string, _key int, _doc_id int, key int, row int, group int, size int, h int, rep int")
    for module in (simhash, jaccard):
        kept = module.representatives(df)
        assert kept.columns == df.columns and sorted(tuple(r) for r in kept.collect()) == [(1, *row), (3, "other", *row[1:])]


def test_pipeline_stage_takes_texts_of_near_fingerprints(spark, frame):
    """Fingerprints link in the stage as in op5, though the sets' similarity is below 0.8, and chains go over both kinds of links."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(60)]
    again = " ".join(["na"] * 200)
    texts = [f"{again} {' '.join(base[:20])}", f"{again} {' '.join(base[20:40])}", " ".join(base), " ".join(base[:40]), f"{again} {' '.join(base[20:39])} x"]
    docs = frame(texts)
    fps = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    alone = {r.doc_id: r.component_id for r in jaccard.near_copies(docs).collect()}
    both = {r.doc_id: r.component_id for r in jaccard.near_copies(docs, max_bits=2).collect()}
    assert fps[1] == fps[0] and alone[1] == 1 and both[1] == 0
    assert all(both[i] == both[found[i]] for found in (fps, alone) for i in found)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == sorted(set(both.values()))


def test_a_block_gives_a_forest_of_its_candidates():
    import numpy as np
    import pyarrow as pa

    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("rep", "size", "pos", "root")]))
    members = [{"rep": k, "size": 50, "pos": 0, "root": k % 100} for k in range(200)]  # all could be similar, of 100 components
    batch = pa.RecordBatch.from_arrays([pa.array([members], kind), pa.array([None], kind)], names=["members", "others"])
    every, few = (next(jaccard._across(4, 5, forest)([batch])) for forest in (False, True))
    assert every.num_rows == 200 * 199 // 2 - 100 and 99 <= few.num_rows <= 3 * 200
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b, likely = rng.integers(0, 30, 80), rng.integers(0, 30, 80), rng.random(80)
        a, b, likely = a[a != b], b[a != b], likely[a != b]
        parts = lambda x, y: len({frozenset(c) for c in _parts(x, y)})
        taken = jaccard._forest(a, b, likely)
        assert len(taken) == len(set(taken.tolist())) == len({*a, *b}) - parts(a, b) and parts(a[taken], b[taken]) == parts(a, b)


def _parts(a, b):
    part = {x: {x} for x in (*a.tolist(), *b.tolist())}
    for x, y in zip(a.tolist(), b.tolist()):
        if part[x] is not part[y]:
            part[x] |= part[y]
            for z in part[y]:
                part[z] = part[x]
    return part.values()


def test_small_tables_take_few_tasks(spark, frame):
    """However many partitions a shuffle has, what is left of a few edges is kept in as many files as its rows need."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(300).selectExpr("id as u", "id + 1 as v").where("v % 100 <> 0")
        found = components(edges)
        assert found.rdd.getNumPartitions() == 1
        assert {r.node: r.root for r in found.collect()} == {k: k // 100 * 100 for k in range(300)}
        assert jaccard.gathered(spark.range(9).repartition(40), 3 * TASK_ROWS + 1).rdd.getNumPartitions() == 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
