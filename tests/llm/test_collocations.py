"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from topicloom.llm import collocations, queries

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, min_count=10, inside=50, limit=2000):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {}
    grams = {g: a for g, a in f.items() if a >= min_count and len(g) > 2}
    gone = {(g[0], *g[i : i + k]) for g, a in grams.items() for k in range(2, len(g) - 1) for i in range(1, len(g) - k + 1) if 100 * a >= inside * f[(g[0], *g[i : i + k])]}
    for g, a in grams.items():
        if g not in gone:
            cuts = [(1_000_000 * a * a // (f[g[: k + 1]] * f[(g[0], *g[k + 1 :])]), k) for k in range(1, len(g) - 1)]
            score, k = min(cuts)
            found.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), f[g[: k + 1]], f[(g[0], *g[k + 1 :])]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, v in found.items() for i, (s, a, p, left, right) in enumerate(sorted(v)[:limit], 1))


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def corpus(rng, n, words):
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".\n", "? "]) for _ in range(rng.randrange(60)))
        out.append((rng.choice(["en", "de", None, "und"]), text))
    return out


@pytest.mark.parametrize("longest, min_count, inside, limit", [(3, 10, 50, 2000), (4, 5, 50, 7), (2, 3, 80, 50), (3, 1, 100, 2000)])
def test_against_brute_force(spark, longest, min_count, inside, limit):
    rng = random.Random(longest * 7 + min_count)
    words = ["a", "A", "the", "The", "É", "é", "x\x1fy", "\x00", "#", *(rng.choice("bcdef") * rng.randrange(1, 4) for _ in range(12))]
    rows = corpus(rng, 200, words) + [("en", None), ("en", ""), ("fr", "a a a a a a a a a a a a a a"), (None, "w" * 100_000 + " b b")]
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, word string")
    assert result(collocations.collocations(df, longest, min_count, inside, limit)) == brute(rows, longest, min_count, inside, limit)


def test_small_blocks_buckets_and_salts(spark, monkeypatch):
    rng = random.Random(2)
    rows = corpus(rng, 150, [w for k in range(1, 14) for w in ["w%d" % k] * (14 - k)])
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name, value in (("BLOCK", 50), ("BUCKET", 300), ("HOT", 40)):
        monkeypatch.setattr(collocations, name, value)
    assert result(collocations.collocations(df)) == brute(rows)


def test_pivot_owns_each_occurrence_once():
    rng = random.Random(5)
    for _ in range(50):
        words = np.array([rng.randrange(-1, 5) for _ in range(rng.randrange(1, 30))], np.int64)
        for longest in (2, 3, 4):
            rows = collocations.fragments(words, longest)
            found, n = collocations.phrases(rows, np.ones(len(rows), np.int64), longest)
            got = {tuple(g[g >= 0].tolist()): c for g, c in zip(found, n.tolist())}
            want = Counter(tuple(words[i : i + k].tolist()) for k in range(2, longest + 1) for i in range(len(words) - k + 1) if (words[i : i + k] >= 0).all())
            assert got == want


def test_rows_whose_hashes_collide(monkeypatch):
    monkeypatch.setattr(collocations, "MIX", np.zeros(5, np.uint64))
    rows = np.array([[1, 2], [3, 4], [1, 2], [3, 5]], np.int64)
    found, n = collocations.added(rows, np.array([1, 2, 3, 4]))
    assert {tuple(r): c for r, c in zip(found.tolist(), n.tolist())} == {(1, 2): 4, (3, 4): 2, (3, 5): 4}


def test_empty(spark):
    kind = "doc_id long, lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], kind)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, "en", "a b c")], kind)).collect() == []


def test_query(spark, data):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert result(queries.op12_collocations(spark, data)) == brute(rows)
