"""Removal of repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest

from topicloom.llm import queries, repeats


def brute(texts, length):
    """(removed runs, kept) of texts in order of doc_id."""
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        edges = [i for i in range(len(data) + 1) if (i < len(data) and gone[i]) != (i > 0 and gone[i - 1])]
        out.append((list(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(data, gone) if not g)))
    return out


def result(docs, **more):
    return [([(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in repeats.without_repeats(docs, **more).orderBy("doc_id").collect()]


def corpus(rng, n):
    words = ["é" * 3, "the", "of", *("".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 9))) for _ in range(60))]
    passage = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared, texts = [passage(30) for _ in range(5)], [None, "", "x" * 99, "x" * 400, "ab" * 300]
    for _ in range(n):
        parts = [passage(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 4))] + rng.sample(shared, rng.randrange(3))
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    for t in rng.sample(texts[5:], n // 3):  # near copies
        k = rng.randrange(len(t) + 1)
        texts.append(t[:k] + rng.choice(["", "z", "qq "]) + t[k:])
    return texts + rng.sample(texts, n // 4)


@pytest.mark.parametrize("length, hot", [(100, repeats.HOT), (100, 2), (40, 5)])
def test_against_brute_force(spark, frame, length, hot):
    texts = corpus(random.Random(length + hot), 60)
    assert result(frame(texts), length=length, hot=hot) == brute(texts, length)


def test_small_pieces_and_batches(spark, frame, monkeypatch):
    texts = corpus(random.Random(9), 30)
    want = brute(texts, 100)
    for piece in (7, 64, 1000):
        monkeypatch.setattr(repeats, "PIECE", piece)
        for t in texts[:20]:
            start, strings, offset, anchor = repeats.segments((t or "").encode())
            assert strings.sum() == max(0, len((t or "").encode()) - 99) and (np.diff(start) == strings[:-1]).all()
    assert result(frame(texts)) == want


def test_hashes_that_collide_are_caught(monkeypatch):
    """With one code for all bytes every prefix of a length has one hash: only verification tells texts apart."""
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(40)]
    texts += texts[:5]
    monkeypatch.setattr(repeats, "CODES", np.ones(256, np.uint64))
    n = len(texts)
    of, which, gone = repeats.later(texts, np.zeros(n, int), np.full(n, 0), np.ones(n, int), np.arange(n), np.zeros(n, int), 50)
    assert np.flatnonzero(gone).tolist() == list(range(40, 45))


def test_sort_is_of_suffixes():
    text = bytes(random.Random(1).choice(b"abc") for _ in range(300))
    buffer = repeats.Texts([text])
    x = np.arange(200)
    order = repeats.merge_sorted(buffer, x, np.zeros(200, int), 50)
    assert order.tolist() == sorted(range(200), key=lambda i: text[i : i + 50])


def test_rows_that_repeat_and_rows_without_id(spark):
    a, b = "alpha beta gamma " * 9, "delta epsilon " * 11
    rows = [(2, a, 1), (2, a, 1), (None, b, 1), (None, b, 2), (3, a, 1), (1, b, 1), (2, b, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key long")
    got = sorted((r.doc_id or -1, r.n_bytes, len(r.kept)) for r in repeats.without_repeats(df).collect())
    own = lambda t: len(brute([t], 100)[0][1])
    assert got == sorted([(2, len(a), own(a))] * 2 + [(-1, len(b), own(b))] * 2 + [(3, len(a), 0), (1, len(b), 0), (2, len(b), 0)])


def test_empty_table(spark, frame):
    assert result(frame([])) == []
    assert result(frame([None, "", "short"])) == [([], b""), ([], b""), ([], b"short")]


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_repeats(spark, data).collect()}
    want = {d.doc_id: (len((d.text or "").encode()), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()) for d, (runs, kept) in zip(docs, brute([d.text for d in docs], 100))}
    assert got == want
