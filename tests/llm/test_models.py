"""Language model, toxicity, quality rules, personal data, HTML."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.llm import html, ngram, pii, quality, queries, toxicity


# ---- language model


def test_elias_fano():
    rng = np.random.default_rng(0)
    for values in ([0], [0, 0, 0, 5, 5, 900], np.sort(rng.integers(0, 10**6, 5000)), np.sort(rng.integers(0, 300, 5000))):
        values = np.asarray(values)
        ef = ngram.ef_encode(values)
        at = rng.integers(0, len(values), 300)
        assert (ngram.ef_access(ef, at) == values[at]).all()
        unique = np.unique(values)
        ef, top = ngram.ef_encode(unique, zeros=True), int(unique[-1]) + 3
        sought = rng.integers(0, top, 500)
        n = np.full(500, len(unique))
        want = {int(x): k for k, x in enumerate(unique)}
        assert ngram.ef_find(ef, 0 * n, n, sought).tolist() == [want.get(x, -1) for x in sought.tolist()]
        assert (ngram.ef_find(ef, 0 * n, n, unique[rng.integers(0, len(unique), 500)]) >= 0).all()


@pytest.mark.parametrize("shards", [1, 7])
def test_scores_against_brute_force(spark, frame, shards):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "c", "the", "of", "Xy", "é", "w%d" % rng.randrange(40)]) for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "the of\x0b the\tof", "the of the of"]
    docs = frame(texts).withColumn("learn", F.col("doc_id") % 5 != 0)
    model, scores = ngram.train_and_score(docs, "learn", shards=shards, min_count=2)
    got = {r.doc_id: r for r in scores.collect()}
    words = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in enumerate(texts)}
    c1, c2, c3 = Counter(), Counter(), Counter()
    for i, w in words.items():
        if i % 5:
            c1.update(w)
            c2.update(zip(w, w[1:]))
            c3.update(zip(w, w[1:], w[2:]))
    n, v = sum(c1.values()), len(c1)
    n1, n2 = sum(x == 1 for x in c1.values()), sum(x == 2 for x in c1.values())
    d1 = n1 / (n1 + 2 * n2) if n1 else 0.5
    k2 = {k: x for k, x in c2.items() if x > 1}
    k3 = {k: x for k, x in c3.items() if x > 1 and k[:2] in k2}
    s2, s3 = Counter(), Counter()
    for k, x in k2.items():
        s2[k[0]] += x - 0.8
    for k, x in k3.items():
        s3[k[:2]] += x - 0.8

    def p(w, i):
        out = (c1[w[i]] - d1) / n if w[i] in c1 else d1 * v / n
        if i and w[i - 1] in c1:
            u = w[i - 1]
            out = max(k2.get((u, w[i]), 0) - 0.8, 0) / c1[u] + (c1[u] - s2[u]) / c1[u] * out
        if i > 1 and (w[i - 2], w[i - 1]) in k2:
            u = (w[i - 2], w[i - 1])
            out = max(k3.get((*u, w[i]), 0) - 0.8, 0) / k2[u] + (k2[u] - s3[u]) / k2[u] * out
        return out

    assert model.n == n and model.v == v
    for i, w in words.items():
        assert got[i].n_tokens == len(w) and got[i].n_known == sum(x in c1 for x in w)
        assert got[i].base_score == pytest.approx(sum(math.log10((c1[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert got[i].score == pytest.approx(sum(math.log10(p(w, j)) for j in range(len(w))), abs=2e-3 * len(w))


def test_language_model_edges(spark, frame):
    model, scores = ngram.train_and_score(frame(["a b", None]).withColumn("learn", F.lit(False)), "learn")
    assert model.n == 0 and [r.score for r in scores.collect()] == [0.0, 0.0]
    assert ngram.train_and_score(frame([]).withColumn("learn", F.lit(True)), "learn")[1].collect() == []
    again = ngram.train(frame(["a b c", "a b d", "a b"]))
    assert ngram.score(frame(["a b"]), again).first().score > ngram.score(frame(["b a"]), again).first().score


def test_language_model_beats_base_on_held_out(spark, data):
    rows = queries.op2_ngram(spark, data).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows.s > 0.9 * rows.b


# ---- toxicity


def labelled(spark, frame, n=400):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("aeioulmnrst") for _ in range(4)) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(60)] = rng.choice(["Idiot,", "moron", "scum."])
        texts.append(" ".join(w))
        labels.append((i, 0, int(toxic)))
    return frame(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, frame):
    docs, labels = labelled(spark, frame)
    machine = toxicity.train(docs, labels.where("doc_id % 4 <> 1"))
    got = {r.doc_id: r for r in toxicity.score(docs, machine).collect()}
    assert all(got[i].predicted == (i % 5 == 0) for i in range(1, 400, 4))
    clean = toxicity.keep_clean(docs, machine)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i in got if not got[i].predicted}
    assert 0 <= toxicity.score(frame([None, ""]), machine).first().score < 0.3
    assert toxicity.score(frame([]), machine).collect() == []


def test_machine_learns_pairs():
    rng = np.random.default_rng(3)
    examples = []
    for _ in range(600):
        a, b = rng.random(2) < 0.5
        examples.append((int(a and b), np.array([k for k, x in enumerate((a, b)) if x], np.int32)))
    machine = toxicity.fit(examples, np.array([11, 22]))
    p = lambda *at: toxicity.sigmoid(machine.margin(np.array(at, int)))
    assert p(0, 1) > 0.9 and p(0) < 0.3 and p(1) < 0.3


def test_words_that_tell_only_together(spark, frame):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(2000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = ["".join(rng.choice("aeioulmnrst") for _ in range(3)) for _ in range(25)] + ["kelp"] * a + ["rust"] * b
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((i, int(a != b)))
    docs = frame(texts)
    machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id % 4 <> 1"))
    right = lambda m: sum(r.predicted == labels[r.doc_id][1] for r in toxicity.score(docs.where("doc_id % 4 = 1"), m, 0.5).collect()) / 500
    linear = toxicity.Machine(machine.bias, machine.known, machine.weights, 0 * machine.factors)
    assert right(machine) > 0.95 and right(linear) < 0.8


def test_telling_pairs():
    rng = np.random.default_rng(9)
    x = (rng.random((800, 12)) < 0.5).astype(np.float32)
    x[:, 11] = x[:, 10]  # nested terms are no pair
    y = (x[:, 2] != x[:, 7]).astype(int)
    found = toxicity.telling_pairs(800, int(y.sum()), x.T @ x, x[y == 1].T @ x[y == 1])
    assert np.flatnonzero(found).tolist() == [2, 7]


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(frame(["a", None]), toxicity.train(frame(["a"]), none)).collect()} == {0}


# ---- quality


def brute_counts(x):
    x = x or ""
    w, lines = re.findall(r"[^\x20\x09-\x0D]+", x), [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
    seen = {}
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {j for ks in seen.values() if len(ks) > 1 for k in ks for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def test_quality(spark, frame):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "dé", "e"]) + str(rng.randrange(500)) for _ in range(rng.randrange(25, 90))) for _ in range(120)]
    odd = [None, "", " \n\t\x0b ", "a b c d e f g h " * 30, "x\nx\nx y\n\n x\n", "w " * 7, "r s t u v w x y z\n" * 2 + texts[0], "#*$%&|<> " * 40 + texts[1], "1 2 3 4 5 6 7 8 9 " + texts[2] + " 1 2 3 4 5 6 7 8 9"]
    every = texts + odd
    got = {r.doc_id: r for r in quality.judge(frame(every)).collect()}
    for i, x in enumerate(every):
        assert tuple(got[i])[1:7] == brute_counts(x)
        assert not (got[i].base_failed and got[i].kept)
    assert sum(got[i].kept for i in range(120)) >= 118
    assert not got[120 + 7].kept  # symbols beyond its group's spread
    kept = quality.keep_good(frame(every))
    assert kept.columns == frame(every).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}
    assert quality.judge(frame([])).collect() == []


def test_quality_null_groups(spark):
    df = spark.createDataFrame([(i, "some words of a text " * 1 + " ".join(str(i * k) for k in range(30)), None, None) for i in range(1, 6)], "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in quality.judge(df).collect())


# ---- personal data

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = lambda: sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def brute_spans(x):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in KINDS.items() for m in re.finditer(p, x or "") if valid(k, m[0]))


def test_base_spans(spark, frame):
    rng = random.Random(5)
    parts = list("aB1234567890..--  ++@@()_%é😀\n\t") + ["4111111111111111", "4041894974608795", "1.2.3.4", "10.0.0.255", "+1 (988) 555-2485", "a@b.c", "255.", "x@y.zz."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(45))) for _ in range(1500)] + [None, "", "a" * 50000, "1 " * 20000, "a@" * 5000]
    got = {r.doc_id: r for r in pii.spans(frame(texts)).collect()}
    for i, x in enumerate(texts):
        want = brute_spans(x)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), x
        assert got[i].spans == want or got[i].spans.startswith(want)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(1 for s in want.split(",") if s.startswith(k)) for k in KINDS]
    assert pii.spans(frame([])).collect() == []


def test_disclosing_terms(spark, frame):
    texts = [f"Line {w} of john smithson has js@x.example.com and {w}." for w in ("alpha", "beta", "gamma", "delta")]
    texts += [f"the line of john {w} and" for w in ("q", "r", "s")] * 30 + ["filler the line and has"] * 200
    texts += ["unique gibberish qwxzt with zz@yy.example.org inside"] * 50  # copies are no evidence
    rows = {r.doc_id: r for r in pii.spans(frame(texts)).collect()}
    found = {texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for i in rows for s in rows[i].spans.split(",") if s.startswith("term")}
    assert found == {"smithson"}
    clashing = frame(texts).withColumn("_text", F.lit("kept")).withColumn("_email", F.lit(1))
    assert pii.sanitised(clashing).columns == clashing.columns and {(r._text, r._email) for r in pii.sanitised(clashing).collect()} == {("kept", 1)}
    clean = {r.doc_id: r for r in pii.sanitised(frame(texts)).collect()}
    assert clean[0].text == "Line alpha of john  has [EMAIL] and alpha." and clean[0].n_chars == len(clean[0].text)
    assert all(brute_spans(r.text) == "" for r in clean.values()) and clean[100].text == texts[100]


# ---- html


def test_html_blocks():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
    <div class="cookie-notice">We use cookies on this site.</div><article><h1>Title &amp; more</h1><p>First  <b>bold</b> line<br>goes on.<p>Short.
    <form><label>Name</label></form><aside>See also</aside><p>1 &lt; 2 &nbsp; x</p><div id="comments"><p>I was here.</p></div></article>
    <script>var t = "</p><p>no";</script><footer>&copy; me</footer>"""
    assert html.extract(page) == "Title & more\nFirst bold line goes on.\nShort.\n1 < 2 x"


def test_html_without_article():
    good = "This is the text of the page and it is as long as it has to be for the rules to see that it is good, with all the words that a language has and so on until it is long enough to be a good block of the page. "
    page = f"<body><ul><li><a href=a>Menu entry</a><li><a href=b>Other</a></ul><div>{good}</div><div>Between.</div><div>{good}</div><p>Tail"
    assert html.extract(page) == f"{good.strip()}\nBetween.\n{good.strip()}"


def test_html_edges(spark):
    for broken in ("", "<", "<p", "<!--", "<p class='x", "</", "a < b", "<script>x", "<a" * 3000, "<div>" * 3000, "&am", "<![CDATA[x", "<p>" * 10 + "\u0000"):
        assert isinstance(html.extract(broken), str)
    df = spark.createDataFrame([(1, "u", None), (None, None, "<article><p>Hi</p></article>"), (2, "u", "")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html.main_text(df).collect()) == [(0, "Hi", 2), (1, "", 0), (2, "", 0)]
    assert html.main_text(df.limit(0)).collect() == []


def test_queries_run(spark, data):
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    assert queries.op4_html(spark, data).where("n_chars > 0").count() == spark.read.parquet(f"{data}/pages.parquet").count()
    assert queries.op7_toxicity(spark, data).count() == n
    assert queries.op9_pii(spark, data).count() == n
    held = {r.doc_id for r in queries.op7_toxicity(spark, data).where("held_out").collect()}
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)


def test_a_shard_merges_its_lists_by_ranges():
    rng = np.random.default_rng(4)
    lists = []
    for size in (0, 1, 5000, 20_000):
        keys, counts = np.unique(rng.integers(0, 9000, size, dtype=np.uint64), return_counts=True)
        lists.append(ngram._unpack(ngram._pack(keys, counts)))
    lists.append((np.array([2**63 - 1], np.uint64), np.array([2**32 - 1], np.uint32)))
    want = Counter()
    for keys, counts in [*lists, lists[-1]]:
        want.update(dict(zip(keys.tolist(), counts.tolist())))
    lists.append(lists[-1])
    for at_once in (1, 70, 1 << 20):
        keys, counts = ngram._merged(list(lists), 2, at_once)
        assert list(zip(keys.tolist(), counts.tolist())) == sorted((k, n) for k, n in want.items() if n >= 2)
    assert [len(x) for x in ngram._merged([])] == [0, 0]


def test_words_are_hashed_and_counted_together(spark, frame, monkeypatch):
    """Hashes of many words at once are those of each; counting and encoding look at no word alone."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    words = [b"", b"\n", *(rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in [*range(70), *rng.integers(1, 40, 500).tolist()])]
    for some in (pa.array(words, pa.binary()), pa.array(words, pa.binary()).slice(7, 90), pa.array([], pa.binary())):
        assert ngram.word_hashes(some).tolist() == [ngram.word_hash(x) for x in some.to_pylist()]
    hashed = []
    monkeypatch.setattr(ngram, "word_hash", lambda token: hashed.append(token) or 7)
    ngram.word_hashes(pa.array([b"w%d" % k for k in range(100)], pa.binary()))
    assert not hashed
