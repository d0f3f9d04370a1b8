"""Verdicts of the quality rules against a plain version: exact halves, all rows in memory."""

import random

import numpy as np

from topicloom.llm import quality


WORDS = [c * (k % 7 + 1) for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")] * 2 + [f"more{k}" for k in range(20)]


def texts(rng, n, words):
    out = []
    for _ in range(n):
        w = [rng.choice(words) + ("#" if rng.random() < 0.02 else "") for _ in range(rng.randrange(25, 90))]
        if rng.random() < 0.2:
            w += w[:9]
        lines = [" ".join(w[i : i + 12]) for i in range(0, len(w), 12)]
        out.append("\n".join(lines + lines[:1] * (rng.random() < 0.3)))
    return out


def plain(x, of_group):
    """Squared distances of rows x under their groups' estimates."""
    d, floors, n = x.shape[1], np.array(quality.FLOORS), len(x)

    def floored(c):
        return c + np.diag(np.maximum(floors**2 - np.diag(c), 0))

    def distance(z, m, c):
        return np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(floored(c)), z - m)

    def middle(values, share):
        at = np.sort(values)
        return at[max(0, int(np.ceil(len(at) * share)) - 1)]

    def step(z, m, c):
        order = np.argsort(distance(z, m, c), kind="stable")
        w = np.zeros(len(z))
        w[order[: len(z) // 2]] = 1
        if len(z) % 2:
            w[order[len(z) // 2]] = 0.5
        m = np.average(z, axis=0, weights=w)
        return m, ((z - m).T * w) @ (z - m) / w.sum()

    def estimate(z):
        grid = floors / 2
        q = [np.array([(np.floor(middle(z[:, i], s) / grid[i]) + 0.5) * grid[i] for i in range(d)]) for s in (0.25, 0.5, 0.75)]
        spread = np.diag((np.round((q[2] - q[0]) / grid) * grid / 1.349) ** 2)
        tried = []
        for m in (q[1], q[0], q[2]):
            c = spread
            for _ in range(quality.FIRST_STEPS):
                m, c = step(z, m, c)
            tried.append((np.linalg.slogdet(floored(c))[1], len(tried), m, c))
        det, _, m, c = min(tried, key=lambda t: t[:2])
        while True:
            m, c = step(z, m, c)
            before, det = det, np.linalg.slogdet(floored(c))[1]
            if before - det <= quality.STILL:
                break
        spreads = max(1, int((np.diag(c) > floors**2).sum()))
        return m, c * max(1.0, np.median(distance(z, m, c)) / quality.MEDIANS[spreads - 1])

    m0, c0 = estimate(x)
    out = np.zeros(n)
    for g in set(of_group):
        mine = np.array([h == g for h in of_group])
        m, c = estimate(x[mine])
        s = mine.sum() / (mine.sum() + quality.PRIOR_ROWS)
        out[mine] = distance(x[mine], s * m + (1 - s) * m0, s * c + (1 - s) * c0 + s * (1 - s) * np.outer(m - m0, m - m0))
    return out


def test_verdicts_against_a_plain_version(spark):
    rng = random.Random(12)
    rows = [(t, "en", "web") for t in texts(rng, 300, WORDS)]
    rows += [(t, "de", "web") for t in texts(rng, 150, [w + "schaft" for w in WORDS])]
    rows += [(t, None, "rare") for t in texts(rng, 7, ["xx", "yyy"])]
    rows += [("#$%& " * 20 + t, "en", "web") for t in texts(rng, 12, ["alpha", "beta"])]
    rows += [(" ".join(f"w{rng.randrange(99)} " * 12 for _ in range(5)), "en", "web") for _ in range(5)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    vectors = quality.with_vector(quality.with_counts(df))
    got = quality.judged(vectors, quality.estimates(vectors)).where("not base_failed").orderBy("doc_id").collect()
    want = plain(np.array([[r[v] for v in quality.VARIABLES] for r in got]), [(r["lang"], r["source"]) for r in got])
    mine = np.array([r["distance2"] for r in got])
    near = np.abs(mine - want) <= 0.15 * want + 0.3
    assert near.mean() > 0.9
    sure = np.abs(want - quality.CUTOFF) > 0.5 * quality.CUTOFF
    assert [r["kept"] for r, s in zip(got, sure) if s] == [bool(w <= quality.CUTOFF) for w, s in zip(want, sure) if s]
    usual = [r["kept"] for r in got if r["doc_id"] < 457]
    assert not any(r["kept"] for r in got if 457 <= r["doc_id"] < 469) and sum(usual) > 0.97 * len(usual)


def test_the_determinant_never_rises(spark):
    rng = random.Random(13)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts(rng, 200, ["a", "bcd", "efghij"]))], "doc_id long, text string, lang string, source string")
    used = quality.with_vector(quality.with_counts(df)).select("group", *quality.VARIABLES)
    params = quality._starts(used)
    assert params.count() == 3
    for _ in range(3):
        moved = quality._concentrated(used, params, 2)
        a, b = ({r["start"]: r["logdet"] for r in p.collect()} for p in (params, moved))
        if _:
            assert all(b[k] <= a[k] + 0.02 for k in a)
        params = moved


def test_edges(spark):
    texts = [None, "", "word " * 100_000, "a b c d e f g h i j k l m n o p q r s t u v"]
    df = spark.createDataFrame([(i if k else None, t, None, None, "x") for i, t in enumerate(texts) for k in (0, 1)], "doc_id long, text string, lang string, source string, n_words string")
    got = quality.keep_good(df)
    assert got.columns == df.columns and [r.doc_id for r in got.orderBy("doc_id").collect()] in ([None, 3], [])
