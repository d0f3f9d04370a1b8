"""Neighbours and places in cells against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import diagnostics, grid, vectors


def points(spark, v):
    return spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, v array<float>")


def expected(v, metric):
    d = np.round(-(v @ v.T) if metric == "inner" else np.square(v[:, None] - v[None]).sum(2), 9)
    np.fill_diagonal(d, np.inf)
    return [np.lexsort((np.arange(len(v)), row))[:-1] for row in d]


@pytest.mark.parametrize("metric", ["inner", "euclidean"])
def test_nearest_and_places_with_ties(spark, monkeypatch, metric):
    for name, value in {"SIDE_ROWS": 50, "STRIP": 16, "CHUNK": 20, "HEAD": 8}.items():
        monkeypatch.setattr(grid, name, value)
    v = np.random.default_rng(5).integers(-2, 3, (130, 3)).astype(float)
    want, rows = expected(v, metric), points(spark, v)
    got = vectors.nearest(rows, "id", "v", 4, metric).collect()
    assert {(r.a, r.place): r.b for r in got} == {(i, p + 1): b for i, o in enumerate(want) for p, b in enumerate(o[:4])}
    far = spark.createDataFrame([(i, int(o[at])) for i, o in enumerate(want) for at in (0, 60, 128)], "a long, b long")
    places = {(r.a, r.b): r.place for r in diagnostics.places(rows, "id", "v", metric, far).collect()}
    assert places == {(i, int(o[at])): at + 1 for i, o in enumerate(want) for at in (0, 60, 128)}


def test_equal_vectors_are_not_taken_up_again_and_again():
    """2,000 equal vectors: beyond the first columns no piece has a candidate."""
    v, ids = np.ones((2000, 3)), np.arange(2000)
    row, column, far = grid.smallest(v, ids, v, ids, 3, "inner")
    assert len(row) == 6000 and column[:6].tolist() == [1, 2, 3, 0, 2, 3] and set(far) == {-3.0}


def test_fidelity_of_more_points_than_a_whole_number_holds(spark, monkeypatch):
    """n k (2 n - 3 k - 1) passes 32 bits."""
    monkeypatch.setattr(diagnostics.vectors, "nearest", lambda *_: None)
    monkeypatch.setattr(diagnostics, "places", lambda *_: spark.createDataFrame([(0, 1, 60)], "a long, b long, place long"))
    rows, n = spark.range(60_000), 60_000
    value = diagnostics.preserved(rows, "id", ("v", "inner"), ("w", "inner"), 10).first().value
    assert value == pytest.approx(1 - 50 * 2 / (n * 10 * (2 * n - 31)), abs=1e-15)


def test_a_cell_is_wide_enough_that_little_is_copied():
    """Vectors of 600,000 rows are copied 19 times a side."""
    assert grid.blocks(600_000, 12) == 19 and grid.blocks(100_000, 12) == 6 and grid.blocks(10_000, 12) == 6 and grid.blocks(300, 12) == 1


@pytest.mark.parametrize("metric", ["inner", "euclidean"])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_places_and_neighbours_of_distances_that_hardly_differ(spark, monkeypatch, metric, kind):
    """Distances closer than the ninth digit, copies in number and equal distances; cut at 9 digits, many would tie."""
    for name, value in {"SIDE_ROWS": 90, "ROWS": 16, "COLUMNS": 24, "HITS": 3, "PAIRS": 50}.items():
        monkeypatch.setattr(grid, name, value)
    v = np.random.default_rng(7).normal(0, 1e-5, (240, 3))
    v[60:100], v[100:140] = v[7], np.round(v[100:140], 5)
    v = (v + [1, 0, 0] if metric == "inner" else v).astype(np.float32 if kind == "float" else float)
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], f"id long, v array<{kind}>")
    d = np.array([grid.exact(np.repeat(x[None], len(v), 0), v, metric) for x in v])
    np.fill_diagonal(d, np.inf)
    want = [np.lexsort((np.arange(len(v)), row))[:-1] for row in d]
    pairs = spark.createDataFrame([(i, int(o[at])) for i, o in enumerate(want) for at in (0, 3, 120, 238) if i % 5], "a long, b long")
    got = {r.a: r for r in vectors.around(rows, "id", "v", metric, 4, pairs).collect()}
    assert {a: [x.b for x in r.near] for a, r in got.items()} == {i: o[:4].tolist() for i, o in enumerate(want)}
    assert {a: sorted(zip(r.before, r.b)) for a, r in got.items() if r.b} == {i: [(at, int(o[at])) for at in (0, 3, 120, 238)] for i, o in enumerate(want) if i % 5}
    assert sorted((r.a, r.b, r.place) for r in diagnostics.places(rows, "id", "v", metric, pairs).collect()) == sorted((i, int(o[at]), at + 1) for i, o in enumerate(want) for at in (0, 3, 120, 238) if i % 5)


def test_what_is_no_number_is_farthest():
    v = np.array([[0.0, 1], [np.nan, 0], [2, 2], [np.inf, 1], [1, 1]], np.float32)
    ids, owner, b = np.arange(5), np.repeat(np.arange(5), 4), np.array([[j for j in range(5) if j != i] for i in range(5)]).ravel()
    before, row, column, far = grid.standing(v, ids, owner, b, grid.exact(v[owner], v[b], "euclidean"), v, ids, 4, "euclidean")
    want = [[4, 2, 1, 3], [0, 2, 3, 4], [4, 0, 1, 3], [0, 1, 2, 4], [0, 2, 1, 3]]
    assert column.reshape(5, 4).tolist() == want
    assert before.reshape(5, 4).tolist() == [[w.index(j) for j in range(5) if j != i] for i, w in enumerate(want)]


def test_fidelity_looks_at_the_pairs_of_the_space_once(spark, monkeypatch):
    cells, passes = grid.cells, []
    monkeypatch.setattr(grid, "cells", lambda left, *rest: (passes.append([len(x) for x, in left.select(left.columns[1]).limit(1).collect()][0]), cells(left, *rest))[1])
    v = np.random.default_rng(3).normal(size=(80, 5)).astype(np.float32)
    rows = spark.createDataFrame([(i, x, x[:2]) for i, x in enumerate(v.tolist())], "id long, v array<float>, w array<float>")
    found = diagnostics.fidelity(rows, "id", ("v", "inner"), ("w", "euclidean"), 10).first()
    x = v.astype(float)
    far = -(x @ x.T), np.square(x[:, None, :2] - x[None, :, :2]).sum(2)
    for d in far:
        np.fill_diagonal(d, np.inf)
    high, low = (np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1) for d in far)
    loss = lambda near, true: 1 - 2 / (80 * 10 * (160 - 31)) * np.where(near < 10, np.maximum(true - 9, 0), 0)[~np.eye(80, dtype=bool)].sum()
    assert found.trust == pytest.approx(loss(low, high), abs=1e-12) and found.continuity == pytest.approx(loss(high, low), abs=1e-12)
    assert passes.count(5) == 1
