"""All pairs of two sets of rows, in cells of bounded size: each side is cut into blocks, and a block meets each of the other side's in a task of its own."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a side of a cell of rows that are joined, and of one whose vectors are multiplied.
CELL_ROWS, SIDE_ROWS = 4096, 32_768
#: Rows and columns that are multiplied at once, the first columns of a row, digits that distances are rounded to.
STRIP, CHUNK, HEAD, DIGITS = 512, 4096, 512, 9
#: Rows and columns of a strip whose distances are sorted, open distances that targets do not share, pairs that are measured at once.
ROWS, COLUMNS, HITS, PAIRS = 128, 4096, 64, 16_384
#: Components up to which vectors are sorted into places, and rows of a place.
DIMENSIONS, PLACE = 3, 512


def blocks(n: int, parallelism: int) -> int:
    """Blocks of a side of n rows: of SIDE_ROWS at most, and enough of them to keep the cluster evenly busy while they are not tiny."""
    return max(1, -(-n // SIDE_ROWS), min(math.isqrt(4 * parallelism), n // 1024), min(math.isqrt(parallelism), n // 256))


def cells(left: DataFrame, right: DataFrame, left_id: str, right_id: str, run: Callable, schema: str) -> DataFrame:
    """run(block of left, block of right) of every pair of blocks."""
    parallelism = left.sparkSession.sparkContext.defaultParallelism
    down, across = blocks(left.count(), parallelism), blocks(right.count(), parallelism)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # more partitions than cells, so that hardly a task gets several while others get none
    dealt = lambda side: side.repartition(3 * down * across, "_i", "_j").groupBy("_i", "_j")
    a = left.select("*", F.pmod(F.xxhash64(left_id), F.lit(down)).cast("int").alias("_i")).select("*", every(across).alias("_j"))
    b = right.select("*", F.pmod(F.xxhash64(right_id), F.lit(across)).cast("int").alias("_j")).select("*", every(down).alias("_i"))
    return dealt(a).cogroup(dealt(b)).applyInPandas(run, schema)


def compact(rows: DataFrame, vector: str) -> Column:
    """The vector as it travels to the cells: floats stay floats, anything else becomes doubles."""
    kind = rows.schema[vector].dataType.simpleString()
    return F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in vectors])


def native(vectors: pd.Series) -> np.ndarray:
    """As stacked(), in the precision that they travel in."""
    return np.stack(vectors.to_list())


def raw(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Between rows. inner: the product's negative; euclidean: the square."""
    if metric == "euclidean":
        out = np.zeros((len(a), len(b)))
        for k in range(a.shape[1]):
            apart = a[:, k, None] - b[None, :, k]
            out += np.square(apart, out=apart)
        return out
    return -a @ b.T


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """As raw(); rounded, so that equal vectors tie however the products were summed."""
    return np.round(raw(a, b, metric), DIGITS)


def strips(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, metric: str):
    """(from row, from column, raw distances) of a against b, whose ids ascend, in pieces of STRIP by CHUNK, a strip's columns in turn; NaN between rows of one id."""
    first, end = (np.searchsorted(b_ids, a_ids, side) for side in ("left", "right"))
    edges = [0, *range(min(HEAD, len(b)), len(b), CHUNK), len(b)]
    for at in range(0, len(a), STRIP):
        for lo, hi in zip(edges, edges[1:]):
            d = raw(a[at : at + STRIP], b[lo:hi], metric)
            own_first, own_end = (np.clip(x[at : at + STRIP] - lo, 0, hi - lo) for x in (first, end))
            for row in np.flatnonzero(own_first < own_end):
                d[row, own_first[row] : own_end[row]] = np.nan
            yield at, lo, d


def smallest(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int, metric: str):
    """(row, column, distance) of each row's k nearest others, ties by id. Columns come by id, so of what ties with the k best so far nothing is taken up, and what lies beyond them isn't even rounded."""
    order, half = np.argsort(b_ids, kind="stable"), 0.5 * 0.1**DIGITS
    empty = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    done, held, bound = [], empty, None
    for at, lo, d in strips(a, a_ids, b[order], b_ids[order], metric):
        if lo == 0:
            done.append(held)
            held = empty
            bound = np.partition(d, k - 1, axis=1)[:, k - 1] + 4 * half if d.shape[1] >= k else np.full(len(d), np.inf)
            bound[np.isnan(bound)] = np.inf
        i, j = np.divmod(np.flatnonzero(d <= bound[:, None]), d.shape[1])
        if not len(i):
            continue
        row, column, far = (np.concatenate(x) for x in zip(held, (i + at, j + lo, np.round(d[i, j], DIGITS))))
        by = np.lexsort((column, far, row))
        row, column, far = row[by], column[by], far[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kth = place == k - 1
        bound[row[kth] - at] = far[kth] - 0.9 * half
        held = tuple(x[place < k] for x in (row, column, far))
    row, column, far = (np.concatenate(x) for x in zip(empty, *done, held))
    return row, order[column], far


def exact(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Of row by row, summed in the order of the components as doubles: what is equal ties, whatever it is compared beside. What is no number is farthest."""
    out = np.empty(len(a))
    with np.errstate(all="ignore"):
        for at in range(0, len(a), PAIRS):
            x, y = a[at : at + PAIRS].astype(float), b[at : at + PAIRS].astype(float)
            terms = np.square(x - y) if metric == "euclidean" else x * y
            total = np.add.accumulate(terms, axis=1, out=terms)[:, -1]  # in order, which sum() is not
            out[at : at + PAIRS] = total if metric == "euclidean" else -total
    return np.where(np.isnan(out), np.inf, out)


class Rough:
    """Distances between rows in the vectors' own precision, and how far they may be from exact()."""

    def __init__(self, a: np.ndarray, b: np.ndarray, metric: str):
        with np.errstate(all="ignore"):
            long_a, long_b = (np.where(np.isfinite(x).all(1), np.linalg.norm(x.astype(float), axis=1), 0.0) for x in (a, b))
        longest = long_b.max()
        single = a.dtype == b.dtype == np.float32 and max(long_a.max(), longest) < 1e15
        kind = np.float32 if single else float
        self.a, self.b, self.metric = a.astype(kind, copy=False), b.astype(kind, copy=False), metric
        self.components = np.ascontiguousarray(self.b.T) if metric == "euclidean" else None
        self.whole = np.isfinite(self.a).all() and np.isfinite(self.b).all()
        # terms and roundings of a sum; the exact one has them as well
        share = (a.shape[1] + 8) * (np.finfo(kind).eps / 2 + np.finfo(float).eps)
        tiny = a.shape[1] * float(np.finfo(kind).tiny)
        self.share, self.slack = (share, np.full(len(a), tiny)) if metric == "euclidean" else (0.0, share * long_a * longest + tiny)

    def between(self, rows: slice, columns: slice, d: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """In d, which like spare is used again: fresh memory costs as much as the distances."""
        a, b = self.a[rows], self.b[columns]
        d, spare = d[: len(a), : len(b)], spare[: len(a), : len(b)]
        with np.errstate(all="ignore"):
            if self.metric != "euclidean":
                np.matmul(-a, b.T, out=d)
            else:
                for at, (x, y) in enumerate(zip(a.T, self.components[:, columns])):
                    apart = np.subtract(x[:, None], y, out=spare if at else d)
                    np.square(apart, out=apart)
                    if at:
                        d += apart
        if not self.whole:
            d[np.isnan(d)] = np.inf
        return d

    def least(self, far: np.ndarray, row: np.ndarray) -> np.ndarray:
        """A rough distance under this belongs to an exact one under far."""
        with np.errstate(all="ignore"):
            return np.nextafter((far * (1 - self.share) - self.slack[row]).astype(self.a.dtype), self.a.dtype.type(-np.inf))

    def most(self, far: np.ndarray, row: np.ndarray) -> np.ndarray:
        """A rough distance over this belongs to an exact one over far; and the other way round."""
        with np.errstate(all="ignore"):
            return np.nextafter((far * (1 + self.share) + self.slack[row]).astype(self.a.dtype), self.a.dtype.type(np.inf))


def standing(a: np.ndarray, a_ids: np.ndarray, owner: np.ndarray, target: np.ndarray, far: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int, metric: str):
    """(before, row, column, distance): how many rows of b come before each target (its row of a, which ascends, its id and exact distance), and each row's k nearest; by distance, then id, other ids only.

    Rough distances settle nearly all; the exact one is taken only of what they leave open, and of candidates."""
    if metric == "euclidean" and a.shape[1] <= DIMENSIONS and not len(owner) and all(float(np.abs(x).max()) < 1e150 for x in (a, b)):
        return np.zeros(0, np.int64), *beside(a, a_ids, b, b_ids, k)
    order = np.argsort(b_ids, kind="stable")
    b, b_ids = b[order], b_ids[order]
    rough, first, end = Rough(a, b, metric), *(np.searchsorted(b_ids, a_ids, side) for side in ("left", "right"))
    low, high, starts = rough.least(far, owner), rough.most(far, owner), np.searchsorted(owner, np.arange(len(a) + 1))
    # a row's edges stand together, the low ones first
    at_low = np.arange(len(owner)) + starts[owner]
    at_high = at_low + np.diff(starts)[owner]
    edges = np.empty(2 * len(owner), low.dtype)
    edges[at_low], edges[at_high] = np.nextafter(low, low.dtype.type(-np.inf)), high
    found, before, starts = np.zeros(len(edges), np.int64), np.zeros(len(owner), np.int64), starts.tolist()
    space, spare, within = (np.zeros((ROWS, -(-min(COLUMNS, len(b)) // 8) * 8), t) for t in (rough.a.dtype, rough.a.dtype, bool))
    empty = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    done = [empty]
    for at in range(0, len(a), ROWS):
        rows = slice(at, min(at + ROWS, len(a)))
        asked, held, bound = slice(starts[rows.start], starts[rows.stop]), empty, None
        for lo in range(0, len(b), COLUMNS):
            columns = slice(lo, min(lo + COLUMNS, len(b)))
            d = rough.between(rows, columns, space, spare)
            own_first, own_end = (np.clip(x[rows] - lo, 0, d.shape[1]) for x in (first, end))
            for row in np.flatnonzero(own_first < own_end):
                d[row, own_first[row] : own_end[row]] = np.inf
            if asked.start < asked.stop:
                ranked = spare[: d.shape[0], : d.shape[1]]
                np.copyto(ranked, d)
                ranked.sort(axis=1)
                for r, s, e in zip(ranked, starts[rows], starts[at + 1 : rows.stop + 1]):
                    found[2 * s : 2 * e] = r.searchsorted(edges[2 * s : 2 * e], "right")
                under, upto = found[at_low[asked]], found[at_high[asked]]
                before[asked] += under
                _settle(a, a_ids, owner, target, far, b, b_ids, low, high, asked.start + np.flatnonzero(upto > under), at, lo, d, metric, before)
            if not k:
                continue
            if bound is None:
                every = np.arange(rows.start, rows.stop)
                kth = np.partition(d, k - 1, axis=1)[:, k - 1].astype(float) if d.shape[1] >= k else np.full(len(d), np.inf)
                bound = rough.most(rough.most(kth, every).astype(float), every)
            np.less_equal(d, bound[:, None], out=within[: d.shape[0], : d.shape[1]])
            within[:, d.shape[1] :] = False
            i, j = np.divmod(_set(within[: d.shape[0]]), within.shape[1])
            i, j = i + at, j + lo
            other = a_ids[i] != b_ids[j]
            i, j = i[other], j[other]
            if not len(i):
                continue
            row, column, x = (np.concatenate(z) for z in zip(held, (i, j, _measured(a, i, b, j, metric))))
            by = np.lexsort((column, x, row))
            row, column, x = row[by], column[by], x[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            full = place == k - 1
            bound[row[full] - at] = rough.most(x[full], row[full])
            held = tuple(z[place < k] for z in (row, column, x))
        done.append(held)
    row, column, x = (np.concatenate(z) for z in zip(*done))
    return before, row, order[column], x


def dealt(points: np.ndarray, size: int, rows: np.ndarray | None = None) -> list[np.ndarray]:
    """Row numbers in places of at most `size` rows, halved at the median of the widest component."""
    rows = np.arange(len(points)) if rows is None else rows
    if len(rows) <= size:
        return [rows]
    some, half = points[rows], len(rows) // 2
    by = np.argpartition(some[:, np.ptp(some, axis=0).argmax()], half)
    return dealt(points, size, rows[by[:half]]) + dealt(points, size, rows[by[half:]])


def beside(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int):
    """(row, column, distance): as standing()'s nearest by the euclidean metric, for few and finite components. Both sides lie in places; a place of b is left out where its box is farther than all of a place's rows have k."""
    a, b = a.astype(float), b.astype(float)
    there = dealt(b, PLACE)
    low, high = (np.array([f(b[t], axis=0) for t in there]) for f in (np.min, np.max))
    done = []
    for here in dealt(a, max(1, PLACE // 8)):
        some, bound = a[here], np.full(len(here), np.inf)
        held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        away = np.square(np.maximum(0, np.maximum(low - some.max(axis=0), some.min(axis=0) - high))).sum(axis=1)
        for t in np.argsort(away):
            if away[t] * (1 - 1e-9) > bound.max():
                break
            d, columns = raw(some, b[there[t]], "euclidean"), there[t]
            own = a_ids[here][:, None] == b_ids[columns]
            d[own] = np.inf
            if d.shape[1] >= k and np.isinf(bound).any():
                bound = np.partition(d, k - 1, axis=1)[:, k - 1]
            i, j = np.divmod(np.flatnonzero(d <= bound[:, None]), d.shape[1])
            other = ~own[i, j]
            i, j = i[other], j[other]
            row, column, far = (np.concatenate(z) for z in zip(held, (i, columns[j], d[i, j])))
            by = np.lexsort((b_ids[column], far, row))
            row, column, far = row[by], column[by], far[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            full = place == k - 1
            bound[row[full]] = far[full]
            held = tuple(z[place < k] for z in (row, column, far))
        done.append((here[held[0]], *held[1:]))
    row, column, far = (np.concatenate(z) for z in zip(*done))
    by = np.argsort(row, kind="stable")
    return row[by], column[by], far[by]


def _set(flags: np.ndarray) -> np.ndarray:
    """Flat positions of the few that are set; eight flags are looked at as one number."""
    eight = np.flatnonzero(flags.reshape(-1).view(np.uint64))
    which, bit = np.nonzero(flags.reshape(-1, 8)[eight])
    return eight[which] * 8 + bit


def _measured(a, i, b, j, metric):
    return np.concatenate([np.empty(0), *(exact(a[i[at : at + PAIRS]], b[j[at : at + PAIRS]], metric) for at in range(0, len(i), PAIRS))])


def _settle(a, a_ids, owner, target, far, b, b_ids, low, high, open_, at, lo, d, metric, before):
    """Counts what precedes targets among the distances that the rough ones leave open, in a strip's columns from lo on. Where these are many, as with copies, targets of one distance share what is measured."""
    some, near, last = [], [], None
    order = open_[np.lexsort((far[open_], owner[open_]))]
    for t, row, x, least, most in zip(order.tolist(), owner[order].tolist(), far[order].tolist(), low[order], high[order]):
        if last != (row, x):
            last, those = (row, x), d[row - at]
            (j,) = ((those >= least) & (those <= most)).nonzero()
            many = len(j) > HITS
            if many:
                j = j + lo
                j = j[b_ids[j] != a_ids[row]]
                measured = _measured(a, np.full(len(j), row), b, j, metric)
                nearer, tied = np.count_nonzero(measured < x), b_ids[j[measured == x]]
        if many:
            before[t] += nearer + np.searchsorted(tied, target[t])
        else:
            some.append(t)
            near.append(j)
    if some:
        t, j = np.repeat(some, [len(x) for x in near]), np.concatenate(near) + lo
        x = _measured(a, owner[t], b, j, metric)
        earlier = ((x < far[t]) | ((x == far[t]) & (b_ids[j] < target[t]))) & (b_ids[j] != a_ids[owner[t]])
        np.add.at(before, t[earlier], 1)
