"""Toxicity scores from a factorization machine over hashed terms.

Terms are the distinct letter runs of the whole text, A-Z folded, and their beginnings (languages that
inflect an insult share its stem), each also as a term of its own where two, and where three or more, of
the text's words have it; all are hashed to 31 bits. The machine adds a bias, a weight for each term and,
for each pair of terms in a text, the inner product of their factors, so it learns what a pair says beyond
its parts (an insult beside the mention of a group). It is trained on at most TRAIN_ROWS labelled rows: those of smallest seeded hash among the rows that the caller leaves
in. Terms reach the machine by either of two likelihood-ratio tests against the label: a term's own (at most
MAX_TERMS of them), or what a pair tells beyond its two terms, for all pairs of PAIR_TERMS terms, those that
tell most by themselves and those that stand in most nearly half of the rows (a pair of rarer ones has too few rows in some cell to
tell much). So words that mean something only together are learnt, too. Weights shrink by L1, so that long
texts do not gather noise; the fit itself is full-batch AdaGrad and deterministic.

Scores depend on the text alone. Null texts count as empty, whose score is the bias's. Repeated rows are
scored alike; rows of a doc_id labelled twice count as toxic if either says so; without labelled rows every
score is 0. An empty table gives an empty result; further columns are ignored or, in filters, kept.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import Generations, cut, session, text_column

TRAIN_ROWS, SEED, THRESHOLD, TERM_BITS = 20_000, 29, 0.3, 31
MASK, STEMS = (1 << TERM_BITS) - 1, (4, 5, 6, 7, 8)
FACTORS, MIN_ROWS, MIN_G2, MAX_TERMS, ROUNDS, STEP, L1, L2 = 4, 5, 24.0, 16_384, 300, 0.25, 2e-4, 1e-4
#: Terms whose pairs are tested (a multiple of 8), and the statistic that a pair must add to its terms' own.
PAIR_TERMS, PAIR_G2 = 2048, 45.0
#: Examples that the fit unpacks at once; the share of the examples above which a term is kept as bits.
BLOCK, BUSY = 1024, 1 / 16
#: ASCII letters fold to lower case, other ASCII parts words, the bytes of other letters stay.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> set[bytes]:
    return set(text.translate(LETTERS).split())


def term_hash(term: bytes) -> int:
    return xxhash.xxh32_intdigest(term, SEED) & MASK


def word_hashes(word: bytes) -> tuple[int, ...]:
    """Of a word and its beginnings, by bytes of UTF-8."""
    return (term_hash(word), *(term_hash(b"^" + word[:n]) for n in STEMS if len(word) >= n))


def again(hashes, times: int):
    """The term that says that so many words share a term."""
    return (hashes * 0x9E3779B1 + times * 0x85EBCA6B) & MASK


def text_hashes(words: set[bytes], cache) -> np.ndarray:
    if not words:
        return np.empty(0, np.int64)
    found, n = np.unique(np.fromiter((h for w in words for h in cache[w]), np.int64), return_counts=True)
    return np.unique(np.concatenate([found, again(found[n >= 2], 2), again(found[n >= 3], 3)]))


@dataclass
class Machine:
    """bias, then for each known term hash (ascending) a weight and FACTORS factors."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray) -> float:
        """Of a text whose known terms are at these places."""
        v = self.factors[at]
        return float(self.bias + self.weights[at].sum() + 0.5 * (np.square(v.sum(0)) - np.square(v).sum(0)).sum())


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _g2(rows: F.Column, ones: F.Column, n: int, p: int) -> F.Column:
    """Likelihood-ratio statistic of a term's presence against the label."""
    total = F.lit(0.0)
    for seen, of in ((ones, p), (rows - ones, n - p)):
        for cell, margin in ((seen, rows), (of - seen, n - rows)):
            total = total + F.when(cell > 0, 2 * cell * F.log(cell * float(n) / (margin * float(max(of, 1))))).otherwise(0.0)
    return total


def screen(examples: DataFrame, n: int, p: int) -> np.ndarray:
    """The term hashes, ascending, that tell the labels of examples (label, hashes) apart, by themselves or in a pair."""
    counts = examples.select("label", F.explode("hashes").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("ones")).where(F.col("rows") >= MIN_ROWS)
    counts = cut(counts.withColumn("g2", F.round(_g2(F.col("rows"), F.col("ones"), n, p), 6)))
    alone = [r["h"] for r in counts.where(F.col("g2") >= MIN_G2).orderBy(F.desc("g2"), "h").limit(MAX_TERMS).select("h").collect()]
    even = [r["h"] for r in counts.orderBy(F.desc(F.least("rows", n - F.col("rows"))), "h").limit(PAIR_TERMS).select("h").collect()]
    several = np.sort(np.array(list(dict.fromkeys(alone[: PAIR_TERMS // 2] + even))[:PAIR_TERMS], np.int64))
    return np.union1d(np.array(alone, np.int64), several[telling_pairs(*_co_occurrence(examples, several))])


def _co_occurrence(examples: DataFrame, several: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Examples, ones, and of each pair of these terms the examples and ones that have both. A row sends a bit a term to the driver."""

    def held(batches):
        for batch in batches:
            out = []
            for hashes in batch.column(1).to_pylist():
                bits = np.zeros(-(-len(several) // 8) * 8, np.uint8)
                bits[np.flatnonzero(np.isin(several, hashes, assume_unique=True))] = 1
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["label", "bits"])

    rows = examples.mapInArrow(held, "label int, bits binary").toArrow()
    labels, bits, m = rows["label"].to_numpy(), rows["bits"], len(several)
    both, ones = np.zeros((m, m), np.float32), np.zeros((m, m), np.float32)
    for k in range(0, len(labels) if m else 0, 1024):
        part = np.frombuffer(b"".join(bits[k : k + 1024].to_pylist()), np.uint8).reshape(-1, -(-m // 8))
        x = np.unpackbits(part, axis=1)[:, :m].astype(np.float32)
        toxic = x[labels[k : k + 1024] == 1]
        both += x.T @ x
        ones += toxic.T @ toxic
    return len(labels), int((labels == 1).sum()), both, ones


def _cell(rows: np.ndarray, ones: np.ndarray, n: int, p: int) -> np.ndarray:
    """A cell's part of the likelihood-ratio statistic against the label."""
    with np.errstate(divide="ignore", invalid="ignore"):
        part = [np.where(seen > 0, seen * np.log(seen * (n / max(1, of)) / np.maximum(rows, 1)), 0.0) for seen, of in ((ones, p), (rows - ones, n - p))]
    return 2 * (part[0] + part[1])


def telling_pairs(n: int, p: int, both: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Which terms are in a pair whose four cells tell more of the label than its terms do by themselves. Works through rows of the matrix in blocks."""
    rows, toxic, found = np.diag(both).astype(float), np.diag(ones).astype(float), np.zeros(len(both), bool)
    alone = _cell(rows, toxic, n, p) + _cell(n - rows, p - toxic, n, p)
    for k in range(0, len(both), 256):
        b, o = both[k : k + 256].astype(float), ones[k : k + 256].astype(float)
        ra, ta = rows[k : k + 256, None], toxic[k : k + 256, None]
        cells = ((b, o), (ra - b, ta - o), (rows - b, toxic - o), (n - ra - rows + b, p - ta - toxic + o))
        more = sum(_cell(r, t, n, p) for r, t in cells) - np.maximum(alone[k : k + 256, None] + alone, 0)
        # a pair counts with rows in all cells: of nested terms one tells nothing beyond the other
        full = np.minimum.reduce([r for r, _ in cells]) >= MIN_ROWS
        hit = (more >= PAIR_G2) & full
        found[k : k + 256] |= hit.any(1)
        found |= hit.any(0)
    return found


def _blocks(examples: list[tuple[int, np.ndarray]], m: int):
    """Which of m terms the examples have, a byte each, for BLOCK examples at a time."""
    for k in range(0, len(examples), BLOCK):
        held = np.zeros((len(examples[k : k + BLOCK]), m), np.uint8)
        for i, (_, at) in enumerate(examples[k : k + BLOCK]):
            held[i, at.astype(np.int64)] = 1
        yield held


def fit(examples: list[tuple[int, np.ndarray]], known: np.ndarray) -> Machine:
    """Of (label, places in `known` of the terms present) pairs. Terms of over BUSY of the examples are kept as bits and
    multiplied as a matrix, a block of examples at a time; the others are kept as places."""
    y = np.array([label for label, _ in examples], float)
    if not len(y) or not y.any():
        return Machine(-35.0, np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    rows, columns = np.zeros(len(known), np.int64), []
    for held in _blocks(examples, len(known)):
        rows += held.sum(0, dtype=np.int64)
        columns.append(np.packbits(held, axis=0))
    # of terms that stand in the same texts (a stem and its parts) one serves
    first: dict[bytes, int] = {}
    own = np.array([first.setdefault(xxhash.xxh3_128_digest(c.tobytes()), k) == k for k, c in enumerate(np.concatenate(columns).T)], bool)
    own, columns = np.flatnonzero(own), None
    busy, rare = np.flatnonzero(rows[own] > BUSY * len(y)), np.flatnonzero(rows[own] <= BUSY * len(y))
    parts = []
    for k, held in enumerate(_blocks(examples, len(known))):
        row, at = np.nonzero(held[:, own[rare]])
        parts.append((y[k * BLOCK : (k + 1) * BLOCK], np.packbits(held[:, own[busy]], axis=1), row, rare[at]))
    known, n, m = known[own], len(y), len(own)
    bias, w, v = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)), np.zeros(m), np.random.default_rng(SEED).normal(0, 0.01, (m, FACTORS))
    past_b, past_w, past_v = 1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)
    for _ in range(ROUNDS):
        # of each term its weight, its factors' squares and its factors; back come the gaps and the gaps times the sums
        there, back, gb = np.column_stack([w, np.square(v).sum(1), v]), np.zeros((m, 1 + FACTORS)), 0.0
        there_busy, back_busy = there[busy].astype(np.float32), np.zeros((len(busy), 1 + FACTORS))
        for label, bits, row, at in parts:
            held = np.unpackbits(bits, axis=1, count=len(busy)).astype(np.float32)
            got = held @ there_busy + np.stack([np.bincount(row, there[at, c], minlength=len(label)) for c in range(2 + FACTORS)], 1)
            gap = (sigmoid(bias + got[:, 0] + 0.5 * (np.square(got[:, 2:]).sum(1) - got[:, 1])) - label) / n
            gaps = np.column_stack([gap, gap[:, None] * got[:, 2:]])
            back_busy += held.T @ gaps.astype(np.float32)
            back += np.stack([np.bincount(at, gaps[row, c], minlength=m) for c in range(1 + FACTORS)], 1)
            gb += gap.sum()
        back[busy] += back_busy
        gw, gv = back[:, 0], back[:, 1:] - v * back[:, :1] + L2 * v
        past_b, past_w, past_v = past_b + gb * gb, past_w + gw * gw, past_v + gv * gv
        bias -= STEP * gb / math.sqrt(past_b)
        rate = STEP / np.sqrt(past_w)
        w = w - rate * gw
        w = np.sign(w) * np.maximum(np.abs(w) - rate * L1, 0)
        v = v - 0.1 * STEP * gv / np.sqrt(past_v)
    used = (w != 0) | (np.abs(v).max(1, initial=0) > 0.05)
    return Machine(float(bias), known[used], w[used], v[used])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Of the labelled rows of docs; `rows`, the bound of the sample, also bounds what is broadcast and collected.

    Terms are counted and screened where the texts are; the driver gets each example's few screened terms.
    Equal examples count once, so that copies don't lend their words weight."""
    spark = session(docs.sparkSession)
    sample = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(rows)
    sample = spark.createDataFrame(sample.collect(), "doc_id long, label int")
    joined = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).cast("binary").alias("text")).join(F.broadcast(sample), "doc_id").select("label", "text")

    def hashed(batches):
        cache = Generations(word_hashes, 100_000)
        for batch in batches:
            found = [text_hashes(terms(text), cache).astype(np.int32) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["label", "hashes"])

    examples = cut(joined.mapInArrow(hashed, "label int, hashes array<int>").groupBy("label", F.xxhash64("hashes").alias("key")).agg(F.first("hashes").alias("hashes")).select("label", "hashes"))
    n, p = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not p:
        return fit([], np.empty(0, np.int64))
    known = screen(examples, n, p)

    def placed(batches):
        for batch in batches:
            out = []
            for hashes in batch.column(1).to_pylist():
                at = np.searchsorted(known, hashes)
                out.append(at[known[np.minimum(at, len(known) - 1)] == hashes].astype(np.int32).tobytes() if len(known) and len(hashes) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["label", "at"])

    return fit([(r["label"], np.frombuffer(r["at"], np.int32)) for r in sorted(examples.mapInArrow(placed, "label int, at binary").collect())], known)


class Scorer:
    """Scores texts; one cache of the terms of a word that matter to the machine for all texts of a task."""

    def __init__(self, machine: Machine):
        self.machine, self.place = machine, {int(h): k for k, h in enumerate(machine.known)}
        self.cache = Generations(self._of, 200_000)
        self.empty = float(sigmoid(machine.bias))

    def _of(self, word: bytes) -> tuple[int, ...]:
        return tuple(h for h in word_hashes(word) if h in self.place or again(h, 2) in self.place or again(h, 3) in self.place)

    def __call__(self, text: bytes) -> float:
        counts = Counter(h for hashes in filter(None, map(self.cache.__getitem__, terms(text))) for h in hashes)
        present = {h for h in counts} | {again(h, 2) for h, n in counts.items() if n >= 2} | {again(h, 3) for h, n in counts.items() if n >= 3}
        at = sorted(self.place[h] for h in present if h in self.place)
        return float(sigmoid(self.machine.margin(np.array(at)))) if at else self.empty


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of each row."""
    session(docs.sparkSession)

    def run(batches):
        scorer = Scorer(machine)
        for batch in batches:
            scores = np.array([scorer(text) for text in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).cast("binary").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that score under the threshold: one pass, no shuffle."""
    session(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(machine)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([scorer(text or b"") < threshold for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
