"""Language-model scores from an Elias-Fano n-gram trie.

Training counts every n-gram of the training texts up to `order`, level by level. Words take ids in hash
order. A level's nodes are its kept n-grams sorted by (parent node, word): monotone Elias-Fano pointers
lead from a parent to the range of its successors; their words, offset by the parent's place times the number
of words, are one Elias-Fano sequence a shard, so a query is a successor search relative to its context:
the high bits select a bucket of one or two nodes, cut to the parent's range, and the low bits decide. Nodes
carry their smoothed probability, and parents the weight that is left for the shorter context, quantised to
16 bits of log10: under eight bytes a node in all. Smoothing is interpolated absolute discounting:
p(w|c) = max(n(cw) - D, 0)/n(c) + left(c) p(w|c'), down to words, where the discounted mass goes to the unknown
word. All n-grams are kept (min_count 1); with a larger one, those of two words and more that were seen less
often are counted, but not kept: their mass goes to the shorter context, so sums stay one.

A level is cut into shards of about equal training mass at keys that the driver knows, a heavy parent's
successors over several; tasks count blocks of texts into sorted key lists, which meet at their shard.
Shards are files in the shared folder (any store that pyarrow reaches), memory-mapped by the workers that
score; where the folder is not a local path, Spark hands the files to the executors. Counts above words are
kept in files of their own and deleted when the level above is written. The driver sees a few numbers a shard.

Tokens are runs of other than the six ASCII spaces, A-Z folded, and one end a text. Null texts count as
empty (their end is scored). Without training texts every probability is 1. A row whose doc_id is null is
scored; whether it trains is the caller's choice. Repeated rows count as often as they stand. An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import new_folder, session, text_column

ORDER, DISCOUNT, MIN_COUNT, MIN_SHARDS, SHARD_TOKENS = 3, 0.8, 1, 8, 8_000_000
FLUSH_TOKENS, BLOCK_TOKENS, SCALE, END, SEED = 3_000_000, 1_000_000, 65535 / 16, b"\n", 5
NO = np.int64(-1)
#: Places that a shard reports of its training mass, for the cuts of the level above.
POINTS = 16
#: Keys that a shard sorts, and nodes whose probabilities it computes, at once.
MERGE_KEYS = 1 << 20
#: Words of one length that are hashed at once.
STRIP = 1 << 13


# ---- Elias-Fano ----------------------------------------------------------------------------------


def pack_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest bits of each value, one after the other, and a word more than they need."""
    out = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    step = 1 << 16  # so many values end at a word's border
    for k in range(0, len(values) if bits else 0, step):
        part = np.ascontiguousarray(values[k : k + step]).astype("<u8").view(np.uint8).reshape(-1, 8)
        packed = np.packbits(np.unpackbits(part, axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")
        out[k * bits // 64 :][: len(packed)] = packed
    return out


def unpack_bits(packed: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(at), np.uint64)
    off = at * bits
    word, shift = off >> 6, (off & 63).astype(np.uint64)
    return ((packed[word] >> shift) | (packed[word + 1] << (np.uint64(63) - shift) << np.uint64(1))) & np.uint64((1 << bits) - 1)


def ef_encode(values: np.ndarray, zeros: bool = False) -> dict[str, np.ndarray]:
    """A monotone sequence as low bits, unary high bits, and for each word of these the ones (or zeros) before it."""
    n, top = len(values), int(values[-1]) + 1 if len(values) else 1
    low_bits = max(0, int(math.log2(top / n))) if n and top > n else 0
    values = values.astype(np.uint64)
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(64 * ((int(ones[-1]) if n else 0) // 64 + 2), np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = np.cumsum(np.bitwise_count(~high if zeros else high), dtype=np.int64)
    kind = np.uint32 if counts[-1] < 1 << 32 else np.int64
    return {"low": pack_bits(values, low_bits), "high": high, "before": np.concatenate(([0], counts[:-1])).astype(kind), "low_bits": np.array([low_bits]), "size": np.array([n])}


BYTES, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the one of each rank in each byte.
IN_BYTE = np.array([([k for k in range(8) if byte >> k & 1] + [0] * 8)[:8] for byte in range(256)], np.int64).reshape(-1)


def _select(bits: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one of this rank within each word: its byte by sums of all bytes at once, then a table."""
    two, four = np.uint64(2), np.uint64(4)
    sums = bits - ((bits >> np.uint64(1)) & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + ((sums >> two) & np.uint64(0x3333333333333333))
    sums = ((sums + (sums >> four)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * BYTES
    rank = rank.astype(np.uint64)
    shift = np.minimum(np.bitwise_count(((rank * BYTES) | TOPS) - sums & TOPS), 7).astype(np.uint64) << np.uint64(3)
    within = rank - (((sums << np.uint64(8)) >> shift) & np.uint64(255))
    return shift.astype(np.int64) + IN_BYTE[(((bits >> shift) & np.uint64(255)) << np.uint64(3) | (within & np.uint64(7))).astype(np.int64)]


def ef_access(ef: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Values at the places `at`: a select of the high bits, found in the directory (of ones), then within a word."""
    word = np.searchsorted(ef["before"], at.astype(ef["before"].dtype), side="right") - 1
    high = 64 * word + _select(ef["high"][word], at - ef["before"][word].astype(np.int64)) - at
    bits = int(ef["low_bits"][0])
    return (high << bits) | unpack_bits(ef["low"], bits, at).astype(np.int64)


def ef_bucket(ef: dict[str, np.ndarray], high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first value whose high bits are `high` or more and of the first beyond; the directory counts zeros."""
    size, before = int(ef["size"][0]), ef["before"]
    first, end = np.full(len(high), size), np.full(len(high), size)
    some = np.flatnonzero(high <= 64 * len(before) - size)  # zeros in all
    rank = high[some] - 1
    word = np.searchsorted(before, np.maximum(rank, 0).astype(before.dtype), side="right") - 1
    bit = np.where(rank < 0, 0, 64 * word + _select(~ef["high"][word], rank - before[word].astype(np.int64)) + 1)
    # the bucket's ones follow its zero; where they reach the word's end, words that follow are looked at
    run, todo, at = np.zeros(len(some), np.int64), np.arange(len(some)), bit
    while len(todo):
        inside = at < 64 * len(before)
        todo, at = todo[inside], at[inside]
        shift = at & 63
        rest = ef["high"][at >> 6] >> shift.astype(np.uint64)
        more = np.minimum(np.bitwise_count((~rest & (rest + np.uint64(1))) - np.uint64(1)).astype(np.int64), 64 - shift)
        run[todo] += more
        on = more == 64 - shift
        todo, at = todo[on], (at + more)[on]
    first[some] = np.minimum(bit - rank - 1, size)
    end[some] = np.minimum(first[some] + run, size)
    return first, end


def ef_find(ef: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Place of each value among those from lo to hi (exclusive), which rise; -1 if it isn't there."""
    out, bits = np.full(len(value), NO), int(ef["low_bits"][0])
    high, low = value >> bits, (value & ((1 << bits) - 1)).astype(np.uint64)
    first, end = ef_bucket(ef, high)
    lo, hi = np.maximum(lo, first), np.minimum(hi, end)
    live = np.flatnonzero(hi > lo)
    lo, hi, low = lo[live], hi[live], low[live]
    while len(live):
        mid = (lo + hi) >> 1
        got = unpack_bits(ef["low"], bits, mid)
        hit, less = got == low, got < low
        out[live[hit]] = mid[hit]
        lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
        on = ~hit & (hi > lo)
        live, lo, hi, low = live[on], lo[on], hi[on], low[on]
    return out


# ---- shared files --------------------------------------------------------------------------------


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a header's length, the header, arrays at multiples of 64. Written beside, then moved: a repeated task replaces it whole."""
    head, at, arrays = {}, 0, {key: np.ascontiguousarray(a) for key, a in arrays.items()}
    for key, a in arrays.items():
        head[key] = (at, str(a.dtype), len(a))
        at += a.nbytes + -a.nbytes % 64
    header = json.dumps(head).encode()
    header += b" " * (-(len(header) + 8) % 64)
    fs, path = pafs.FileSystem.from_uri(_uri(folder))
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{np.random.default_rng().integers(1 << 62)}"
    with fs.open_output_stream(part) as f:
        f.write(len(header).to_bytes(8, "little") + header)
        for a in arrays.values():
            f.write(a.view(np.uint8))
            f.write(bytes(-a.nbytes % 64))
    fs.move(part, f"{path}/{name}")


def _local(folder: str) -> str | None:
    if folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)[1]
    return None if "://" in folder else folder


_OPEN: dict[str, dict[str, np.ndarray]] = {}
#: Bytes that a worker keeps mapped; beyond them it starts anew, as mapped pages count as its memory.
MAP_BYTES = 128 << 20


def _load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped once a worker."""
    key = f"{folder}/{name}"
    if key not in _OPEN:
        local = _local(folder)
        data = np.memmap(f"{local}/{name}" if local else SparkFiles.get(f"{folder.rsplit('/', 1)[1]}-{name}"), np.uint8, "r").view(np.ndarray)
        if sum(a["_bytes"][0] for a in _OPEN.values()) + len(data) > MAP_BYTES:
            _OPEN.clear()
        n = int.from_bytes(data[:8].tobytes(), "little")
        _OPEN[key] = {k: data[8 + n + at :][: np.dtype(kind).itemsize * size].view(kind) for k, (at, kind, size) in json.loads(data[8 : 8 + n].tobytes()).items()} | {"_bytes": np.array([len(data)])}
    return _OPEN[key]


def _part(arrays: dict[str, np.ndarray], name: str) -> dict[str, np.ndarray]:
    """The Elias-Fano sequence of this name in a file."""
    return {k: arrays[f"{name}_{k}"] for k in ("low", "high", "before", "low_bits", "size")}


# ---- the model -----------------------------------------------------------------------------------


@dataclass
class Level:
    """What the driver knows of a level: nodes before each shard, keys at which shards begin (but the first), the weight left of parents that shards share, and where its training mass lies: (node, mass before it, its own) at some places."""

    offsets: list[int]
    cuts: np.ndarray
    shared: dict[int, float]
    points: list[tuple[int, int, int]]


@dataclass
class Model:
    folder: str
    shards: int
    n: int  # training tokens
    v: int  # different ones
    unknown: float  # discount of words
    levels: list[Level] = field(default_factory=list)

    @property
    def word_bits(self) -> int:
        return max(1, self.v.bit_length())

    def next_cuts(self) -> np.ndarray:
        """Keys that cut the successors of the top level's nodes into shards of about equal mass; words lie evenly, as their ids are hashes in order."""
        points, bits = self.levels[-1].points, self.word_bits
        if not points:
            return np.empty(0, np.uint64)
        node, before, own = (np.array(x, np.float64) for x in zip(*points))
        total, end = before[-1] + own[-1], float(self.levels[-1].offsets[-1])
        cuts = []
        for k in range(1, self.shards):
            goal = total * k / self.shards
            i = int(np.searchsorted(before, goal, side="right")) - 1
            if goal < before[i] + own[i]:  # within the successors of one parent
                at, word = int(node[i]), int((goal - before[i]) / own[i] * self.v)
            else:
                a, b, c = before[i] + own[i], before[i + 1] if i + 1 < len(node) else total, node[i + 1] if i + 1 < len(node) else end
                at, word = int(node[i] + 1 + (c - node[i] - 1) * min(1.0, (goal - a) / max(1.0, b - a))), 0
            cuts.append((at << bits) | word)
        return np.maximum.accumulate(np.array(cuts, np.uint64)) if cuts else np.empty(0, np.uint64)


def word_hash(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token, SEED)


#: XXH64's primes, and the length from which it goes by stripes.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
STRIPES = 32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def word_hashes(words: pa.Array) -> np.ndarray:
    """word_hash of each of binary words, those of one length at once; words of STRIPES bytes and more one by one."""
    out = np.empty(len(words), np.uint64)
    if not len(words):
        return out
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    each = {size: np.ndarray((max(0, len(data) - size + 1),), f"<u{size}", data, strides=(1,)) for size in (8, 4, 1)}
    lengths = np.minimum(np.diff(ends), STRIPES).astype(np.uint8)
    order = np.argsort(lengths, kind="stable")
    bounds = np.searchsorted(lengths[order], np.arange(STRIPES + 1))
    for length, (a, b) in enumerate(zip(bounds, bounds[1:])):
        for c in range(a, b, STRIP):
            mine = order[c : min(b, c + STRIP)]
            at = ends[mine].astype(np.int64)
            h, left = np.full(len(mine), np.uint64(SEED + length) + P5), length
            while left >= 8:
                h = _turned(h ^ _turned(each[8][at] * P2, 31) * P1, 27) * P1 + P4
                at, left = at + 8, left - 8
            if left >= 4:
                h = _turned(h ^ each[4][at].astype(np.uint64) * P1, 23) * P2 + P3
                at, left = at + 4, left - 4
            for k in range(left):
                h = _turned(h ^ each[1][at + k].astype(np.uint64) * P5, 11) * P1
            h = (h ^ (h >> np.uint64(33))) * P2
            h = (h ^ (h >> np.uint64(29))) * P3
            out[mine] = h ^ (h >> np.uint64(32))
    for k in order[bounds[-1] :].tolist():
        out[k] = word_hash(words[k].as_py())
    return out


class Reader:
    """Looks tokens and n-grams up in a model."""

    def __init__(self, model: Model):
        self.model = model

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words by their hashes, -1 if unknown: different ones in order, so that each is sought once."""
        m = self.model
        different, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(different), NO)
        shard = (different >> np.uint64(48)).astype(np.int64) * m.shards >> 16
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(shard)]):
            s, mine = int(shard[a]), different[a:b]
            known = _load(m.folder, f"1-{s}")["hash"]
            at = np.searchsorted(known, mine)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == mine[hit]
            out[a:b][hit] = at[hit] + m.levels[0].offsets[s]
        return out[back]

    def _by_shard(self, level: int, nodes: np.ndarray):
        """(shard, slice, local index) for rising nodes."""
        offsets = self.model.levels[level].offsets
        bounds = np.searchsorted(nodes, offsets)
        for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            at = slice(bounds[s], bounds[s + 1])
            yield s, at, nodes[at] - offsets[s]

    def counts(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Training count of each node (level 0: words)."""
        n = np.zeros(len(nodes), np.int64)
        for s, at, local in self._by_shard(level, nodes):
            arrays = _load(self.model.folder, f"{level + 1}-{s}-n" if level else f"{level + 1}-{s}")
            n[at] = some = arrays["count"][local].astype(np.int64)
            if level and len(large := np.flatnonzero(some == 255)):
                n[np.arange(len(nodes))[at][large]] = arrays["large"][np.searchsorted(arrays["large_at"], local[large])]
        return n

    def parents(self, level: int, nodes: np.ndarray) -> dict[str, np.ndarray]:
        """What a lookup below these (rising) nodes of `level` needs."""
        above, bits = self.model.levels[level + 1], np.uint64(self.model.word_bits)
        keys = nodes.astype(np.uint64) << bits
        first = np.searchsorted(above.cuts, keys, side="right")
        last = np.searchsorted(above.cuts, keys | ((np.uint64(1) << bits) - np.uint64(1)), side="right")
        found = {"node": nodes, "first": first, "last": last, "a": np.zeros(len(nodes), np.int64), "b": np.zeros(len(nodes), np.int64), "left": np.ones(len(nodes))}
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(first)]):
            mine = slice(a, a + int(np.searchsorted(last[a:b], first[a], side="right")))  # all but, at most, a last one that goes on
            found["a"][mine], found["b"][mine], found["left"][mine] = self._range(level + 1, int(first[a]), nodes[mine])
        for k in np.flatnonzero(first != last):
            found["left"][k] = above.shared.get(int(nodes[k]), 1.0)
        return found

    def _range(self, level: int, shard: int, nodes: np.ndarray):
        """Range of the nodes' successors in a shard, and the weight left for the shorter context."""
        arrays = _load(self.model.folder, f"{level + 1}-{shard}")
        a, b, left = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), np.ones(len(nodes))
        local = nodes - int(arrays["first_parent"][0])
        inside = np.flatnonzero((local >= 0) & (local < len(arrays["left"])))
        if len(inside):
            local = local[inside]
            ends = ef_access(_part(arrays, "pointer"), np.concatenate([local, local + 1]))
            a[inside], b[inside] = ends[: len(local)], ends[len(local) :]
            left[inside] = np.power(10.0, arrays["left"][local] / -SCALE)
        return a, b, left

    def successors(self, level: int, parents: dict[str, np.ndarray], at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node (-1: none) of `level` and probability (0: none) of each word below parents[at]; rising in (at, word)."""
        m = self.model
        node, prob = np.full(len(word), NO), np.zeros(len(word))
        first, last = parents["first"][at], parents["last"][at]
        shard = first.copy()
        split = np.flatnonzero((first != last) & (word >= 0))
        if len(split):
            keys = (parents["node"][at[split]].astype(np.uint64) << np.uint64(m.word_bits)) | word[split].astype(np.uint64)
            shard[split] = np.searchsorted(m.levels[level].cuts, keys, side="right")
        a, b = parents["a"][at], parents["b"][at]
        todo = np.flatnonzero((word >= 0) & ((b > a) | (first != last)))
        starts = np.flatnonzero(np.diff(shard[todo], prepend=-1))
        for x, y in zip(starts, [*starts[1:], len(todo)]):
            mine = todo[x:y]
            s = int(shard[mine[0]])
            arrays = _load(m.folder, f"{level + 1}-{s}")
            lo, hi = a[mine], b[mine]
            apart = np.flatnonzero(first[mine] != last[mine])
            if len(apart):
                nodes, back = np.unique(parents["node"][at[mine[apart]]], return_inverse=True)
                ra, rb, _ = self._range(level, s, nodes)
                lo[apart], hi[apart] = ra[back], rb[back]
            base = (parents["node"][at[mine]] - int(arrays["first_parent"][0])) * m.v
            place = ef_find(_part(arrays, "word"), lo, hi, np.maximum(base, 0) + word[mine])
            hit = np.flatnonzero(place >= 0)
            node[mine[hit]] = place[hit] + m.levels[level].offsets[s]
            prob[mine[hit]] = np.power(10.0, arrays["prob"][place[hit]] / -SCALE)
        return node, prob

    def chains(self, ids: np.ndarray, start: np.ndarray, levels: int):
        """For words in order (start: first of a text), yields for each level above words (node, probability, weight left)."""
        nodes, bits = ids, self.model.word_bits
        for level in range(1, levels):
            before = np.empty_like(nodes)
            before[0], before[1:] = NO, nodes[:-1]
            before[start] = NO
            known = np.flatnonzero(before >= 0)
            # different pairs in order: each is sought once, and neighbours lie near each other in the files
            pairs, back = np.unique((before[known] << bits) | (ids[known] + 1), return_inverse=True)
            parent, word = pairs >> bits, (pairs & ((1 << bits) - 1)) - 1
            new = np.diff(parent, prepend=-1) != 0
            at = np.cumsum(new) - 1
            parents = self.parents(level - 1, parent[new])
            node, prob, left = np.full(len(ids), NO), np.zeros(len(ids)), np.ones(len(ids))
            found, p = self.successors(level, parents, at, word)
            node[known], prob[known], left[known] = found[back], p[back], parents["left"][at][back]
            nodes = node
            yield before, node, prob, left


_READERS: dict[str, Reader] = {}


def reader(model: Model) -> Reader:
    """One reader, and so one cache, for all tasks of a worker; a level more makes another."""
    key = f"{model.folder}:{len(model.levels)}"
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(model)
    return _READERS[key]


# ---- training ------------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of binary texts, A-Z folded, and how many each text has (without its end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return words.filter(real).view(pa.binary()), np.diff(before[ends])


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts, by difference and byte plane, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    planes = steps + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(keys).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], 12 * n, codec="zstd"), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view("<u4").ravel()


def _merged(lists: list[tuple[np.ndarray, np.ndarray]], least: int = 1, at_once: int = MERGE_KEYS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys of sorted lists and their summed counts of `least` or more. Ranges of keys with about at_once entries each are sorted, never all; a list is dropped once it is read."""
    total = sum(len(k) for k, _ in lists)
    parts = -(-total // at_once)
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    some = np.sort(np.concatenate([k[:: max(1, at_once // 64)] for k, _ in lists]))
    cuts = np.unique(some[len(some) * np.arange(1, parts) // parts])
    ends = [[0, *np.searchsorted(k, cuts).tolist(), len(k)] for k, _ in lists]
    out = []
    for r in range(len(cuts) + 1):
        keys = np.concatenate([k[e[r] : e[r + 1]] for (k, _), e in zip(lists, ends)])
        counts = np.concatenate([c[e[r] : e[r + 1]] for (_, c), e in zip(lists, ends)])
        if not len(keys):
            continue
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        keys, counts = keys[heads], np.add.reduceat(counts, heads, dtype=np.int64)
        keep = counts >= least
        out.append((keys[keep], counts[keep]))
    lists.clear()
    return np.concatenate([k for k, _ in out]), np.concatenate([c for _, c in out])


def _points(counts: np.ndarray) -> pa.Array:
    """(node, mass before it, its own) at equal steps of a shard's mass, one after the other."""
    after = np.cumsum(counts, dtype=np.int64)
    at = np.unique(np.searchsorted(after, after[-1] * np.arange(POINTS) // POINTS, side="right"))
    return pa.array([np.stack([at, after[at] - counts[at], counts[at].astype(np.int64)], 1).reshape(-1).tolist()], pa.list_(pa.int64()))


def _placed(found: dict, shards: int) -> tuple[list[int], int, list[tuple[int, int, int]]]:
    """Nodes before each shard, the whole mass, and the shards' points among all."""
    offsets, mass, points = [0], 0, []
    for s in range(shards):
        if s in found:
            p = found[s]["points"]
            points += [(offsets[-1] + p[k], mass + p[k + 1], p[k + 2]) for k in range(0, len(p), 3)]
            mass += found[s]["mass"]
        offsets.append(offsets[-1] + (found[s]["nodes"] if s in found else 0))
    return offsets, mass, points


def _train_words(docs: DataFrame, folder: str, shards: int | None) -> Model:
    """docs (text binary) -> the level of words."""

    def count(batches):
        held, parts, size, ends = [], [], 0, 0
        for batch in batches:
            words, n = tokens(batch.column(0))
            held.append(word_hashes(words))
            size, ends = size + len(words), ends + len(n)
            if size > BLOCK_TOKENS:
                parts.append(np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
                if sum(len(k) for k, _ in parts) > 2 * MERGE_KEYS:
                    parts = [_merged(parts)]
                    if len(parts[0][0]) > MERGE_KEYS:
                        yield emit(*parts.pop())
        if size:
            parts.append(np.unique(np.concatenate(held), return_counts=True))
        if parts:
            yield emit(*_merged(parts))
        if ends:
            yield emit(np.array([word_hash(END)], np.uint64), np.array([ends]))

    def emit(hashes, counts):
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "n"])

    words = docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    parts = shards or MIN_SHARDS

    def write(table: pa.Table) -> pa.Table:
        hashes, n = table["h"].to_numpy().view(np.uint64), table["n"].to_numpy()
        order = np.argsort(hashes)
        hashes, n, shard = hashes[order], n[order], table["shard"][0].as_py()
        _save(folder, f"1-{shard}", {"hash": hashes, "count": n.astype(np.uint32 if n.max() < 1 << 32 else np.uint64)})
        return pa.table({"shard": pa.array([shard], pa.int32()), "nodes": [len(n)], "mass": [int(n.sum())], "n1": [int((n == 1).sum())], "n2": [int((n == 2).sum())], "points": _points(n)})

    sharded = words.withColumn("shard", F.expr(f"cast((shiftrightunsigned(h, 48) * {parts}) div 65536 as int)"))
    found = {r["shard"]: r for r in sharded.groupBy("shard").applyInArrow(write, "shard int, nodes long, mass long, n1 long, n2 long, points array<long>").collect()}
    for s in range(parts):
        if s not in found:
            _save(folder, f"1-{s}", {"hash": np.empty(0, np.uint64), "count": np.empty(0, np.uint32)})
    n1, n2 = sum(r["n1"] for r in found.values()), sum(r["n2"] for r in found.values())
    offsets, mass, points = _placed(found, parts)
    return Model(folder, parts, mass, offsets[-1], n1 / (n1 + 2 * n2) if n1 else 0.5, [Level(offsets, np.empty(0, np.uint64), {}, points)])


def _train_level(encoded: DataFrame, model: Model, discount: float, min_count: int, top: bool = False) -> Level:
    """The level above the model's, one word more, of encoded training texts."""
    level, bits, folder, cuts = len(model.levels), model.word_bits, model.folder, model.next_cuts()
    if model.levels[-1].offsets[-1].bit_length() + bits > 63:
        raise ValueError("keys of this level pass 63 bits: raise min_count")

    def count(batches):
        use = reader(model)
        held, size = [], 0
        for _, ids, start in _blocks(batches):
            parent = ids
            for _, parent, _, _ in use.chains(ids, start, level):
                pass
            before = np.empty_like(parent)
            before[0], before[1:] = NO, parent[:-1]
            before[start] = NO
            known = (before >= 0) & (ids >= 0)
            held.append((before[known].astype(np.uint64) << np.uint64(bits)) | ids[known].astype(np.uint64))
            size += len(held[-1])
            if size > FLUSH_TOKENS:
                yield from emit(held)
                held, size = [], 0
        if size:
            yield from emit(held)

    def emit(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        ends = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
        for shard, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([_pack(keys[a:b], counts[a:b])], pa.binary())], names=["shard", "data"])

    def write(table: pa.Table) -> pa.Table:
        use, shard = reader(model), table["shard"][0].as_py()
        keys, counts = _merged([_unpack(x.as_py()) for x in table["data"]], min_count)
        return _write_shard(use, level, shard, keys, counts, bits, discount, top=top)

    rows = encoded.select("doc_id", "ids").mapInArrow(count, "shard int, data binary").groupBy("shard").applyInArrow(write, "shard int, nodes long, mass long, points array<long>, parents array<long>, sums array<double>, counts array<long>").collect()
    found = {r["shard"]: r for r in rows if r["nodes"]}
    for s in range(model.shards):
        if s not in found:
            _write_shard(None, level, s, np.empty(0, np.uint64), np.empty(0, np.int64), bits, discount, folder, top, model.v)
    held: dict[int, float] = {}
    for r in found.values():
        for p, x, n in zip(r["parents"], r["sums"], r["counts"]):
            held[p] = held.get(p, 1.0) - x / n
    offsets, _, points = _placed(found, model.shards)
    return Level(offsets, cuts, held, points)


def _write_shard(use, level: int, shard: int, keys: np.ndarray, counts: np.ndarray, bits: int, discount: float, folder: str | None = None, top: bool = False, v: int = 0) -> pa.Table:
    parent, word = (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    parents, sums, own, first = [], [], [], 0
    prob, left, pointers = np.empty(0, np.uint16), np.empty(0, np.uint16), np.zeros(1, np.int64)
    folder, v = folder or use.model.folder, v or use.model.v
    if len(keys):
        first, last = int(parent[0]), int(parent[-1])
        head = np.diff(parent, prepend=first - 1) != 0  # parents rise
        unique, back = parent[head], np.cumsum(head, dtype=np.int32 if len(keys) < 1 << 31 else np.int64) - 1
        n = use.counts(level - 1, unique)
        quantise = lambda p: np.minimum(np.rint(-np.log10(p) * SCALE), 65535).astype(np.uint16)
        prob = np.concatenate([quantise((counts[k : k + MERGE_KEYS] - discount) / n[back[k : k + MERGE_KEYS]]) for k in range(0, len(keys), MERGE_KEYS)])
        held = np.bincount(back, counts - discount)
        del back, head
        left = np.zeros(last - first + 1, np.uint16)
        left[unique - first] = quantise((n - held) / n)
        pointers = np.searchsorted(parent, np.arange(first, last + 2))
        ends = [0, -1] if first != last else [0]
        parents, sums, own = ([x[k].item() for k in ends] for x in (unique, held, n))
    arrays = {"first_parent": np.array([first]), "left": left, "prob": prob}
    arrays |= {f"pointer_{k}": x for k, x in ef_encode(pointers).items()}
    arrays |= {f"word_{k}": x for k, x in ef_encode((parent - first) * v + word, zeros=True).items()}
    _save(folder, f"{level + 1}-{shard}", arrays)
    if not top:  # what only training reads
        large = np.flatnonzero(counts >= 255)
        _save(folder, f"{level + 1}-{shard}-n", {"count": np.minimum(counts, 255).astype(np.uint8), "large_at": large, "large": counts[large]})
    points = _points(counts) if len(keys) else pa.array([[]], pa.list_(pa.int64()))
    return pa.table({"shard": pa.array([shard], pa.int32()), "nodes": [len(keys)], "mass": [int(counts.sum())], "points": points, "parents": pa.array([parents], pa.list_(pa.int64())), "sums": pa.array([sums], pa.list_(pa.float64())), "counts": pa.array([own], pa.list_(pa.int64()))})


def _blocks(batches):
    """Of batches (doc_id, ids binary): doc_ids, the ids of many texts in order, where each text starts."""
    held, size = [], 0

    def joined():
        data = [x for batch in held for x in batch.column(1).to_pylist()]
        n = np.array(list(map(len, data)), np.int64) // 4
        return pa.concat_arrays([batch.column(0) for batch in held]), np.frombuffer(b"".join(data), "<i4").astype(np.int64), np.cumsum(n) - n

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(1).nbytes // 4
        if size > BLOCK_TOKENS:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text, ...) with ids, little-endian int32 bytes (-1: unknown; the end comes last), for text."""
    if model.v >= 1 << 31:
        raise ValueError("ids pass 31 bits")
    session(docs.sparkSession)
    others = [c for c in docs.columns if c != "text"]

    def run(batches):
        use = reader(model)
        end = int(use.words(np.array([word_hash(END)], np.uint64))[0])
        held: list = []

        def joined():
            known = use.words(np.concatenate([hashes for _, hashes, _ in held])).astype("<i4")
            n = np.concatenate([n for _, _, n in held])
            ends = np.cumsum(np.concatenate(([0], n + 1)))
            ids = np.full(ends[-1], end, "<i4")
            here = np.ones(ends[-1], bool)
            here[ends[1:] - 1] = False
            ids[here] = known
            ids, ends = ids.tobytes(), (4 * ends).tolist()
            beside = [pa.concat_arrays([batch.column(k) for batch, _, _ in held]) for k in range(len(others))]
            return pa.RecordBatch.from_arrays([*beside, pa.array([ids[a:b] for a, b in zip(ends, ends[1:])], pa.binary())], names=[*others, "ids"])

        size = 0
        for batch in batches:
            words, n = tokens(batch.column(len(others)))
            held.append((batch.select(others), word_hashes(words), n))
            size += len(words)
            if size > BLOCK_TOKENS // 2:
                yield joined()
                held, size = [], 0
        if held:
            yield joined()

    rows = docs.select(*others, text_column(docs).cast("binary").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text") + ", ids binary")


def _words(texts: DataFrame, shards: int | None) -> Model:
    spark = session(texts.sparkSession)
    texts = texts.select(text_column(texts).cast("binary").alias("text"))
    if shards is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(MIN_SHARDS, min(1 << 16, -(-size // (6 * SHARD_TOKENS))))
    model = _train_words(texts, new_folder(spark, "lm"), shards)
    _hand_out(spark, model)
    return model


def _levels(encoded: DataFrame, model: Model, order: int, discount: float, min_count: int) -> Model:
    for _ in range(1, order):
        if not model.levels[-1].offsets[-1]:
            break
        top = len(model.levels) + 1 == order
        model.levels.append(_train_level(encoded, model, discount, min_count, top))
        _hand_out(encoded.sparkSession, model, () if top else ("-n",))
    fs, path = pafs.FileSystem.from_uri(_uri(model.folder))
    for level in range(2, len(model.levels) + 1):
        for s in range(model.shards):
            for name in (f"{level}-{s}-n", f"{model.folder.rsplit('/', 1)[1]}-{level}-{s}-n"):
                if fs.get_file_info(f"{path}/{name}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{path}/{name}")
    return model


def train(docs: DataFrame, order: int = ORDER, discount: float = DISCOUNT, min_count: int = MIN_COUNT, shards: int | None = None) -> Model:
    """A model of all of docs, kept in the shared folder."""
    model = _words(docs, shards)
    return _levels(_stored(encode(docs.select("doc_id", "text"), model), model), model, order, discount, min_count)


def train_and_score(docs: DataFrame, learn: str, order: int = ORDER, discount: float = DISCOUNT, min_count: int = MIN_COUNT, shards: int | None = None) -> tuple[Model, DataFrame]:
    """The model of the rows of docs whose boolean `learn` is true, and all rows' scores (with learn); texts are read twice."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), learn, "text")
    model = _words(docs.where(learn), shards)
    encoded = _stored(encode(docs, model), model)
    model = _levels(encoded.where(learn), model, order, discount, min_count)
    return model, score_encoded(encoded, model, learn)


def _stored(encoded: DataFrame, model: Model) -> DataFrame:
    path = f"{model.folder}-ids"
    encoded.write.option("compression", "zstd").parquet(path)
    return encoded.sparkSession.read.parquet(path)


def _hand_out(spark, model: Model, also: tuple[str, ...] = ()) -> None:
    """Where the shared folder is no path that executors can map, Spark fetches the files for them."""
    if _local(model.folder) is None:
        fs, path = pafs.FileSystem.from_uri(model.folder)
        level, name = len(model.levels), model.folder.rsplit("/", 1)[1]
        for s in range(model.shards):
            for end in ("", *also):
                fs.move(f"{path}/{level}-{s}{end}", f"{path}/{name}-{level}-{s}{end}")
                spark.sparkContext.addFile(f"{model.folder}/{name}-{level}-{s}{end}")


# ---- scoring -------------------------------------------------------------------------------------


def log10_probabilities(use: Reader, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of the base, of the model) for words in order; start: first of each text."""
    m = use.model
    known = ids >= 0
    count = np.zeros(len(ids), np.int64)
    unique, back = np.unique(ids[known], return_inverse=True)
    count[known] = use.counts(0, unique)[back]
    base = np.log10((count + 0.1) / (m.n + 0.1 * (m.v + 1)))
    if not m.n:
        return base, np.zeros(len(ids))
    p = np.where(known, (count - m.unknown) / m.n, m.unknown * m.v / m.n)
    for _, _, prob, left in use.chains(ids, start, len(m.levels)):
        p = prob + left * p
    return base, np.log10(np.minimum(p, 1.0))


def score_encoded(encoded: DataFrame, model: Model, *others: str) -> DataFrame:
    """doc_id, others, n_tokens, n_known, base_score, score of each row of encode()."""
    session(encoded.sparkSession)
    schema = {f.name: f.dataType.simpleString() for f in encoded.schema}

    def run(batches):
        use = reader(model)
        kept: list = []

        def seen():
            for batch in batches:
                if batch.num_rows:
                    kept.append(batch.select(list(others)))
                    yield batch.select(["doc_id", "ids"])

        for doc_ids, ids, start in _blocks(seen()):
            base, own = log10_probabilities(use, ids, start)
            sums = [pa.array(np.add.reduceat(x, start)) for x in ((ids >= 0).astype(np.int64), base, own)]
            beside = [pa.concat_arrays([b.column(c) for b in kept]) for c in others]
            kept.clear()
            n = np.diff(start, append=len(ids))
            yield pa.RecordBatch.from_arrays([doc_ids, *beside, pa.array(n), *sums], names=["doc_id", *others, "n_tokens", "n_known", "base_score", "score"])

    beside = "".join(f", `{c}` {schema[c]}" for c in others)
    return encoded.select("doc_id", *others, "ids").mapInArrow(run, f"doc_id long{beside}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of each row of texts."""
    return score_encoded(encode(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), model), model)
