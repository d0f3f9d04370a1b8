"""Removal of repeated passages by hash-compared suffix sorting.

A byte goes if a string of `length` bytes covers it that also starts earlier: in a document of smaller doc_id
(a null one comes first; of one doc_id, that whose text has the smaller digest), or earlier in the same one.

Routing. Among the hashes of the short grams in a string of `length` bytes the least one (of equals the leftmost) is
its anchor, so equal strings have equal anchors at equal offsets. Successive strings with one anchor form a segment;
equal segments are combined, within a task and then by anchor, into the first of them and its copies. A copy repeats the
first from end to end. What only one segment of the corpus has is dropped there: no other place can repeat it.

Sorting. Segments that share an anchor but differ are fetched with their bytes. Their suffixes are sorted by a mergesort
that compares two by the length of their common extension, found by binary search over prefix polynomial hashes. The
sorted order is then verified byte by byte; a class of suffixes that fails (a collision) is sorted by its bytes. Of
suffixes that agree in `length` bytes the earliest stays, the others' bytes go.

Bounds. A task holds BATCH bytes of text, or BUCKET segments with as many again of one anchor. An anchor of more than HOT
different segments (a common line in ever other surroundings) is crowded: its segments are cut in halves by the anchor's
offset. The strings of a half share more bytes than the anchor, and by these they are combined and counted again, until no
anchor is crowded; so what a passage has in common is told apart from its surroundings without a row for each string.
One document, its spans and its bytes must fit in a task. Texts travel compressed.

Nulls are empty texts. Texts shorter than `length` keep all. Rows that repeat both doc_id and text are one document, listed as
often as it came. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import cut, session, text_column

LENGTH, GRAM = 100, 24
#: Bytes whose hashes a task has at once; bytes of text within which it combines segments; segments of a bucket, and different ones of an anchor beyond which it is crowded.
PIECE, BATCH, BUCKET, HOT = 1 << 20, 16 << 20, 5_000, 5_000
UNNAMED = -(1 << 63)
CODES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
POSITION = 21  # bits of a position within a piece and its margin
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the 0, 1, ... n - 1 and its inverses, modulo 2^64."""
    if len(_tables.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["up"][:n], _tables["down"][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(CODES[data] * up)))
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` successive values: block-wise running minima from both sides."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(start, strings, offset of the anchor, anchor) of the segments of a text, in order of start."""
    n, found = len(data) - length + 1, []
    for a in range(0, n, PIECE):
        m = min(PIECE, n - a)
        hashes = gram_hashes(np.frombuffer(data, np.uint8, m + length - 1, a), gram)
        low = np.uint64(POSITION)
        least = sliding_least(hashes >> low << low | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        at = (least & np.uint64((1 << POSITION) - 1)).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        at = at[starts]
        found.append((starts + a, np.diff(starts, append=m), at - starts, hashes[at].view(np.int64)))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64),) * 4


def pack(start, offset, strings):
    """A segment's place in one number that orders by start."""
    return start << 20 | offset << 10 | strings


def unpack(place):
    return place >> 20, place >> 10 & 1023, place & 1023


def combined(anchor, digest, doc, key, place, **more) -> pa.RecordBatch:
    """Equal segments (anchor, digest) as the first of them and the others; more: further columns, which the first has."""
    order = np.lexsort((place, key, doc, digest, anchor))
    anchor, digest, doc, key, place = (x[order] for x in (anchor, digest, doc, key, place))
    same = lambda *xs: np.concatenate(([False], np.logical_and.reduce([x[1:] == x[:-1] for x in xs])))[: len(anchor)]
    again = same(anchor, digest, doc, key, place)  # the same document, listed twice
    order, anchor, digest, doc, key, place = (x[~again] for x in (order, anchor, digest, doc, key, place))
    copy = same(anchor, digest)
    first = np.flatnonzero(~copy)
    lengths = np.diff(first, append=len(anchor)) - 1
    copies = pa.StructArray.from_arrays([pa.array(x[copy]) for x in (doc, key, place)], names=["doc", "key", "place"])
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    own = [pa.array(x).take(pa.array(order[first])) for x in more.values()]
    return pa.RecordBatch.from_arrays([*(pa.array(x[first]) for x in (anchor, digest, doc, key, place)), pa.ListArray.from_arrays(offsets, copies), *own], names=["anchor", "digest", "doc", "key", "place", "copies", *more])


SEGMENTS = "anchor long, digest long, doc long, key long, place long, copies array<struct<doc: long, key: long, place: long>>"


def _segmented(length: int, gram: int):
    def run(batches):
        loose, held, size = zstandard.ZstdDecompressor().decompress, [], 0
        for batch in batches:
            for doc, key, packed in zip(*(batch.column(k).to_pylist() for k in range(3))):
                text = loose(packed)
                start, strings, offset, anchor = segments(text, length, gram)
                if len(start):
                    view = memoryview(text)
                    digest = np.array([xxhash.xxh64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + strings + length - 1).tolist())], np.uint64).view(np.int64)
                    held.append((anchor, digest, np.full(len(start), doc), np.full(len(start), key), pack(start, offset, strings)))
                    size += len(text)
                if size >= BATCH:
                    yield combined(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield combined(*map(np.concatenate, zip(*held)))

    return run


def _halved(length: int, gram: int):
    """Segments of crowded anchors -> their strings in two halves by the anchor's offset (low to high): what the strings of a half have in common is longer than the anchor, and takes its place."""
    most = length - gram + 1

    def run(batches):
        for batch in batches:
            out = []
            for doc, key, place, low, high, data in zip(*(batch.column(k).to_pylist() for k in range(6))):
                start, offset, strings = unpack(place)
                mid = (low + high) // 2
                upper = min(max(offset - mid + 1, 0), strings)
                for a, b, i, j in ((mid, high, 0, upper), (low, mid, upper, strings)):
                    if i < j:
                        part, at = data[i : j + length - 1], offset - i
                        anchor = xxhash.xxh64_intdigest(part[at - a : at + gram + most - b], a)
                        out.append((anchor, xxhash.xxh64_intdigest(part), doc, key, pack(start + i, at, j - i), a, b, part))
            if out:
                anchor, digest, doc, key, place, low, high, data = zip(*out)
                signed = lambda x: np.array(x, np.uint64).view(np.int64)
                yield combined(signed(anchor), signed(digest), np.array(doc), np.array(key), np.array(place), low=np.array(low, np.int32), high=np.array(high, np.int32), data=pa.array(data, pa.binary()))

    return run


class Texts:
    """Texts in one buffer, with the sums from which the hash of any part of one is computed."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        local = np.arange(len(self.data)) - np.repeat(self.starts, lengths)
        up, self.down = powers(int(lengths.max(initial=0)) + 1)
        self.local = local.astype(np.int32)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(CODES[self.data] * up[local])))

    def common(self, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
        """Bytes that the suffixes at x and y share, up to `most`: binary search over hashes of their prefixes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), most)
        by_x, by_y, at_x, at_y = self.down[self.local[x]], self.down[self.local[y]], self.sums[x], self.sums[y]
        for _ in range(most.bit_length()):
            mid = (low + high + 1) >> 1
            equal = (self.sums[x + mid] - at_x) * by_x == (self.sums[y + mid] - at_y) * by_y
            low, high = np.where(equal, mid, low), np.where(equal, high, np.maximum(mid - 1, low))
        return low

    def compare(self, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
        """-1, 0 or 1 as the suffix at x is before, equal to or after that at y in their first `most` bytes."""
        n = self.common(x, y, most)
        at = np.minimum(n, most - 1)
        return np.where(n == most, 0, np.sign(self.data[x + at].astype(np.int16) - self.data[y + at]))


def merge_sorted(texts: Texts, x: np.ndarray, kind: np.ndarray, most: int) -> np.ndarray:
    """The order of the suffixes at x, those of a kind (which lie together) by their first `most` bytes; stable. Bottom-up: runs double, and a suffix's place in a merge is its own rank plus its rank in the other run."""
    n = len(x)
    order, new = np.arange(n), np.concatenate(([True], kind[1:] != kind[:-1]))[:n]
    heads = np.flatnonzero(new)
    sizes = np.diff(heads, append=n)
    head, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    at, run = np.arange(n) - head, 1
    while run < sizes.max(initial=0):
        block = at // (2 * run) * (2 * run)
        left = at - block < run
        low = head + np.minimum(np.where(left, block + run, block), size)
        high, since = head + np.minimum(np.where(left, block + 2 * run, block + run), size), low.copy()
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_]) >> 1
            sign = texts.compare(x[order[mid]], x[order[open_]], most)
            after = np.where(left[open_], sign < 0, sign <= 0)
            low[open_], high[open_] = np.where(after, mid + 1, low[open_]), np.where(after, high[open_], mid)
        placed = np.empty(n, np.int64)
        placed[head + block + (at - block - np.where(left, 0, run)) + (low - since)] = order
        order, run = placed, 2 * run
    return order


def verified(texts: Texts, x: np.ndarray, kind: np.ndarray, most: int, strip: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """x in the order of suffixes, and whether each agrees with the one before it in `most` bytes, by the bytes themselves."""
    x = x[merge_sorted(texts, x, kind, most)]
    rows = np.lib.stride_tricks.sliding_window_view(texts.data, most)
    equal, wrong = np.zeros(len(x), bool), []
    for a in range(1, len(x), strip):
        here = np.arange(a, min(a + strip, len(x)))
        here = here[kind[here] == kind[here - 1]]
        differs = rows[x[here - 1]] != rows[x[here]]
        at = differs.argmax(1)
        equal[here] = same = ~differs[np.arange(len(here)), at]
        wrong.append(here[~same & (texts.data[x[here - 1] + at] > texts.data[x[here] + at])])
    for k in np.unique(kind[np.concatenate(wrong)]) if wrong else ():
        (mine,) = np.nonzero(kind == k)
        x[mine] = sorted(x[mine].tolist(), key=lambda p: rows[p].tobytes())
        equal[mine[1:]] = (rows[x[mine[1:]]] == rows[x[mine[:-1]]]).all(1)
    return x, equal


def later(texts: list[bytes], anchors, offsets, strings, names, starts, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, string, whether an equal string has an earlier place) of every string that starts in the texts. names: documents as ranks; starts: where each text starts in its document."""
    of = np.repeat(np.arange(len(texts)), strings)
    which = np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    place = names[of] << 40 | starts[of] + which
    kind = np.unique(anchors, return_inverse=True)[1][of] * (1 << 20) + (offsets[of] - which + (1 << 19))
    order = np.lexsort((place, kind))
    sorted_kind = kind[order]
    alone = np.concatenate(([True], sorted_kind[1:] != sorted_kind[:-1])) & np.concatenate((sorted_kind[1:] != sorted_kind[:-1], [True])) if len(order) else np.empty(0, bool)
    order, is_later = order[~alone], np.zeros(len(of), bool)
    if len(order):
        buffer = Texts(texts)
        x = buffer.starts[of[order]] + which[order]
        back = np.full(len(buffer.data), -1)
        back[x] = order
        x, equal = verified(buffer, x, kind[order], most)
        mine = back[x]
        heads = np.flatnonzero(~equal)
        first = np.minimum.reduceat(place[mine], heads)
        is_later[mine] = place[mine] > np.repeat(first, np.diff(heads, append=len(mine)))
    return of, which, is_later


def _sorted(length: int):
    """Of a bucket's segments: the spans to remove."""

    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        num = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        doc, key, anchor = num("doc"), num("key"), num("anchor")
        start, offset, strings = unpack(num("place"))
        order = np.lexsort((key, doc))
        new = np.concatenate(([False], (doc[order][1:] != doc[order][:-1]) | (key[order][1:] != key[order][:-1])))[:n]
        names = np.empty(n, np.int64)
        names[order] = np.cumsum(new)
        of, which, gone = later(table.column("data").to_pylist(), anchor, offset, strings, names, start, length)
        at = np.flatnonzero(gone)
        edge = np.concatenate(([True], (np.diff(at) != 1) | (of[at][1:] != of[at][:-1])))[: len(at)]
        first, last = at[edge], at[np.concatenate((edge[1:], [True]))[: len(at)]]
        columns = [doc[of[first]], key[of[first]], start[of[first]] + which[first], start[of[last]] + which[last] + length]
        return pa.Table.from_arrays(list(map(pa.array, columns)), names=["doc", "key", "start", "stop"])

    return run


def _fetched(length: int):
    """(doc, key, packed, wanted) -> a row for each wanted segment with its bytes. Rows of one document come together; the second is skipped."""
    def run(batches):
        loose, before = zstandard.ZstdDecompressor().decompress, None
        for batch in batches:
            rows = []
            for doc, key, packed, wanted in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if (doc, key) != before:
                    before, text = (doc, key), loose(packed)
                    for w in wanted:
                        start, _, strings = unpack(w["place"])
                        rows.append((doc, key, w["place"], w["anchor"], text[start : start + strings + length - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, [pa.int64()] * 4 + [pa.binary()])], names=["doc", "key", "place", "anchor", "data"])

    return run


def _shared(rows: DataFrame) -> DataFrame:
    """Segments whose anchor has more than one place: nth of the equal ones, and the anchor's places and different segments (texts). An anchor's rows pass through one task, which streams them and spills."""
    equal = Window.partitionBy("anchor", "digest").orderBy("doc", "key", "place")
    shared = Window.partitionBy("anchor")
    rows = rows.repartition("anchor").withColumn("nth", F.rank().over(equal))
    rows = rows.withColumn("places", F.sum(1 + F.size("copies")).over(shared)).withColumn("texts", F.sum((F.col("nth") == 1).cast("long")).over(shared))
    return cut(rows.where("places > 1"))


def _whole(rows: DataFrame, length: int) -> DataFrame:
    """Spans of the segments that repeat an earlier one from end to end."""
    places = rows.where("nth > 1").select("doc", "key", "place").union(rows.where("size(copies) > 0").select(F.inline("copies")))
    return places.select("doc", "key", F.expr("place >> 20").alias("start"), F.expr(f"(place >> 20) + (place & 1023) + {length - 1}").alias("stop"))


def spans(packed: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc, key, spans) of the documents (doc, key, packed) that lose bytes: spans (start, stop) in bytes, in any order, which may overlap."""
    if not GRAM <= length < 1024:
        raise ValueError(f"length from {GRAM} to 1023")

    def fetch(first: DataFrame) -> DataFrame:
        wanted = first.select("doc", "key", F.struct("place", "anchor").alias("w")).groupBy("doc", "key").agg(F.collect_list("w").alias("wanted"))
        rows = packed.join(wanted, ["doc", "key"]).select("doc", "key", "packed", "wanted")
        return rows.mapInArrow(_fetched(length), "doc long, key long, place long, anchor long, data binary")

    busy = _shared(packed.mapInArrow(_segmented(length, GRAM), SEGMENTS))
    few, many = F.col("texts").between(2, hot) & (F.col("nth") == 1), (F.col("texts") > hot) & (F.col("nth") == 1)
    n, whole, to_sort = busy.where(few).count(), _whole(busy, length), fetch(busy.where(few))
    crowded = busy.where(many).select("doc", "key", "place", "anchor")
    if not crowded.isEmpty():
        most = length - GRAM + 1
        rows = fetch(crowded).select("*", F.lit(0).alias("low"), F.lit(most).alias("high"))
        for level in range(most.bit_length() + 1):
            halves = rows.select("doc", "key", "place", "low", "high", "data").mapInArrow(_halved(length, GRAM), f"{SEGMENTS}, low int, high int, data binary")
            halves = _shared(halves)
            # halves of one string are equal under one anchor, so that none is crowded in the end
            last = level == most.bit_length()
            mine = halves.where("nth = 1 and texts > 1") if last else halves.where(few)
            n, whole = n + mine.count(), whole.union(_whole(halves, length))
            to_sort = to_sort.unionByName(mine.select(*to_sort.columns))
            rows = halves.where(many)
            if last or rows.isEmpty():
                break
    buckets = -(-n // BUCKET) or 1
    found = to_sort.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket").applyInArrow(_sorted(length), "doc long, key long, start long, stop long")
    return whole.union(found).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, key, packed): doc_id, what tells apart documents of one doc_id (0 if all are different), and the text compressed, as it is shuffled."""
    text = text_column(docs)
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(UNNAMED)).alias("doc")
    tied = not docs.select(doc).groupBy("doc").count().where("count > 1").isEmpty()

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array(map(squeeze, batch.column(2).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["doc", "key", "packed"])

    rows = docs.select(doc, (F.xxhash64(text) if tied else F.lit(0).cast("long")).alias("key"), text.cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc long, key long, packed binary")


def _kept(batches):
    """(doc, packed, spans) -> the bytes that stay, and the maximal runs of those that go."""
    loose = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        sizes, out, runs = [], [], []
        for packed, spans_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text, merged = loose(packed), []
            for a, b in sorted((s["start"], s["stop"]) for s in spans_ or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *(x for m in merged for x in m), len(text)]
            sizes.append(len(text))
            out.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            runs.append([{"start": a, "stop": b} for a, b in merged])
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary()), pa.array(runs, kinds)], names=["doc", "n_bytes", "kept", "removed"])


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, kept, removed) of each row: the bytes that stay, and the maximal runs (start, stop) of those that go."""
    session(docs.sparkSession)
    packed = _packed(docs)
    rows = packed.join(spans(packed, length, hot), ["doc", "key"], "left").select("doc", "packed", "spans")
    rows = rows.mapInArrow(_kept, "doc long, n_bytes long, kept binary, removed array<struct<start: long, stop: long>>")
    return rows.select(F.when(F.col("doc") != UNNAMED, F.col("doc")).alias("doc_id"), "n_bytes", "kept", "removed")
