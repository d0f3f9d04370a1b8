"""Near copies by the exact Jaccard similarity of word shingles: a prefix-filter join.

A text's set holds the XXH64 hashes of its word shingles (five words; of fewer words, the whole text). Two
sets of n and m shingles have similarity s or more only if they share one among the first n - ceil(s n) + 1
and m - ceil(s m) + 1 in any common order, so these prefixes, met by shingle, miss no pair. The order puts
shingles that a sample of texts shows to be common last, which keeps them out of most prefixes; it does not
change the result. At the first shingle that two sets share, nothing before it is shared, so both must have enough
left from it on: a pair is made only where that holds, and a similar pair is made there at the latest. Then the sum of the
smaller counters of two small sketches, which is never below the number of shared shingles, filters it, and the complete sets
verify it.

The sets that hold a shingle are sorted by size and place and cut into blocks of BLOCK as they stream by, so that no list is
ever whole. Blocks of one shingle meet pairwise, each pair in a row of its own, unless what is left in them is too little
for their sizes; then no pair of theirs could be similar.

Equal sets meet by their digest first; with max_bits, fingerprints that multi-index hashing (`simhash.links`) finds within that
distance link their sets too. The join has three rounds: a block's first set with each of the others, each with the next
and each block's first with the first block's, which links most of a group of near copies without all its pairs; then a block gives no
pairs, only a forest of them over its components so far, likely pairs first, and one or two of each set, so no more than three times
its sets; then all
pairs of one shingle that still lie in different components. The components are therefore those of all pairs of the similarity (and of
the fingerprints' links).

Nulls and blank texts have the empty set and are copies of each other. Rows that repeat a doc_id are rows of
their own; rows of a null doc_id, which nothing can name, all stay. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import beside_hot, cut, gathered, session, spread, stored, text_column
from topicloom.llm.components import components
from topicloom.llm.simhash import SEED, fingerprint, kept
from topicloom.llm.simhash import links as fingerprint_links

#: Shingle length; similarity as a fraction, so that bounds are whole numbers.
WORDS, SIMILARITY = 5, (4, 5)
#: The order's sample: texts, times seen, shingles at most.
SAMPLE_ROWS, SAMPLE_SEEN, COMMON = 32_000, 2, 500_000
#: Pairs whose sketches are compared at once.
STRIP = 1 << 14
#: Complete sets, or pairs of them, that are worth a task of their own.
SETS_AT_ONCE = 2_000
#: Sets of a block, which bounds a row and, squared, the pairs that it may make.
BLOCK = 256
#: Counters of a set's sketch: hashes by their leading bits, 255 for that many and more.
SKETCH_BITS = 7


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted different hashes of a text's shingles."""
    tokens = text.lower().split()
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(joined, SEED)] if tokens else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(tokens) - words + 1))


def digest_of(held: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(held.tobytes())


def similar(a: np.ndarray, b: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> bool:
    p, q = similarity
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return q * shared >= p * (len(a) + len(b) - shared)


def sketch(held: np.ndarray) -> bytes:
    return np.minimum(np.bincount((held >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS), 255).astype(np.uint8).tobytes()


def most_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A bound of the shared shingles, of sketches in rows."""
    low = np.minimum(a, b).astype(np.int64)
    return np.where((low == 255).any(axis=1), np.iinfo(np.int64).max >> 16, low.sum(axis=1))


def _rows(docs: DataFrame) -> DataFrame:
    text = text_column(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("key"))


def common_shingles(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Shingles that several texts of a sample share, the rarest first."""

    def run(batches):
        for batch in batches:
            found = [shingles(t, words) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], names=["h"])

    every = max(1, docs.count() // SAMPLE_ROWS)
    texts = _rows(docs).select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct()
    seen = stored(texts.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_SEEN))
    # the least count that at most COMMON shingles reach: no more of them go to the driver
    least, total = None, 0
    for n, shingles_ in sorted(seen.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().collect(), reverse=True):
        total += shingles_
        if total > COMMON:
            break
        least = n
    if least is None:
        return np.empty(0, np.uint64)
    found = seen.where(F.col("n") >= least).select("h", "n").toArrow()
    h, n = (found[c].to_numpy() for c in ("h", "n"))
    return h[np.lexsort((h, n))].astype(np.int64).view(np.uint64)


def _prefixes(docs: DataFrame, words: int, similarity: tuple[int, int], fingerprinted: bool = False) -> DataFrame:
    """(doc_id, key, digest, size, prefix, sketch, fp) of each row; fp is null unless fingerprinted."""
    common = common_shingles(docs, words)
    order = np.argsort(common)
    sought, ranks, (p, q) = common[order], order.astype(np.int32) + 1, similarity

    def prefix(held: np.ndarray) -> np.ndarray:
        n = len(held)
        if not n:
            return held
        rank = np.zeros(n, np.int32)
        if len(sought):
            at = np.minimum(np.searchsorted(sought, held), len(sought) - 1)
            rank = np.where(sought[at] == held, ranks[at], 0)
        return held[np.argsort(rank, kind="stable")[: n - -(-n * p // q) + 1]]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sets = [shingles(t, words) for t in texts]
            fps = pa.array(np.array(list(map(fingerprint, texts)), np.uint64).view(np.int64)) if fingerprinted else pa.nulls(len(texts), pa.int64())
            digests = pa.array(list(map(digest_of, sets)), pa.binary())
            prefixes = pa.array([prefix(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), digests, pa.array(list(map(len, sets)), pa.int64()), prefixes, pa.array(list(map(sketch, sets)), pa.binary()), fps], names=["doc_id", "key", "digest", "size", "prefix", "sketch", "fp"])

    return _rows(docs).mapInArrow(run, "doc_id long, key long, digest binary, size long, prefix array<long>, sketch binary, fp long")


def _may(a, b, p: int, q: int):
    """Whether members (rep, size, pos) of one shingle, if it is the first that they share, have enough left from it on."""
    shared = F.least(a["size"] - a["pos"], b["size"] - b["pos"])
    return F.lit(p + q) * shared >= F.lit(p) * (a["size"] + b["size"])


def _blocked(batches):
    """(h, rep, size, pos), sorted -> (h, block, members) of the shingles of several sets, in blocks of BLOCK."""

    def rows(h, rep, size, pos, seen):
        # seen: how many members of the first shingle are out already
        run = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        lengths = np.diff(run, append=len(h))
        base = np.zeros(len(run), np.int64)
        base[0] = seen
        several = np.repeat((lengths > 1) | (base > 0), lengths)
        at = np.arange(len(h)) - np.repeat(run - base, lengths)
        h, rep, size, pos, at = (x[several] for x in (h, rep, size, pos, at))
        if not len(h):
            return
        block = at // BLOCK
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (block[1:] != block[:-1]))))
        offsets = pa.array(np.append(first, len(h)).astype(np.int32))
        members = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x) for x in (rep, size, pos)], names=["rep", "size", "pos"]))
        yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(block[first]), members], names=["h", "block", "members"])

    held, seen = [np.empty(0, np.int64)] * 4, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held = [np.concatenate((x, batch.column(k).to_numpy())) for k, x in enumerate(held)]
        last = int(np.searchsorted(held[0], held[0][-1]))
        if last:
            yield from rows(*(x[:last] for x in held), seen)
            held, seen = [x[last:] for x in held], 0
        whole = (len(held[0]) - 1) // BLOCK * BLOCK
        if whole > BLOCK:
            yield from rows(*(x[:whole] for x in held), seen)
            held, seen = [x[whole:] for x in held], seen + whole
    if len(held[0]):
        yield from rows(*held, seen)


def _sketched(pairs: DataFrame, sketches: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Those of (u, v) whose sketches do not rule the similarity out."""
    p, q = similarity

    def check(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (4, 5))
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            ok = pa.array((p + q) * most_shared(a, b) >= p * sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["u", "v"])

    at_u, at_v = (sketches.select(F.col("rep").alias(x), F.col("size").alias(f"{x}_size"), F.col("sketch").alias(f"{x}_sketch")) for x in ("u", "v"))
    met = pairs.join(at_u, "u").join(at_v, "v").select("u", "v", "u_size", "v_size", "u_sketch", "v_sketch")
    return cut(gathered(met.mapInArrow(check, "u long, v long"), pairs.count()))


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, again: bool, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Those of (u, v) whose sets have the similarity; again: whether rows repeat both doc_id and set."""
    size = pairs.count()
    ids = pairs.select(F.col("u").alias("rep")).union(pairs.select("v")).distinct()
    sought = cut(gathered(reps.select("rep", "doc_id", "digest").join(ids, "rep", "left_semi"), 2 * size))

    def sets(batches):
        for batch in batches:
            held = [shingles(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(digest_of, held)), pa.binary()), pa.array([x.tobytes() for x in held], pa.binary())], names=["doc_id", "digest", "held"])

    def check(batches):
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
            ok = pa.array([similar(x, y, similarity) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["u", "v"])

    held = _rows(docs).select("doc_id", "text").join(sought.select("doc_id"), "doc_id", "left_semi").mapInArrow(sets, "doc_id long, digest binary, held binary")
    held = held.join(sought, ["doc_id", "digest"]).select("rep", "held")
    held = held.dropDuplicates(["rep"]) if again else held
    held = cut(gathered(held, sought.count(), SETS_AT_ONCE))
    at_u, at_v = held.select(F.col("rep").alias("u"), F.col("held").alias("a")), held.select(F.col("rep").alias("v"), F.col("held").alias("b"))
    return cut(gathered(pairs.join(at_u, "u").join(at_v, "v").select("u", "v", "a", "b").mapInArrow(check, "u long, v long"), size, SETS_AT_ONCE))


def _candidates(members: list, others: list | None, p: int, q: int) -> tuple[np.ndarray, ...]:
    """Pairs within members (others null) or between both that lie in different components and can reach the similarity, by what is left and, where members have them, by their sketches: (u, v, their roots, the most that the similarity can be)."""
    (rep, size, pos, root), (rep2, size2, pos2, root2) = ([np.array([m[k] for m in side], np.int64) for k in ("rep", "size", "pos", "root")] for side in (members, others or members))
    shared = np.minimum((size - pos)[:, None], (size2 - pos2)[None])
    can = (root[:, None] != root2[None]) & ((p + q) * shared >= p * (size[:, None] + size2[None]))
    i, j = np.nonzero(np.triu(can) if others is None else can)
    shared, sizes = shared[i, j], size[i] + size2[j]
    if len(i) and members[0].get("sketch") is not None:
        held, held2 = (np.frombuffer(b"".join(m["sketch"] for m in side), np.uint8).reshape(len(side), -1) for side in (members, others or members))
        shared = np.minimum(shared, np.concatenate([most_shared(held[i[a : a + STRIP]], held2[j[a : a + STRIP]]) for a in range(0, len(i), STRIP)]))
        ok = (p + q) * shared >= p * sizes
        i, j, shared, sizes = i[ok], j[ok], shared[ok], sizes[ok]
    return np.minimum(rep[i], rep2[j]), np.maximum(rep[i], rep2[j]), root[i], root2[j], shared / np.maximum(sizes - shared, 1)


def _forest(a: np.ndarray, b: np.ndarray, likely: np.ndarray) -> np.ndarray:
    """Places of the edges (a, b) of a spanning forest, the likeliest first: each component takes its best edge until none has one."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends.reshape(2, -1)
    order, taken, label = np.argsort(-likely, kind="stable"), [], np.arange(len(nodes))
    a, b = a[order], b[order]
    live = np.arange(len(order))
    while len(live):
        best = np.full(len(nodes), len(order))
        np.minimum.at(best, label[a[live]], live)
        np.minimum.at(best, label[b[live]], live)
        chosen = np.unique(best[best < len(order)])
        taken.append(order[chosen])
        before = None
        while before is None or (before != label).any():
            before = label.copy()
            low = np.minimum(label[a[chosen]], label[b[chosen]])
            for side in (a, b):
                np.minimum.at(label, before[side[chosen]], low)
            label = label[label]
        live = live[label[a[live]] != label[b[live]]]
    return np.concatenate([np.empty(0, np.int64), *taken])


def _across(p: int, q: int, forest: bool = False):
    """Of rows (members, others): their candidates (u, v), or only a forest of these over the components and one of each set on either side."""

    def run(batches):
        for batch in batches:
            found = []
            for members, others in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v, one, two, likely = _candidates(members, others, p, q)
                if forest and len(u):
                    # no list insists on a pair that others try: of the likely ones each takes some
                    some = np.random.default_rng(sum(m["rep"] * (m["pos"] + 1) for m in members)).random(len(u))
                    likely = likely + (1 - p / q) * some
                    order = np.argsort(-likely, kind="stable")
                    each = [order[np.unique(side[order], return_index=True)[1]] for side in (u, v)]
                    taken = np.unique(np.concatenate([_forest(one, two, likely), *each]))
                    u, v = u[taken], v[taken]
                found.append(np.stack((u, v)))
            pairs = np.unique(np.concatenate(found, 1), axis=1) if found else np.empty((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    return run


def _rooted(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, a row each (h, block, rep, size, pos and what else they have), with their component's root, in blocks (h, block, members, least and last root) again."""
    fields = [c for c in members.columns if c not in ("h", "block", "root")]
    placed = members.drop("root").join(found.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    return placed.groupBy("h", "block").agg(F.collect_list(F.struct(*fields, "root")).alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))


def _exploded(blocks: DataFrame) -> DataFrame:
    return blocks.select("h", "block", F.explode("members").alias("m")).select("h", "block", "m.*")


def _pairings(blocks: DataFrame, long: DataFrame | None, p: int, q: int, between: bool) -> DataFrame:
    """Of blocks, rows (members, others) that hold several components: a block itself and, of long lists, its pairs with the list's others."""
    alone = blocks.where("low < high").select("members", F.lit(None).cast(blocks.schema["members"].dataType).alias("others"))
    if long is None or not between:
        return alone
    large = blocks.join(long, "h", "left_semi").select("h", "block", "low", "high", "members", F.expr("array_max(transform(members, m -> m.size - m.pos))").alias("left"), F.expr("array_min(members.size)").alias("least"))
    other = large.select("h", *[F.col(c).alias(f"{c}_2") for c in large.columns if c != "h"])
    enough = F.lit(p + q) * F.least("left", "left_2") >= F.lit(p) * (F.col("least") + F.col("least_2"))
    mixed = F.least("low", "low_2") < F.greatest("high", "high_2")
    return alone.union(large.join(other, "h").where((F.col("block") < F.col("block_2")) & enough & mixed).select("members", F.col("members_2").alias("others")))


def _by_fingerprint(rows: DataFrame, reps: DataFrame, max_bits: int) -> DataFrame:
    """(u, v): sets whose texts' fingerprints differ by max_bits or fewer bits, by multi-index hashing; of one fingerprint's sets each with its smallest."""
    held = stored(rows.select("digest", "fp").distinct().join(reps.select("digest", "rep"), "digest").select("fp", "rep"))
    homes = stored(held.groupBy("fp").agg(F.min("rep").alias("home")))
    same = beside_hot(held, homes, "fp").select(F.col("home").alias("u"), F.col("rep").alias("v"))
    at_u, at_v = (homes.select(F.col("fp").alias(x), F.col("home").alias(f"{x}_home")) for x in ("u", "v"))
    near = fingerprint_links(homes, max_bits).join(at_u, "u").join(at_v, "v").select(F.col("u_home").alias("u"), F.col("v_home").alias("v"))
    return stored(same.union(near).where("u <> v").distinct())


def near_copies(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, max_bits: int | None = None) -> DataFrame:
    """(doc_id, key, group, component_id) of each row with a doc_id: rows that reach each other over pairs of the similarity or more, or with max_bits over fingerprints that differ by so many bits or fewer, share a group, and component_id is its smallest doc_id."""
    session(docs.sparkSession)
    p, q = similarity
    docs = docs.where("doc_id is not null")
    rows = stored(_prefixes(docs, words, similarity, max_bits is not None))
    reps = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()))
    again = not rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    places = reps.select("rep", "size", F.posexplode("prefix").alias("pos", "h"))
    places = places.select("h", "rep", "size", F.col("pos").cast("long").alias("pos")).repartition("h").sortWithinPartitions("h", "size", "pos", "rep")
    met = stored(places.mapInArrow(_blocked, "h long, block long, members array<struct<rep: long, size: long, pos: long>>"))
    # members, and their successors beside them
    near = met.select(F.element_at("members", 1).alias("a"), F.explode("members").alias("b"))
    near = near.union(met.select(F.inline(F.arrays_zip(F.col("members").alias("a"), F.slice("members", F.lit(2), F.size("members")).alias("b")))).where("b is not null"))
    firsts = met.select("h", "block", F.element_at("members", 1).alias("b"))
    split = stored(firsts.where("block > 0"))
    if not split.isEmpty():
        near = near.union(split.join(firsts.where("block = 0").select("h", F.col("b").alias("a")), "h").select("a", "b"))
    near = near.where((F.col("a.rep") != F.col("b.rep")) & _may(F.col("a"), F.col("b"), p, q))
    stars = stored(near.select(F.least("a.rep", "b.rep").alias("u"), F.greatest("a.rep", "b.rep").alias("v")).distinct())
    sketches = reps.select("rep", "size", "sketch")
    links = _verified(_sketched(stars, sketches, similarity), docs, reps, again, words, similarity)
    links = links if max_bits is None else links.union(_by_fingerprint(rows, reps, max_bits))
    found = components(links)
    blocks = _rooted(_exploded(met), found)
    if split.isEmpty():
        long, blocks = None, stored(blocks.where("low < high"))
    else:
        # a list in several blocks may hold several components though none of its blocks does; its sets carry their sketches, so that what these rule out is no pair at all
        long = split.select("h").distinct()
        blocks = stored(blocks.join(long.withColumn("split", F.lit(True)), "h", "left").where("low < high or split").drop("split"))
        uneven = blocks.join(long, "h", "left_semi").groupBy("h").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("h")
        short = blocks.join(long, "h", "left_anti")
        long = stored(uneven)
        large = _exploded(blocks.join(long, "h", "left_semi")).join(sketches.select("rep", "sketch"), "rep")
        blocks = stored(_rooted(_exploded(short).withColumn("sketch", F.lit(None).cast("binary")), found).union(_rooted(large, found)))
    seen = stars
    for forest in (True, False):
        pairs = spread(_pairings(blocks, long, p, q, not forest)).mapInArrow(_across(p, q, forest), "u long, v long").distinct().join(seen, ["u", "v"], "left_anti")
        pairs = stored(_sketched(stored(pairs), sketches, similarity))
        if pairs.isEmpty():
            continue
        links = links.union(_verified(pairs, docs, reps, again, words, similarity))
        found = components(links)
        if forest:
            seen = stored(seen.union(pairs))
            blocks = stored(_rooted(_exploded(blocks), found))
    rooted = reps.select("rep", "digest", "doc_id").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "doc_id", F.coalesce("root", "rep").alias("group"))
    rooted = cut(rooted)
    least = rooted.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    rooted = cut(beside_hot(rooted.drop("doc_id"), least, "group"))
    return beside_hot(rows.select("doc_id", "key", "digest"), rooted, "digest").select("doc_id", "key", "group", "component_id")


def representatives(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, max_bits: int | None = None) -> DataFrame:
    """docs without the near copies: of each group the row of the smallest doc_id stays."""
    return kept(docs, cut(near_copies(docs, words, similarity, max_bits)))
