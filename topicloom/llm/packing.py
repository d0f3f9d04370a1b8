"""Packing tokenised documents into fixed windows, best fit decreasing.

A document longer than the window is first cut into full windows; each of those is a sequence of its
own. What remains (under one window) is packed best fit decreasing: pieces from long to short, each
into the open sequence with the least room that still takes it, found in a segment tree over the
capacities 0..window whose leaves hold the sequences with that much room.

Pieces are dealt by a hash of the document's id into groups of about GROUP_PIECES; a group is packed by
one task, so memory is bounded and groups are independent. A group leaves about one window partly empty.

Token ids come from the tokenizers library. Texts are cut at ASCII white space first, which this
vocabulary's pre-tokenizer always does as well, and a bounded cache holds the ids of frequent words.
Null and empty texts still have the closing id. Rows are packed as they come: equal rows, and rows of
null doc_id, are packed once each. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import Generations, cut, session, text_column, tokenizer_path, told_apart

WINDOW, END_ID, GROUP_PIECES, VOCABULARY = 2048, 1, 2048, "word_bpe_49k.json"
CACHED_WORDS, PART = 600_000, b" \x02 "


class WordEncoder:
    """Ids of a whole text as little-endian uint32 bytes."""

    _made: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        [self.part] = self.tokenizer.encode(PART.strip().decode(), add_special_tokens=False).ids
        self.words = Generations(self._word, CACHED_WORDS)

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        """One encoder, and so one cache, for all tasks of a worker."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _word(self, word: bytes) -> bytes:
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encodes distinct words at once, a control character between any two."""
        ids = np.array(self.tokenizer.encode_batch_fast([PART.join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        parts = (4 * np.flatnonzero(ids == self.part)).tolist()
        if len(parts) != len(words) - 1:  # a word holds the character itself
            return {word: self._word(word) for word in words}
        data = ids.tobytes()
        return dict(zip(words, [data[a:b] for a, b in zip([0, *(x + 4 for x in parts)], [*parts, len(data)])]))

    def encode(self, text: bytes) -> bytes:
        """bytes.split() parts UTF-8 at the six ASCII spaces only."""
        words = text.split()
        found = list(map(self.words.get, words))
        if None in found:
            at = [k for k, ids in enumerate(found) if ids is None]
            missing = [words[k] for k in at]
            old = self.words.old
            learnt = {w: old[w] for w in missing if w in old}
            if new := [w for w in dict.fromkeys(missing) if w not in learnt]:
                learnt |= self._learn(new)
            self.words.put_all(learnt)
            for k, word in zip(at, missing):
                found[k] = learnt[word]
        return b"".join(found)


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY, folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens [, ids] of each piece: full windows, then the rest."""
    session(docs.sparkSession)
    closing = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = WordEncoder.of(tokenizer_path(vocabulary, folder))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + closing
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, piece if with_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + ([pa.array(columns[5], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).cast("binary").alias("text")).mapInArrow(run, schema)


class OpenWindows:
    """Open sequences by remaining capacity: a segment tree whose inner nodes say whether any leaf below holds one."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.at: list[list] = [[] for _ in range(self.leaves)]

    def put(self, room: int, sequence) -> None:
        self.at[room].append(sequence)
        node, tree = room + self.leaves, self.any
        while node and not tree[node]:
            tree[node] = 1
            node >>= 1

    def take(self, length: int):
        """(room, sequence) of least room that is length or more; None if there is none."""
        tree, node = self.any, length + self.leaves
        while not tree[node]:
            while node & 1:  # a right child: what stands to the right is beyond the parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.at[room].pop()
        if not self.at[room]:
            tree[node] = 0
            node >>= 1
            while node and not (tree[2 * node] or tree[2 * node + 1]):
                tree[node] = 0
                node >>= 1
        return room, sequence


def best_fit_decreasing(lengths, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, in the order given."""
    tree, sequence, offset, count = OpenWindows(window), [0] * len(lengths), [0] * len(lengths), 0
    for k in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        length = int(lengths[k])
        found = tree.take(length) if length < window else None
        if found is None:
            found, count = (window, count), count + 1
        room, sequence[k] = found
        offset[k] = window - room
        if room > length:
            tree.put(room - length, sequence[k])
    return sequence, offset


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY, folder: str | None = None, with_ids: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset; offsets of a sequence are gapless from 0."""
    found = cut(pieces(docs, window, end_id, vocabulary, folder, with_ids))
    groups = max(1, -(-found.count() // group_pieces))
    # equal rows may be any number: their numbers deal them out
    named = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    found = told_apart(found, named, "nth").withColumn("part", F.pmod(F.xxhash64(*named, "nth"), F.lit(groups)).cast("int")).drop("nth")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        sequence, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        rows["sequence_id"] = rows["part"].astype("int64") * (1 << 32) + np.array(sequence, "int64")
        rows["offset"] = np.array(offset, "int64")
        return rows.drop(columns="part")

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    return found.groupBy("part").applyInPandas(run, schema)
