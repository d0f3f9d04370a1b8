"""Byte-level BPE encoding and decoding.

A text is cut by the pre-tokenizer's pattern; each piece becomes byte symbols whose adjacent pairs have
merge ranks. A segment tree over the pairs keeps, in each node, the least (rank, position) below it: its
root is the leftmost merge of lowest rank. A merge changes two neighbouring pairs, each a logarithmic point
update, until the root says that no pair can merge. Long pieces cost n log n; frequent short ones come
from a bounded cache. Decoding joins the ids' bytes and replaces what is not UTF-8.

Null texts count as empty (no ids, the digest of nothing). Rows are independent: equal rows give equal
results, a null doc_id stays null, an empty table gives an empty one, further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from topicloom.llm.common import Generations, session, text_column, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
#: White space as the pre-tokenizer's \s has it; the published pattern of this vocabulary.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: No match of PIECE crosses a match of this one.
CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class ByteBpe:
    _made: dict[str, "ByteBpe"] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, symbols = spec["model"]["vocab"], byte_symbols()
        to_byte = {c: b for b, c in enumerate(symbols)}
        self.first = [vocabulary[c] for c in symbols]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes = {i: bytes(to_byte[c] for c in t) for t, i in vocabulary.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        #: (left, right) -> rank << 32 | merged id
        self.merges = {(vocabulary[a], vocabulary[b]): rank << 32 | vocabulary[a + b] for rank, (a, b) in enumerate(pairs)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.chunks = Generations(self._chunk)

    @classmethod
    def of(cls, path: str) -> "ByteBpe":
        """One encoder, and so one cache, for all tasks of a worker."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def merge(self, ids: list[int]) -> list[int]:
        """The ids after all merges, by a segment tree over adjacent pairs."""
        n = len(ids)
        if n < 2:
            return ids
        merges, leaves = self.merges, 1 << (n - 2).bit_length() if n > 2 else 1
        # a key orders by rank, then position: the root's is the leftmost merge of lowest rank
        tree = [NONE] * (2 * leaves)
        for k in range(n - 1):
            found = merges.get((ids[k], ids[k + 1]))
            if found is not None:
                tree[leaves + k] = (found >> 32) << 32 | k
        for node in range(leaves - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (top := tree[1]) != NONE:
            k = top & 0xFFFFFFFF
            right = after[k]
            ids[k] = merges[ids[k], ids[right]] & 0xFFFFFFFF
            beyond = after[k] = after[right]
            ids[right] = -1
            changed = [(right, NONE)]
            if beyond < n:
                before[beyond] = k
                found = merges.get((ids[k], ids[beyond]))
                changed.append((k, NONE if found is None else (found >> 32) << 32 | k))
            else:
                changed.append((k, NONE))
            if (left := before[k]) >= 0:
                found = merges.get((ids[left], ids[k]))
                changed.append((left, NONE if found is None else (found >> 32) << 32 | left))
            for at, key in changed:
                node = leaves + at
                if node >= 2 * leaves or tree[node] == key:
                    continue
                tree[node] = key
                while node > 1:
                    other = tree[node ^ 1]
                    if other < key:
                        key = other
                    node >>= 1
                    if tree[node] == key:
                        break
                    tree[node] = key
        return [i for i in ids if i >= 0]

    def _chunk(self, chunk: str) -> bytes:
        if chunk[-1] in ",." and chunk[-2:-1].isascii() and chunk[-2:-1].isalpha():  # two pieces; the first is often known
            return self.chunks[chunk[:-1]] + self.chunks[chunk[-1]]
        first, out = self.first, []
        for piece in PIECE.findall(chunk):
            out += self.merge([first[b] for b in piece.encode()])
        return array("I", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint32 bytes; special tokens' strings become their ids."""
        parts = self.cut.split(text) if self.cut else [text]
        if len(parts) == 1:
            return b"".join(map(self.chunks.__getitem__, CHUNK.findall(text)))
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if k % 2 else b"".join(map(self.chunks.__getitem__, CHUNK.findall(p))) for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """doc_id, ids array<int>, decoded string of each row."""
    return _run(docs, vocabulary, folder, "doc_id long, ids array<int>, decoded string", lambda ids, text: (np.frombuffer(ids, "<i4"), text), [pa.list_(pa.int32()), pa.string()])


def digests(docs: DataFrame, vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return _run(docs, vocabulary, folder, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), [pa.int64(), pa.string(), pa.string()])


def _run(docs: DataFrame, vocabulary: str, folder: str | None, schema: str, of, types: list) -> DataFrame:
    session(docs.sparkSession)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        bpe = ByteBpe.of(tokenizer_path(vocabulary, folder))
        for batch in batches:
            rows = [of(ids := bpe.encode(text), bpe.decode(ids)) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(run, schema)
