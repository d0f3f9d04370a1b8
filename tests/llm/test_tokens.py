"""BPE and packing against the tokenizers library and their own laws."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicloom.llm import bpe, packing, queries
from topicloom.llm.common import Generations, tokenizer_path

SPECIAL = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "<|startoftext|>x", "it's  we'll\n\n x\r\n", "  x　y\x1c\x85z", "naïve İstanbul ΣΑΣ한글😀é", "a" * 3000, "!?.,;" * 200, "1234 ²½ 12"]


def texts(more):
    parts = [*"abz XY,.'\n\t09<|>", *more, "é", "😀", "\u0301", "\u3000", "\x1f", "'ll", "the ", "<|endoftext|>"]
    return st.lists(st.sampled_from(parts), max_size=60).map("".join)


@pytest.fixture(scope="module")
def byte():
    return bpe.ByteBpe.of(tokenizer_path(bpe.VOCABULARY)), Tokenizer.from_file(tokenizer_path(bpe.VOCABULARY))


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts(""))
def test_bpe_equals_library(byte, text):
    own, library = byte
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_special_cases_and_cold_cache(byte):
    own, library = byte
    own.chunks = Generations(own._chunk, 3)  # evicts all the time
    for text in SPECIAL:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    own.chunks = Generations(own._chunk)


def test_bpe_query(spark, frame, byte):
    texts = [*SPECIAL, None, "same", "same"]
    got = {r.doc_id: r for r in bpe.digests(frame(texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = np.array(byte[1].encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.digests(frame([])).collect() == []
    assert bpe.encode(frame(["hi there"])).first().decoded == "hi there"


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts("\x02É"))
def test_word_ids_equal_library(text):
    own = packing.WordEncoder.of(tokenizer_path(packing.VOCABULARY))
    assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_decreasing_is_best_fit():
    rng = random.Random(4)
    lengths = [rng.randint(1, 64) for _ in range(400)]
    sequence, offset = packing.best_fit_decreasing(lengths, 64)
    rooms, want = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):  # stable, as the operator
        fits = [r for r in rooms if r >= lengths[k]] if lengths[k] < 64 else []
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[k])
            want[k] = 64 - min(fits)
        else:
            rooms.append(64 - lengths[k])
            want[k] = 0
    assert [want[k] for k in range(len(lengths))] == offset
    assert max(sequence) + 1 == len(rooms)


def test_packing(spark, frame):
    texts = ["word " * 5000, None, "", "x", "x", "a b c " * 200, *("some text %d" % i for i in range(300))]
    rows = packing.pack(frame(texts), with_ids=True, group_pieces=100).toPandas()
    own = packing.WordEncoder.of(tokenizer_path(packing.VOCABULARY))
    for i, t in enumerate(texts):
        ids = own.encode((t or "").encode()) + np.array([1], "<u4").tobytes()
        mine = rows[rows.doc_id == i].sort_values("start")
        assert b"".join(mine.ids) == ids and (mine.doc_tokens == len(ids) // 4).all()
        assert [zlib.crc32(x) for x in mine.ids] == mine.ids_crc32.tolist()
    placed = rows.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(frame([])).collect() == []


def test_queries_run(spark, data):
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    assert queries.op1_bpe(spark, data).count() == n
    assert queries.op3_packing(spark, data).select("doc_id").distinct().count() == n


def test_caches_hold_no_very_long_words():
    from topicloom.llm.common import LONGEST_KEY, Generations

    cache = Generations(len, 10)
    long = "x" * (LONGEST_KEY + 1)
    assert cache[long] == LONGEST_KEY + 1 and long not in cache and cache["short"] == 5 and "short" in cache
