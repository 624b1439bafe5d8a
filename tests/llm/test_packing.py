from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streakline.llm.packing import Packing, PackParams, best_fit, crossover, evolve, lower_bound, packed_documents
from streakline.llm.tokens import KEPT_LENGTH, WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER, WHOLE = WordEncoder(PATH), Tokenizer.from_file(PATH)
SCHEMA = "doc_id bigint, text string, n string, pool int, length string"
TEXTS = [
    None,
    "",
    " \n\t ",
    "Plain words, and MORE words; it's we'll don't 'stuff 12 345",
    "Ärger É é ́x İ ΟΔΟΣ ΟΔΟΣ. ﬁ ½ 漢字かな 👩‍👩‍👧 a b c\u0085d\x1ce\x00f",
    "<|endoftext|> in <|startoftext|>text x<|endoftext|>y",
    "x" * 3 * KEPT_LENGTH + " tail " + "y" * 20_000,
]


def test_ids_equal_those_of_the_whole_text(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    whole = Tokenizer.from_file(path)
    encoder = WordEncoder(path)
    for _ in range(2):
        found = encoder.encode([None if t is None else t.encode() for t in texts])
        for text, ids in zip(texts, found, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids
    assert encoder.encode([]) == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ's'tl'd09.,<|!~éÉßÿŸİıŉſĸ\u0301ÅåÇñ ×÷ªªªœŒ\u00ad\u212b"), max_size=24))
def test_any_word(text):
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def check(place, sizes, free, capacity):
    used = np.bincount(place, weights=sizes).astype(int)
    assert (place >= 0).all() and used.min() > 0 and used.max() <= capacity
    assert (capacity - used).tolist() == list(free)


@pytest.mark.parametrize("seed", range(4))
def test_packings_stay_whole(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, 300)
    crowd = evolve(sizes, [], PackParams(capacity=100, generations=5), seed)
    for packing in crowd:
        check(packing.place, sizes, packing.free, 100)
    plain = best_fit(np.argsort(-sizes, kind="stable").tolist(), sizes.tolist(), 100, Packing(np.full(300, -1, np.int32), []))
    noisy = best_fit(rng.permutation(300).tolist(), sizes.tolist(), 100, Packing(np.full(300, -1, np.int32), []))
    child = crossover(noisy, plain, sizes.tolist(), sizes, 100, rng)
    check(child.place, sizes, child.free, 100)
    assert lower_bound(sizes, 100) <= len(crowd[0].free) <= len(plain.free)


def test_generations_beat_plain_best_fit():
    """Triples that fill a bin exactly: decreasing best fit needs more bins than the optimum."""
    rng = np.random.default_rng(0)
    a, b = rng.integers(260, 400, 40), rng.integers(260, 300, 40)
    sizes = np.concatenate([a, b, 1000 - a - b])
    plain = best_fit(np.argsort(-sizes, kind="stable").tolist(), sizes.tolist(), 1000, Packing(np.full(120, -1, np.int32), []))
    found = evolve(sizes, [], PackParams(capacity=1000, generations=60), 1)[0]
    assert len(found.free) < len(plain.free)


def test_bound():
    assert lower_bound(np.array([60, 60, 60]), 100) == 3
    assert lower_bound(np.array([50, 50, 50]), 100) == 2
    assert lower_bound(np.array([70, 70, 40, 40, 40]), 100) == 4


@pytest.mark.parametrize("capacity", [2048, 64])
def test_documents(spark, sf_dir, capacity):
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = packed_documents(docs, params=PackParams(capacity=capacity, pool=500, generations=2)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            expected.add((i, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == expected
    assert len(got) == len(expected)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.02 * lower_bound(np.array([r["length"] for r in got]), capacity) + 1


def test_repeats_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b", "", 0, "")] * 30, SCHEMA)
    got = packed_documents(docs).collect()
    assert len(got) == 30 and len({(r["sequence_id"], r["offset"]) for r in got}) == 30
    assert packed_documents(spark.createDataFrame([], SCHEMA)).collect() == []
