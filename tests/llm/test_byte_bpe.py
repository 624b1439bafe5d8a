from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streakline.llm.byte_bpe import blocks, decode_ids, encode, encode_text, encoding, round_trip

SCHEMA = "doc_id bigint, text string, ids string, decoded int"
TEXTS = ["", " ", "a", "it's  we'll\n\n\tnew 12ab ab12  \r\n end ", "Ärger 漢字かな 👩‍👩‍👧 é \x00\x1c\x85 x", "<|endoftext|>", "   \n" * 40, "'s't" * 20]


@pytest.mark.parametrize("size", [1, 2, 5, 17])
def test_blocks_do_not_change_the_ids(size):
    rng = random.Random(size)
    for text in TEXTS + ["".join(rng.choice("ab 1\n.'s\té ,") for _ in range(300)) for _ in range(30)]:
        assert "".join(blocks(text, size)) == text
        assert encode_text(text, size=size).tolist() == encoding().encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = encode_text(text, size=3)
    assert ids.tolist() == encoding().encode_ordinary(text)
    assert decode_ids(ids, size=2) == text.encode()


def test_ids_that_split_a_character():
    ids = encode_text("漢")
    assert len(ids) > 1 and decode_ids(ids[:1]) == "漢".encode()[: len(decode_ids(ids[:1]))]


def test_long_texts():
    for text in ("x" * 600_000, "word " * 200_000, " " * 300_000):
        assert encode_text(text).tolist() == encoding().encode_ordinary(text)


def test_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], "x", 1) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(None, None, None, None), (1000, "", "", 0)] + [(1001 + i, t, "", 0) for i, t in enumerate(TEXTS)] + rows[:3]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in round_trip(docs).collect()), key=repr)
    assert got == sorted(((i, encoding().encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=repr)
    assert encode(docs).columns == ["doc_id", "text", "decoded", "ids"]
    assert round_trip(docs.limit(0)).collect() == []
