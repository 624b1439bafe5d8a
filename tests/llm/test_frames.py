from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyarrow import fs
from tokenizers import Tokenizer

from streakline.llm.frames import FOOTER_MAGIC, FrameReader, FrameWriter, read_digests, write_ids
from streakline.session import scratch_path

SCHEMA = "doc_id bigint, text string, h string, number int, file string"


class File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def write(docs, frame=64):
    out = io.BytesIO()
    writer = FrameWriter(out, frame)
    for doc, ids in docs:
        writer.add(doc, np.array(ids, "<u4").tobytes())
    writer.finish()
    return out.getvalue()


DOCS = [(5, [1, 2, 3]), (None, []), (-7, list(range(100))), (5, [2**32 - 1]), (9, [])]


def test_round_trip():
    reader = FrameReader(File(write(DOCS)))
    assert [(reader.doc_id(k), reader.ids(k).tolist()) for k in range(len(DOCS))] == DOCS
    assert reader.find(5) == [0, 3] and reader.find(0) == []
    assert FrameReader(File(write([]))).index.size == 0


def test_only_the_needed_frames_are_read():
    docs = [(i, [i] * 16) for i in range(50)]
    reader = FrameReader(File(write(docs)))
    assert reader.ids(20).tolist() == [20] * 16
    assert reader.frames_read == 1


def test_any_zstandard_reader_sees_the_ids():
    """Plain decompression skips both skippable frames."""
    data = write(DOCS)
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(raw, "<u4").tolist() == [i for _, ids in DOCS for i in ids]
    assert struct.unpack("<I", data[-4:])[0] == FOOTER_MAGIC


def test_damage_is_found():
    data = bytearray(write([(1, list(np.random.default_rng(0).integers(0, 2**32, 64)))], 1024))
    data[20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        FrameReader(File(bytes(data))).ids(0)
    with pytest.raises(ValueError):
        FrameReader(File(b"x" * 100))


def test_documents(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(i, t, "x", 1, "") for i, t in enumerate(texts)] + [(None, None, "", 0, ""), (1000, "", "", 0, ""), (1001, "long " * 300_000, "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    files = write_ids(docs, scratch_path(spark, "ids"), frame=4096)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, before = [], 0
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    assert sorted(map(tuple, read_digests(files).collect()), key=repr) == sorted(expected, key=repr)
    listed = files.orderBy("number").collect()
    assert sum(r["docs"] for r in listed) == len(rows) and sum(r["ids"] for r in listed) == before
    system, path = fs.FileSystem.from_uri(listed[-1]["file"])
    with system.open_input_file(path) as handle:
        reader = FrameReader(handle)
        assert reader.ids(reader.find(1000)[0]).tolist() == [1]


def test_repeats_and_empty(spark):
    docs = spark.createDataFrame([(3, "same words", "", 0, "")] * 20 + [(None, "same words", "", 0, "")] * 3, SCHEMA)
    got = sorted(r["start"] for r in read_digests(write_ids(docs, scratch_path(spark, "ids"))).collect())
    assert got == [3 * k for k in range(23)]
    assert read_digests(write_ids(docs.limit(0), scratch_path(spark, "ids"))).collect() == []
