"""Byte-level BPE by the tiktoken library with a local file of ranks.

Long texts are cut before they are encoded, only where no match of the pattern can cross: after a letter, digit or
mark of punctuation that white space follows, and between a letter and a digit. Both sides then match as they would
in the whole text, so a worker never holds the ids of more than one block as Python objects.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import packed, prepare, unpacked

BLOCK = 1 << 18
RANKS = "byte_bpe_50k.tiktoken"


@cache
def _border():
    import regex

    return regex.compile(r"(?<=[\p{L}\p{N}\p{P}])(?=[ \t\n\r])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@cache
def encoding(path: str | None = None):
    """The ranks of the file with the public pattern, without special tokens."""
    import tiktoken

    with open(path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def blocks(text: str, size: int = BLOCK) -> list[str]:
    """The text in blocks of ``size`` characters or a little more, cut at safe borders only."""
    out, begin = [], 0
    while len(text) - begin > size:
        border = _border().search(text, begin + size)
        if border is None:
            break
        out.append(text[begin : border.start()])
        begin = border.start()
    out.append(text[begin:])
    return out


def encode_text(text: str, path: str | None = None, size: int = BLOCK) -> np.ndarray:
    encode = encoding(path).encode_ordinary
    if len(text) <= size:
        return np.array(encode(text), np.int32)
    return np.concatenate([np.array(encode(b), np.int32) for b in blocks(text, size)])


def decode_ids(ids: np.ndarray, path: str | None = None, size: int = BLOCK) -> bytes:
    """The bytes of the ids, which need not be valid UTF-8."""
    decode = encoding(path).decode_bytes
    return b"".join(decode(ids[k : k + size].tolist()) for k in range(0, len(ids), size))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.int32), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """The documents' columns and ``ids array<int>``; a null or empty text has no ids. A column ``ids`` is replaced."""
    prepare(docs.sparkSession)

    def run(values: pa.Array) -> pa.Array:
        return _lists([encode_text(t or "", path) for t in values.to_pylist()])

    encoded = F.arrow_udf(run, "array<int>")
    return unpacked(docs.select(packed(docs), encoded(F.col(f"`{text}`").cast("string")).alias("encoded")), docs.columns, ids="encoded")


def decode(ids: Column | str, path: str | None = None) -> Column:
    """The raw bytes of an array of ids; a null array has none."""

    def run(values: pa.Array) -> pa.Array:
        ends, flat = values.offsets.to_numpy(), values.values.to_numpy()
        return pa.array([decode_ids(flat[a:b], path) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def round_trip(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of each document."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return encode(own, "text", path).select("doc_id", "ids", decode("ids", path).alias("decoded"))
