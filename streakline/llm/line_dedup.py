"""Lines that many documents repeat, found with two Bloom filters.

One pass hashes the lines. The hashes, without repeats inside a batch, go to the segment of the filters they
belong to; there the first filter remembers hashes seen once, and a hash it already knows enters the second one.
The second filter, of a fixed size, goes back to all workers. In a second pass only lines it suspects leave their
task as text; they are counted exactly, and the counted keys decide. A full filter raises the number of suspects,
never changes the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, SPACE, packed, partitions, prepare, stored, unpacked

PROBES = 4


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _document_keys(text: bytes | None) -> set[bytes]:
    keys = set(map(line_key, (text or b"").split(b"\n")))
    keys.discard(b"")
    return keys


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Row per hash, column per probe; ``bits`` is a power of two."""
    first, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    probes = first[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]
    return (probes & np.uint64(bits - 1)).astype(np.int64)


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(segments)).astype(np.int32)


def _hash_lines(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_hashes(_document_keys(text)) for text in batch.column(0).to_pylist()]
            found, times = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_segment(found, segments)), pa.array(found.view(np.int64)), pa.array(times > 1)], ["segment", "hash", "repeated"]
            )

    return run


def _fold(once_bits: int, twice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            segment = batch.column(0).to_numpy(zero_copy_only=False)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            repeated = batch.column(2).to_numpy(zero_copy_only=False)
            for s in np.unique(segment).tolist():
                if s not in filters:
                    filters[s] = np.zeros(once_bits, bool), np.zeros(twice_bits, bool)
                once, twice = filters[s]
                here = segment == s
                found, where, times = np.unique(hashes[here], return_inverse=True, return_counts=True)
                known = times > 1
                known[where[repeated[here]]] = True
                slots = _slots(found, once_bits)
                known |= once[slots].all(axis=1)
                once[slots] = True
                twice[_slots(found[known], twice_bits)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(filters), pa.int32()), pa.array([np.packbits(t).tobytes() for _, t in filters.values()], pa.binary())], ["segment", "bits"]
        )

    return run


def repeat_filter(docs: DataFrame, text: str = "text", segments: int = 64, once_bits: int = 1 << 23, twice_bits: int = 1 << 20) -> np.ndarray:
    """The twice-seen filter, ``segments`` by ``twice_bits`` bits: 8 MB by default, whatever the input.

    The once-seen filter stays in the tasks, ``once_bits`` bytes for each segment.
    """
    spark = docs.sparkSession
    rows = (
        docs.select(F.col(text).cast("binary").alias("text"))
        .mapInArrow(_hash_lines(segments), "segment int, hash bigint, repeated boolean")
        .repartition(min(segments, partitions(spark)), "segment")
        .mapInArrow(_fold(once_bits, twice_bits), "segment int, bits binary")
        .collect()
    )
    table = np.zeros((segments, twice_bits // 8), np.uint8)
    for row in rows:
        table[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return table


def _suspects(shared, segments: int, twice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            rows, keys = [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(_document_keys(text))
                if not found:
                    continue
                hashes = _hashes(found)
                slots = _slots(hashes, twice_bits)
                bits = table[_segment(hashes, segments)[:, None], slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1
                picked = [found[i] for i in np.flatnonzero(bits.all(axis=1))]
                keys += picked
                rows += [row] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(keys, pa.binary())], ["row", "key"])

    return run


def _without(text: pa.Array, drops: pa.Array) -> pa.Array:
    lines, dropped, kept = [], [], []
    for value, keys in zip(text.to_pylist(), drops.to_pylist(), strict=True):
        parts = (value or b"").split(b"\n")
        bad = frozenset(keys or ())
        left = [p for p in parts if line_key(p) not in bad] if bad else parts
        lines.append(len(parts))
        dropped.append(len(parts) - len(left))
        kept.append(b"\n".join(left).decode())
    return pa.StructArray.from_arrays([pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept"])


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_docs: int = 10,
    segments: int = 64,
    once_bits: int = 1 << 23,
    twice_bits: int = 1 << 20,
) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped`` and ``kept``: the text without lines whose key ``min_docs`` rows or more have.

    A key is the line without white space at its ends, A-Z lower-cased; empty keys are never dropped. A null text
    counts as empty and keeps one empty line. Each row is a document of its own, also where ids repeat or are null.
    Other columns stay; those named like a new one are replaced. Rows are matched to their keys by a hash of id and
    text; if two rows shared it, each would only see more keys that are dropped everywhere anyway.
    """
    spark = docs.sparkSession
    prepare(spark)
    table = spark.sparkContext.broadcast(repeat_filter(docs, text, segments, once_bits, twice_bits))
    row = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    suspects = stored(
        docs.select(row.alias("row"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(
            _suspects(table, segments, twice_bits), "row bigint, key binary"
        ),
        "line_suspects",
    )
    # Stored, so that the join deals the suspects by itself and can split a key that many rows have.
    frequent = stored(suspects.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("key"), "frequent_lines")
    drops = suspects.join(frequent, "key").groupBy("row").agg(F.collect_set("key").alias("drops"))
    without = F.arrow_udf(_without, "struct<n_lines: bigint, n_dropped: bigint, kept: string>")
    result = (
        docs.select(packed(docs), row.alias("row"), F.col(f"`{text}`").cast("binary").alias("text"))
        .join(drops, "row", "left")
        .select(ORIGINAL, without("text", "drops").alias("out"))
    )
    return unpacked(result, docs.columns, n_lines=F.col("out.n_lines"), n_dropped=F.col("out.n_dropped"), kept=F.col("out.kept"))
