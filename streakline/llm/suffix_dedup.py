"""Repeated byte strings of a given length, by a difference cover and one bucket of suffixes at a time.

Of any two positions in texts there is a shift below v after which both are in the cover sample (their places modulo v
are in a difference cover). So if the same ``length`` bytes start at both, the samples there share a string of
``length - v + 1`` bytes. First the samples, a fraction of all positions, are ranked by that string; only whether a
rank occurs again matters here, so a rank is a hash and not a place in an order. Suffixes that reach no repeated
sample are settled: they are unique. The others, all those that tie with another one over a long stretch, are sorted
bucket by bucket on a 96-bit hash of ``length`` bytes; neighbours that agree are repeats.

A task holds the rows of one bucket, a round of buckets is on disk at a time. A string that a task meets twice is
settled there and leaves it once, so a passage in a third of all texts sends one row per task. Equal texts are
compared once.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm.common import packed, partitions, prepare, stored, unpacked

FLUSH = 1 << 20
KNOWN = np.uint32(0xFFFFFFFF)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def difference_cover(r: int) -> tuple[int, list[int]]:
    """The Colbourn-Ling cover: 6 r + 4 numbers whose differences are all numbers modulo v = 24 r^2 + 36 r + 13."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)]).tolist()


def cover_for(length: int) -> tuple[int, list[int]]:
    """The widest cover that leaves samples strings of at least half the length."""
    if length < 26:
        raise ValueError("a length of 26 bytes or more")
    r = 0
    while difference_cover(r + 1)[0] <= length - length // 2 + 1:
        r += 1
    return difference_cover(r)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of windows from sums over prefixes: each byte is a fixed random number times a power of an odd base."""

    def __init__(self, seed: int):
        self._base = (0x9E3779B97F4A7C15 + 2 * seed * 0xD1342543DE82EF95) % (1 << 64) | 1
        self._table = _mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed))
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            size = max(size, 2 * len(self._powers))
            for name, base in (("_powers", self._base), ("_inverses", pow(self._base, -1, 1 << 64))):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def sums(self, raw: bytes) -> np.ndarray:
        n = len(raw)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self._table[np.frombuffer(raw, np.uint8)] * self._powers[:n], out=out[1:])
        return out

    def at(self, sums: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
        return _mixed((sums[places + window] - sums[places]) * self._inverses[places])


def _pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack("<I", len(arrays)) + b"".join(struct.pack("<cQ", a.dtype.str[1].encode(), a.nbytes) + struct.pack("<B", a.itemsize) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    (count,), place, shapes = struct.unpack_from("<I", raw), 4, []
    for _ in range(count):
        kind, size, item = *struct.unpack_from("<cQ", raw, place), raw[place + 9]
        shapes.append((f"<{kind.decode()}{item}", size))
        place += 10
    out = []
    for kind, size in shapes:
        out.append(np.frombuffer(raw, kind, size // int(kind[2:]), place))
        place += size
    return out


def _hits(ids: np.ndarray, places: np.ndarray, homes: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of hits by home, the partition that gathers a text's hits."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order]
    home = (_mixed(ids.view(np.uint64)) % np.uint64(homes)).astype(np.int64)
    for h in np.unique(home).tolist():
        here = home == h
        some, counts = np.unique(ids[here], return_counts=True)
        steps = np.diff(places[here].astype(np.int64), prepend=0).astype(np.int32)
        yield h, _pack(some, counts.astype(np.uint32), steps)


def _hits_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    some, counts, steps = _unpack(data)
    return np.repeat(some, counts), np.cumsum(steps.astype(np.int64)).astype(np.uint32)


ASKED = "bucket int, home int, data binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], ["bucket", "home", "data"])


def _ask(places_of: Callable, window: int, buckets: int, first: int, count: int, homes: int):
    """Map side: keys of the chosen places whose bucket is in this round. Keys met twice are settled at once."""

    def settle(ids, indexes, places, keys, checks) -> Iterator[tuple]:
        ids = np.array(ids, np.int64)
        indexes, places, keys, checks = (np.concatenate(x) for x in (indexes, places, keys, checks))
        order = np.lexsort((checks, keys))
        indexes, places, keys, checks = indexes[order], places[order], keys[order], checks[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])])
        begins = np.flatnonzero(fresh)
        times = np.diff(np.append(begins, len(keys)))
        repeated = np.repeat(times > 1, times)
        for home, data in _hits(ids[indexes[repeated]], places[repeated], homes):
            yield -1, home, data
        # A row per key; the place of a settled one is of no interest.
        indexes, places = indexes[begins].copy(), places[begins].copy()
        indexes[times > 1] = KNOWN
        places[times > 1] = 0
        keys, checks = keys[begins], checks[begins]
        bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
        for b in np.unique(bucket).tolist():
            here = np.flatnonzero(bucket == b)
            here = here[np.lexsort((places[here], indexes[here]))]
            used, local = np.unique(indexes[here], return_inverse=True)
            named = np.where(used == KNOWN, 0, ids[np.where(used == KNOWN, 0, used)])
            steps = np.diff(places[here].astype(np.int64), prepend=0).astype(np.int32)
            yield int(b), -1, _pack(named, (used == KNOWN).astype(np.uint8), np.diff(local, prepend=0).astype(np.int32), steps, keys[here], checks[here])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(1), Rolling(2)
        ids, parts, held = [], [[], [], [], []], 0
        for batch in batches:
            for name, raw, *spans in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                ids.append(name)
                for start in range(0, len(raw), FLUSH):
                    block = places_of(len(raw), start, min(start + FLUSH, len(raw)), *spans)
                    if not len(block):
                        continue
                    part, local = raw[start : start + FLUSH + window], block - start
                    sums = one.sums(part)
                    keys = one.at(sums, local, window)
                    bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
                    mine = (bucket >= first) & (bucket < first + count)
                    block, local = block[mine], local[mine]
                    checks = two.at(two.sums(part), local, window).astype(np.uint32)
                    for column, value in zip(parts, (np.full(len(block), len(ids) - 1, np.uint32), block.astype(np.uint32), keys[mine], checks), strict=True):
                        column.append(value)
                    held += len(block)
                    if held >= FLUSH:
                        yield _batch(list(settle(ids, *parts)))
                        ids, parts, held = [name], [[], [], [], []], 0
        if held:
            yield _batch(list(settle(ids, *parts)))

    return run


def _answer(homes: int):
    """Reduce side: a partition's keys, sorted; neighbours that agree are repeats. Settled hits pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[list[np.ndarray]] = []
        for batch in batches:
            through = []
            for bucket, home, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if bucket < 0:
                    through.append((bucket, home, data))
                    continue
                named, known, local, steps, keys, checks = _unpack(data)
                local = np.cumsum(local.astype(np.int64))
                asked.append([named[local], known[local], np.cumsum(steps.astype(np.int64)).astype(np.uint32), keys, checks])
            if through:
                yield _batch(through)
        if asked:
            ids, known, places, keys, checks = (np.concatenate(x) for x in zip(*asked, strict=True))
            del asked
            order = np.lexsort((checks, keys))
            fresh = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (checks[order][1:] != checks[order][:-1])])
            begins = np.flatnonzero(fresh)
            times = np.diff(np.append(begins, len(keys)))
            settled = np.add.reduceat(known[order], begins) > 0
            hit = np.repeat((times > 1) | settled, times) & (known[order] == 0)
            found = order[hit]
            yield _batch([(-1, home, data) for home, data in _hits(ids[found], places[found], homes)])

    return run


def _gather(before: int, after: int):
    """The hits of a text as intervals [place - before, place + after), overlapping and touching ones merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_hits_of(data) for batch in batches for data in batch.column(0).to_pylist()]
        if not parts:
            return
        ids, places = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((places, ids))
        ids, places = ids[order], places[order].astype(np.int64)
        begins, ends = np.maximum(places - before, 0), places + after
        same = np.concatenate([[False], ids[1:] == ids[:-1]])
        # Places ascend within a text and all intervals are equally long, so the last end is the greatest.
        opens = ~(same & np.concatenate([[False], begins[1:] <= ends[:-1]]))
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(ids)) - 1
        pairs = np.stack([begins[first], ends[last]], axis=1).astype("<i8")
        owners = ids[first]
        edges = np.append(np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])), len(owners))
        for start in range(0, len(edges) - 1, 4096):
            some = list(zip(edges[start : start + 4096], edges[start + 1 : start + 4097], strict=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(owners[a]) for a, _ in some], pa.int64()), pa.array([pairs[a:b].tobytes() for a, b in some], pa.binary())], ["id", "spans"]
            )

    return run


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Within, a finished job's shuffle files go at once; what it wrote stays."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, old)


def _repeats(rows: DataFrame, places_of: Callable, window: int, rounds: int, before: int, after: int, name: str) -> DataFrame:
    """``id`` and ``spans`` around the places whose window occurs again; a round of buckets at a time."""
    spark = rows.sparkSession
    parts = partitions(spark)
    hits = None
    for k in range(rounds):
        asked = rows.mapInArrow(_ask(places_of, window, parts * rounds, k * parts, parts, parts), ASKED)
        # Settled hits have no bucket; they may go anywhere.
        dealt = asked.repartition(parts, F.when(F.col("bucket") < 0, F.col("home")).otherwise(F.col("bucket")))
        found = stored(dealt.mapInArrow(_answer(parts), ASKED).select("home", "data"), f"{name}_{k}")
        hits = found if hits is None else hits.unionByName(found)
    return hits.repartition(parts, "home").select("data").mapInArrow(_gather(before, after), "id bigint, spans binary")


def repeated_spans(texts: DataFrame, length: int = 400, sample_rounds: int = 2, rounds: int = 4) -> DataFrame:
    """For a table with unique ``id`` and ``raw`` (binary): ``id``, ``raw`` and ``spans`` of the texts with bytes
    covered by a string of ``length`` bytes that also starts at another place. ``spans`` are pairs of little-endian
    64-bit numbers, begin and end, maximal and in order."""
    v, cover = cover_for(length)
    offsets, window = np.array(cover, np.int64), length - v + 1

    def samples(size: int, begin: int, end: int) -> np.ndarray:
        places = (np.arange(begin - begin % v, end, v)[:, None] + offsets).ravel()
        return places[(places >= begin) & (places < min(end, size - window + 1))]

    def suffixes(size: int, begin: int, end: int, spans: bytes) -> np.ndarray:
        pairs = np.clip(np.frombuffer(spans, "<i8").reshape(-1, 2), begin, max(begin, min(end, size - length + 1)))
        return np.concatenate([np.arange(a, b) for a, b in pairs.tolist()])

    near = _repeats(texts.select("id", "raw"), samples, window, sample_rounds, v - 1, 1, "sample_hits")
    candidates = stored(texts.join(near, "id").select("id", "raw", "spans"), "tied_suffixes")
    covered = _repeats(candidates, suffixes, length, rounds, 0, length, "suffix_hits")
    return candidates.select("id", "raw").join(covered, "id")


def _kept(raw: pa.Array, spans: pa.Array) -> pa.Array:
    kept, counts, removed = [], [], []
    for value, data in zip(raw.to_pylist(), spans.to_pylist(), strict=True):
        pairs, at, parts = np.frombuffer(data, "<i8").reshape(-1, 2).tolist(), 0, []
        for a, b in pairs:
            parts.append(value[at:a])
            at = b
        parts.append(value[at:])
        kept.append(b"".join(parts))
        counts.append(len(pairs))
        removed.append(sum(b - a for a, b in pairs))
    return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], ["kept", "n_spans", "n_removed"])


def classes_without_repeats(docs: DataFrame, text: str = "text", length: int = 400, sample_rounds: int = 2, rounds: int = 4) -> DataFrame:
    """For each different text with something to remove: ``sha256`` of it, ``kept`` (its remaining bytes),
    ``n_spans`` and ``n_removed``. A text of ``length`` bytes or more that occurs twice goes as a whole."""
    spark = docs.sparkSession
    prepare(spark)
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    with _shuffles_removed(spark):
        long = docs.select(raw.alias("raw")).where(F.octet_length("raw") >= length).select(F.sha2("raw", 256).alias("sha256"), "raw")
        texts = stored(
            long.groupBy("sha256").agg(F.count("*").alias("copies"), F.first("raw").alias("raw")).withColumn("id", F.monotonically_increasing_id()), "different_texts"
        )
        spans = repeated_spans(texts, length, sample_rounds, rounds)
        cut = F.arrow_udf(_kept, "struct<kept: binary, n_spans: bigint, n_removed: bigint>")
        cuts = stored(spans.select("id", cut("raw", "spans").alias("cut")).select("id", "cut.*"), "cut_texts")
    whole = F.col("copies") > 1
    named = texts.select("id", "sha256", "copies", F.octet_length("raw").cast("bigint").alias("size")).join(cuts, "id", "left").where(whole | F.col("kept").isNotNull())
    return named.select(
        "sha256",
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.lit(1).cast("bigint")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, F.col("size")).otherwise(F.col("n_removed")).alias("n_removed"),
    )


def drop_repeated_strings(docs: DataFrame, text: str = "text", length: int = 400, sample_rounds: int = 2, rounds: int = 4) -> DataFrame:
    """The documents and ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes) and ``kept_sha256``.

    Strings are judged on the texts as given, as UTF-8; matches may overlap and lie in one document, never across
    documents. A null text counts as empty. Repeated rows are copies of each other. Columns named like a new one are
    replaced. Texts are told apart by SHA-256, strings by 96 bits of rolling hashes."""
    changed = classes_without_repeats(docs, text, length, sample_rounds, rounds)
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    own = docs.select(packed(docs), raw.alias("raw"), F.sha2(raw, 256).alias("sha256")).join(changed, "sha256", "left")
    kept = F.coalesce("kept", "raw")
    return unpacked(
        own,
        docs.columns,
        n_bytes=F.octet_length("raw").cast("bigint"),
        n_removed=F.coalesce("n_removed", F.lit(0).cast("bigint")),
        n_spans=F.coalesce("n_spans", F.lit(0).cast("bigint")),
        kept=kept,
        kept_sha256=F.when(F.col("n_spans").isNull(), F.col("sha256")).otherwise(F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256)),
    )


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400, sample_rounds: int = 2, rounds: int = 4) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, without moving the texts again."""
    changed = classes_without_repeats(docs, text, length, sample_rounds, rounds)
    slim = changed.select("sha256", "n_spans", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.octet_length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("sha256"))
    zero = F.lit(0).cast("bigint")
    return own.join(slim, "sha256", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")
    )
