"""SimHash classes by multi-index hashing.

A fingerprint has two segments of 32 bits. If two fingerprints differ in three bits or fewer, one of the segments
differs in at most one. So every fingerprint is filed under its two segments and looked up under each segment and
each of the 32 values one bit away; what is found is verified on all 64 bits. Of two values one bit apart one has a
zero there, so it is enough to look up values with one zero bit set.

Equal fingerprints are filed once. A segment value that more than ``hot`` different fingerprints share is not paired:
there the other segments stand in a space of 32 bits, and two that are near each other meet at a value between them,
where all are linked to one. That is linear in the fingerprints, with the same components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, packed, prepare, stored, unpacked
from streakline.llm.components import components

SEED = 42
DISTANCE = 3
LOW = 0xFFFFFFFF
HIGH = -1 << 32


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The bits set in over half of the shingles' hashes, unsigned; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: len(words) - shingle + 1].tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)]
        ones += np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(text: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle) for t in text.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return F.arrow_udf(run, "bigint")


def fingerprint_hex(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _filed(fps: DataFrame) -> DataFrame:
    """A row per fingerprint and segment: ``segment``, ``value`` (the other segment's bits are zero), ``fp``."""
    places = F.array(
        *[F.struct(F.lit(s).alias("segment"), F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")).alias("value")) for s, mask in ((0, LOW), (1, HIGH))]
    )
    return fps.select("fp", F.inline(places))


def _looked_up(filed: DataFrame) -> DataFrame:
    """A row per filed row and value one set bit away. ``own`` is false there and true for the filed rows."""
    masks = {s: [b - (1 << 64) if b >> 63 else b for b in (1 << i for i in range(32 * s, 32 * s + 32))] for s in (0, 1)}
    bits = F.when(F.col("segment") == 0, F.array(*[F.lit(m).cast("bigint") for m in masks[0]])).otherwise(
        F.array(*[F.lit(m).cast("bigint") for m in masks[1]])
    )
    flips = filed.select("fp", "segment", "value", F.explode(bits).alias("bit")).where(F.col("value").bitwiseAND(F.col("bit")) == 0)
    return flips.select("fp", "segment", F.col("value").bitwiseOR(F.col("bit")).alias("value"), F.lit(False).alias("own")).unionByName(
        filed.withColumn("own", F.lit(True))
    )


def _ball(radius: int, segment: int) -> list[int]:
    """All masks of ``radius`` bits or fewer in the segment that is not ``segment``, as signed numbers."""
    bits = range(32, 64) if segment == 0 else range(32)
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(bits, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _hot_links(members: DataFrame) -> DataFrame:
    """Links in crowded buckets. At a point between, a filed fingerprint one bit away or nearer is the leader: it is
    within three bits of filed ones up to two bits away and of looked-up ones up to one bit away."""
    near, far = ({s: F.array(*[F.lit(m).cast("bigint") for m in _ball(r, s)]) for s in (0, 1)} for r in (1, 2))
    reach = F.when(F.col("own"), F.when(F.col("segment") == 0, far[0]).otherwise(far[1])).otherwise(F.when(F.col("segment") == 0, near[0]).otherwise(near[1]))
    other = F.col("fp").bitwiseAND(F.when(F.col("segment") == 0, F.lit(HIGH).cast("bigint")).otherwise(F.lit(LOW).cast("bigint")))
    at = members.select("segment", "value", "fp", "own", other.alias("other"), F.explode(reach).alias("mask"))
    place = ["segment", "value", "point"]
    # A point has at most 529 filed and 32 * 33 looked-up fingerprints, whatever the input.
    leader = F.min(F.when(F.col("own") & (F.bit_count("mask") <= 1), F.col("fp"))).over(Window.partitionBy(*place))
    points = at.select("segment", "value", F.col("other").bitwiseXOR(F.col("mask")).alias("point"), "fp", "own", "mask").withColumn("leader", leader)
    return points.where("leader <> fp").select(F.col("fp").alias("a"), F.col("leader").alias("b")).distinct()


def links(fps: DataFrame, distance: int = DISTANCE, hot: int = 128) -> DataFrame:
    """Links ``a``, ``b`` with the components of all pairs of distinct ``fp`` that differ in ``distance`` bits or fewer
    (3 at most, two segments cannot promise more)."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("distance is 0 to 3 bits")
    filed = _filed(fps)
    looked_up = _looked_up(filed)
    crowded = stored(filed.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > hot), "crowded").drop("n")
    bucket = ["segment", "value"]
    left = looked_up.join(crowded, bucket, "left_anti").alias("l")
    right = filed.alias("r")
    close = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= distance
    pairs = left.join(
        right,
        (F.col("l.segment") == F.col("r.segment"))
        & (F.col("l.value") == F.col("r.value"))
        & (F.col("l.fp") != F.col("r.fp"))
        & (~F.col("l.own") | (F.col("l.fp") < F.col("r.fp")))
        & close,
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    if crowded.isEmpty():
        return pairs
    if distance < DISTANCE:
        raise ValueError(f"more than {hot} fingerprints share a segment; only the distance 3 has a linear way for that")
    return pairs.unionByName(_hot_links(looked_up.join(crowded, bucket, "left_semi")))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = DISTANCE, hot: int = 128) -> DataFrame:
    """A row per document: ``doc_id``, ``fp`` (64 bits, signed), ``row`` (hash of id and text), ``root`` (a fingerprint
    that names the class) and ``component_id``, the least id of the class.

    A null or empty text has the fingerprint zero and is linked like any other. Rows that repeat an id are rows of
    their own; a class whose ids are all null has a null ``component_id``, and still its own ``root``.
    """
    spark = docs.sparkSession
    prepare(spark)
    content = F.col(f"`{text}`")
    table = stored(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), content).alias("row"), content.cast("binary").alias("text")).select(
            "doc_id", "row", _fingerprints(shingle)("text").alias("fp")
        ),
        "fingerprints",
    )
    distinct = stored(table.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    roots = components(links(distinct.select("fp"), distance, hot))
    rooted = stored(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted_fingerprints"
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(named, "root").select("fp", "root", "component_id")
    return table.join(named, "fp")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """The document of each class with the least id (nulls last, then by a hash of the text), with its own columns.
    Of rows that repeat both id and text one stays."""
    first = Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    found = classes(docs, text, doc_id, shingle, distance)
    survivors = found.withColumn("n", F.row_number().over(first)).where("n = 1").select("row")
    row = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    own = docs.select(packed(docs), row.alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    once = Window.partitionBy("row", "doc_id", "text").orderBy("row")
    kept = own.join(survivors, "row", "left_semi").withColumn("n", F.row_number().over(once)).where("n = 1")
    return unpacked(kept.select(ORIGINAL), docs.columns)
