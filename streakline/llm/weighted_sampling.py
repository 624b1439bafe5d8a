"""Document fingerprints by consistent weighted sampling.

The terms of a text are its runs of five words, weighted by how often they occur, each known by its 64-bit hash. For
every term and sample there are three fixed random numbers: r and c of the Gamma(2, 1) distribution and b uniform. With
weight w, t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y exp(r)); the term with the least a is sampled, together
with its t. Two texts draw the same sample with the probability of their generalised Jaccard similarity, the sum of the
lesser over the sum of the greater weights.

The random numbers are drawn from a fixed pool of 2^18 triples, by a hash of term and sample, so all tasks have the same
ones: the highest bits of the product of the term's hash and the sample's factor. Of terms with the same triple the one
of the least product is sampled, an order that does not depend on the text. The sample names the term itself, so texts
without a common term do not meet, whatever their length. For weight 1, the usual one, ln a = ln c + r b - r. The pool
is in its order, so the least product has the least a, and as factors are odd, the product tells its term.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.common import partitions, prepare

SHINGLE = 5
POOL_BITS = 18
SAMPLES = 64
BLOCK = 1 << 11
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd factor per sample: the highest bits of its product with a term's hash choose the triple.
FACTORS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in FACTORS], np.uint64)


@cache
def _pool() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c, b, and ln a of weight 1: 1 MB each."""

    def uniform(kind: int) -> np.ndarray:
        x = _mixed((np.arange(1 << POOL_BITS, dtype=np.uint64) * np.uint64(8) + np.uint64(kind + 1)) * GOLDEN)
        return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)

    r = -np.log(uniform(0) * uniform(1)).astype(np.float32)
    ln_c = np.log(-np.log(uniform(2) * uniform(3))).astype(np.float32)
    b = uniform(4).astype(np.float32)
    unit = ln_c + r * b - r
    in_order = np.argsort(unit, kind="stable")
    return r[in_order], ln_c[in_order], b[in_order], unit[in_order]


def _places(product: np.ndarray) -> np.ndarray:
    return (product >> np.uint64(64 - POOL_BITS)).astype(np.int64)


def _triples(term: np.ndarray) -> np.ndarray:
    """Row per term, column per sample: places in the pool."""
    return _places(_mixed(term)[:, None] * FACTORS)


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and weights. A text of fewer words is one term, one without words has none."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(joined)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        begins = (ends - sizes)[: len(words) - SHINGLE + 1].tolist()
        hashes = [digest(joined[a:b]) for a, b in zip(begins, ends[SHINGLE - 1 :].tolist(), strict=True)]
    return np.unique(np.array(hashes, np.uint64), return_counts=True)


def signature(term: np.ndarray, weight: np.ndarray) -> bytes:
    """The samples as little-endian 32-bit numbers, zeros without terms. Terms are different, weights positive."""
    if not len(term):
        return bytes(4 * SAMPLES)
    in_order = np.argsort(term.astype(np.uint64), kind="stable")
    term, weight = term.astype(np.uint64)[in_order], weight[in_order]
    least, named, level = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64)
    r_of, ln_c_of, b_of, unit = _pool()
    single = _mixed(term[weight == 1])
    if len(single):
        product = np.full(SAMPLES, np.iinfo(np.uint64).max)
        for start in range(0, len(single), BLOCK):
            product = np.minimum(product, (single[start : start + BLOCK, None] * FACTORS).min(axis=0))
        least, named = unit[_places(product)], product * INVERSES
    several, weights = term[weight != 1], weight[weight != 1]
    for start in range(0, len(several), BLOCK):
        block = several[start : start + BLOCK]
        places = _triples(block)
        r, ln_c, b = r_of[places], ln_c_of[places], b_of[places]
        t = np.floor(np.log(weights[start : start + BLOCK].astype(np.float32))[:, None] / r + b)
        ln_a = ln_c - r * (t - b) - r
        at, samples = ln_a.argmin(axis=0), np.arange(SAMPLES)
        better = ln_a[at, samples] < least
        least = np.where(better, ln_a[at, samples], least)
        named = np.where(better, _mixed(block)[at], named)
        level = np.where(better, t[at, samples].astype(np.int64), level)
    drawn = _mixed(named + (level + 1).astype(np.uint64) * GOLDEN)
    return ((drawn >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype("<u4").tobytes()


def fingerprint(text: bytes | None) -> bytes:
    return signature(*terms(text or b""))


def likeness_of(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")).mean())


def fingerprints(text: Column | str) -> Column:
    """The fingerprint of a text column as bytes; a null text counts as empty."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t) for t in values.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")((F.col(text) if isinstance(text, str) else text).cast("binary"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """The share of equal samples of two fingerprints, an estimate of the similarity with a standard error of 0.0625
    at most. Two texts without words are alike."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([likeness_of(x, y) for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.float64())

    return F.arrow_udf(run, "double")(a, b)


def with_next(docs: DataFrame, key: str, columns: list[str], parts: int) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows in ascending ``key`` (nulls first, equal keys by a hash of the
    other columns), of the first row after the last one.

    The rows are dealt to ranges of the key, and the first row of each range also to the range before it, so each
    range finds its successors by itself. The driver holds one key per range. Keys are meant to be nearly unique:
    all rows of one key are in one range."""
    keys = docs.select(F.col(key).cast("bigint").alias("k"))
    shares = [i / parts for i in range(1, parts)]
    rough = sorted(set(keys.agg(F.percentile_approx("k", shares or [0.5], 10_000).alias("c")).first()["c"] or []))

    def place(borders):
        bounds = np.array(borders, np.int64)

        def run(values: pa.Array) -> pa.Array:
            known = values.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            return pa.array(np.searchsorted(bounds, known, "right").astype(np.int32))

        return F.arrow_udf(run, "int")

    ranges = keys.groupBy(place(rough)("k").alias("part")).agg(F.min("k").alias("first"), F.max(F.col("k").isNull()).alias("null")).orderBy("part").collect()
    firsts = [None if r["null"] else r["first"] for r in ranges]
    borders = firsts[1:]
    last = len(borders)

    def targets(values: pa.Array) -> pa.Array:
        bounds, out = np.array(borders, np.int64), []
        known = values.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        for k, part, missing in zip(known.tolist(), np.searchsorted(bounds, known, "right").tolist(), values.is_null().to_pylist(), strict=True):
            to = [{"part": part, "after": False}]
            if part and k == borders[part - 1]:
                to.append({"part": part - 1, "after": True})
            if (missing and firsts[0] is None) or (not missing and k == firsts[0]):
                to.append({"part": last, "after": True})
            out.append(to)
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("after", pa.bool_())])))

    dealt = docs.withColumn("to", F.explode(F.arrow_udf(targets, "array<struct<part: int, after: boolean>>")(F.col(key).cast("bigint"))))
    others = [c for c in docs.columns if c != key]
    in_order = Window.partitionBy("to.part").orderBy(F.col("to.after"), F.col(key).asc_nulls_first(), F.xxhash64(*others), *others)
    followed = dealt.repartition(parts, F.col("to.part")).withColumns({f"next_{c}": F.lead(c).over(in_order) for c in columns})
    return followed.where("not to.after").drop("to")


def compared_with_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, ``text``, ``edited`` (the last quarter of the code points, rounded down, replaced by
    the first as many of the next document, or all it has), ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next``. A null text counts as empty. A single document is its own next one."""
    spark = docs.sparkSession
    prepare(spark)
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), content.alias("text")).withColumn("fingerprint", fingerprints("text"))
    followed = with_next(own, "doc_id", ["text", "fingerprint"], 4 * partitions(spark))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"), F.left("next_text", quarter))
    compared = followed.select("doc_id", "text", edited.alias("edited"), "fingerprint", "next_fingerprint").withColumn("edited_fingerprint", fingerprints("edited"))
    return compared.select(
        "doc_id",
        "text",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
