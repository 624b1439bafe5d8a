from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from streakline.llm.weighted_sampling import SAMPLES, _pool, _triples, compared_with_edits, fingerprint, likeness_of, signature, with_next

SCHEMA = "doc_id bigint, text string, fingerprint string, to int"


def jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def sign(weights):
    return signature(np.array(list(weights), np.int64), np.array(list(weights.values()), np.int64))


@pytest.mark.parametrize("high", [1, 2, 30])
def test_collisions_are_the_generalised_jaccard_similarity(high):
    """Many pairs of weighted sets; the mean error of the estimate is near zero."""
    rng, errors = random.Random(high), []
    for _ in range(60):
        a, b = Counter(), Counter()
        for d in rng.sample(range(1 << 18), 40):
            shared = rng.randint(1, high)
            a[d] = shared if rng.random() < 0.8 else rng.randint(1, high)
            b[d] = shared if rng.random() < 0.8 else rng.randint(1, high)
            if rng.random() < 0.15:
                del a[d]
            elif rng.random() < 0.15:
                del b[d]
        errors.append(likeness_of(sign(a), sign(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.025
    assert np.abs(errors).max() < 5 * 0.5 / SAMPLES**0.5


def test_texts():
    text = b"one two three four five six seven eight nine ten " * 3
    assert fingerprint(text) == fingerprint(text) == fingerprint(b"  " + text.replace(b" ", b"\n"))
    assert fingerprint(None) == fingerprint(b" \n") == bytes(4 * SAMPLES)
    assert likeness_of(fingerprint(b"a"), fingerprint(b"")) == 0 and likeness_of(fingerprint(b"a b"), fingerprint(b"a b")) == 1
    rng = random.Random(0)
    words = [str(rng.randrange(10**6)).encode() for _ in range(40_000)]
    assert 0.4 < likeness_of(fingerprint(b" ".join(words)), fingerprint(b" ".join(words[:20_000]))) < 0.6


@pytest.mark.parametrize("n", [20_000, 100_000])
def test_long_texts_without_a_common_term_are_not_alike(n):
    """Neither with terms of weight 1 nor with repeated ones."""
    rng = random.Random(n)
    a, b = ([f"{c}{rng.randrange(10**9)}".encode() for _ in range(n)] for c in "ab")
    assert likeness_of(fingerprint(b" ".join(a)), fingerprint(b" ".join(b))) == 0
    assert likeness_of(fingerprint(b" ".join(a + a)), fingerprint(b" ".join(b + b))) == 0
    common = 0.5 * (n - 4) / (1.5 * n)  # half of the terms of each of two texts
    errors = []
    for k in range(3):
        x, y, z = a[: n // 2], a[n // 2 :], b[k : n // 2 + k]
        errors.append(likeness_of(fingerprint(b" ".join(x + y)), fingerprint(b" ".join(x + z))) - common)
    assert max(map(abs, errors)) < 0.25


def test_samples_against_brute_force():
    """The least a over all terms, by the formulas, one term and sample at a time."""
    rng = random.Random(2)
    weights = {rng.randrange(1 << 64): rng.choice([1, 1, 1, 2, 5]) for _ in range(300)}
    r, ln_c, b, _ = _pool()
    got = np.frombuffer(signature(np.array(list(weights), np.uint64), np.array(list(weights.values()))), "<u4")
    for sample in range(SAMPLES):
        best = None
        for term, w in weights.items():
            at = _triples(np.array([term], np.uint64))[0, sample]
            t = np.floor(np.log(np.float32(w)) / r[at] + b[at])
            best = min(best or (np.inf,), (float(ln_c[at] - r[at] * (t - b[at]) - r[at]), term, w))
        alone = signature(np.array([best[1]], np.uint64), np.array([best[2]]))
        assert got[sample] == np.frombuffer(alone, "<u4")[sample]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next(spark, parts):
    ids = [None, 5, -3, 2**62 + 1, 2**62, 9, 9, 14, *range(100, 160)]
    docs = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(ids)], "doc_id bigint, text string").repartition(4)
    got = with_next(docs, "doc_id", ["text"], parts).collect()
    assert len(got) == len(ids)
    follows = {r["text"]: r["next_text"] for r in got}
    chain, at = [], "t0"
    for _ in ids:
        chain.append(ids[int(at[1:])])
        at = follows[at]
    assert at == "t0" and chain == sorted(ids, key=lambda k: -(2**63) if k is None else k)


def test_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], "x", 1) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(1000, None, "", 0), (1001, "", "", 0), (1002, "ä€𝄞 " * 9, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in compared_with_edits(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, text, *_) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        a, b = fingerprint(text.encode()), fingerprint(edited.encode())
        r = got[i]
        assert (r["edited"], r["fingerprint"], r["edited_fingerprint"]) == (edited, a, b)
        assert (r["near_edited"], r["near_next"]) == (likeness_of(a, b), likeness_of(a, fingerprint(after.encode())))
    long = [r for r in got.values() if len(r["text"]) > 2000]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 and np.mean([r["near_next"] for r in long]) < 0.1


def test_one_and_none(spark):
    docs = spark.createDataFrame([(7, "a b c d e f g h", "", 0)], SCHEMA)
    (row,) = compared_with_edits(docs).collect()
    assert row["edited"] == "a b c d e f " + "a b" and row["near_next"] == 1
    assert compared_with_edits(docs.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, "a", "", 0), (None, None, "", 0)], SCHEMA)
    assert len(compared_with_edits(nulls).collect()) == 2
