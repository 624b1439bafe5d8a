from __future__ import annotations

import hashlib
import random

import pytest

from streakline.llm import suffix_dedup
from streakline.llm.suffix_dedup import cover_for, difference_cover, digests, drop_repeated_strings

SCHEMA = "doc_id bigint, text string, kept string, id int, sha256 string"


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for i, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            seen.setdefault(raw[p : p + length], []).append((i, p))
    covered = [bytearray(len(r)) for r in raws]
    for where in seen.values():
        if len(where) > 1:
            for i, p in where:
                covered[i][p : p + length] = b"\1" * length
    out = []
    for raw, c in zip(raws, covered, strict=True):
        kept = bytes(b for b, x in zip(raw, c, strict=True) if not x)
        runs = sum(1 for i, x in enumerate(c) if x and (i == 0 or not c[i - 1]))
        out.append((len(raw), sum(c), runs, kept))
    return out


@pytest.mark.parametrize("r", range(5))
def test_cover(r):
    v, cover = difference_cover(r)
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_choice_of_cover():
    for length in (26, 40, 100, 400, 1000):
        v, _ = cover_for(length)
        assert length // 2 <= length - v + 1


def corpus(seed, n=60):
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(k))

    passages = [noise(k) for k in (25, 26, 27, 30, 44, 60, 300)]
    texts = [None, "", "a" * 25, "a" * 26, "b" * 27, "xy" * 40, noise(26)]
    for _ in range(n):
        text = noise(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(passages) + noise(rng.randint(0, 40))
        texts.append(text)
    texts += [texts[20], texts[20], passages[-1], passages[1], passages[0], passages[0]]
    return texts


@pytest.mark.parametrize(("length", "seed", "flush"), [(26, 1, 1 << 20), (26, 2, 50), (60, 3, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, length, seed, flush):
    monkeypatch.setattr(suffix_dedup, "FLUSH", flush)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i // 2, t, "", i, "") for i, t in enumerate(texts)], SCHEMA).repartition(5)
    got = drop_repeated_strings(docs, length=length)
    assert got.columns == ["doc_id", "text", "id", "sha256", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    rows = sorted((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), r["kept_sha256"]) for r in got.collect())
    expected = brute(texts, length)
    assert rows == [(i, *x, hashlib.sha256(x[3]).hexdigest()) for i, x in enumerate(expected)]
    assert sum(x[1] for x in expected) > 0


def test_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = rows[:120] + [(1000, "long " * 40_000), (1001, None)]
    docs = spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in digests(docs).collect())
    expected = brute([t for _, t in rows[:-2]], 400)
    whole = "long " * 40_000
    assert got[-2:] == [(1000, len(whole), len(whole), 1, hashlib.sha256(b"").hexdigest()), (1001, 0, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert got[:-2] == [(rows[i][0], *x[:3], hashlib.sha256(x[3]).hexdigest()) for i, x in enumerate(expected)]


def test_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert digests(docs).collect() == []
    assert [tuple(r)[1:4] for r in digests(spark.createDataFrame([(None, "short", "", 0, "")], SCHEMA)).collect()] == [(5, 0, 0)]
