from __future__ import annotations

import random

import pytest
import xxhash

from streakline.llm.simhash import classes, fingerprint, fingerprint_hex, keep_one, links
from streakline.llm.components import components

SCHEMA = "doc_id bigint, text string, fp string, root int, row int"


def brute_fingerprint(text, k=3):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(ids, fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    members = {}
    for i in range(len(fps)):
        members.setdefault(find(i), []).append(ids[i])
    return [min(members[find(i)]) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "Ä b c d\x0be f  g h i " * 50, "z " * 70_000])
def test_fingerprint(text):
    assert fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def flipped(rng, x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("hot", [128, 2, 0])
def test_links_have_the_components_of_all_pairs(spark, hot):
    """With ``hot`` low, the same links come from the points between."""
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        chain = [x]
        for _ in range(9):
            chain.append(flipped(rng, rng.choice(chain), rng.randint(1, 4)))
        fps.update(chain)
    center = rng.getrandbits(64)
    fps.update(flipped(rng, center, rng.randint(0, 5)) for _ in range(60))
    fps = sorted(fps)
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    found = links(table, hot=hot)
    assert all((((r["a"] ^ r["b"]) & (1 << 64) - 1)).bit_count() <= 3 for r in found.collect())
    roots = {r["node"]: r["root"] for r in components(found).collect()}
    got = [roots.get(signed(f), signed(f)) for f in fps]
    assert got == brute_classes([signed(f) for f in fps], fps)


def test_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(1000, None), (1001, ""), (1001, ""), (1002, rows[3][1].upper())]
    docs = spark.createDataFrame([(*r, "x", 1, i) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    fps = [brute_fingerprint(t) for _, t in rows]
    expected = sorted(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], brute_classes([i for i, _ in rows], fps), strict=True))
    found = classes(docs)
    assert sorted(tuple(r) for r in found.select("doc_id", fingerprint_hex("fp"), "component_id").collect()) == expected
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in expected})


def test_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "one two three four", "", 1, 1), (None, "quite another text here", "", 1, 1), (None, "", "", 1, 1)], SCHEMA)
    assert keep_one(docs).count() == 3
    assert [r["component_id"] for r in classes(docs).collect()] == [None] * 3
    assert classes(docs.limit(0)).collect() == []


def test_chain_of_links(spark):
    """A long chain and a hub end in one component each."""
    table = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1500)] + [(7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(table).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1500)}
