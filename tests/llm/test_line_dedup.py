from __future__ import annotations

from collections import Counter

import pytest

from streakline.llm.line_dedup import drop_repeated_lines

SCHEMA = "doc_id bigint, text string, row int, key string, n_lines string"


def brute(texts, min_docs):
    def key(line):
        return line.encode().strip(b" \t\n\x0b\x0c\r").lower()

    seen = Counter()
    for t in texts:
        seen.update({key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


CASES = [
    None,
    "",
    "\n\n",
    " Share this \nown line",
    "share THIS\nÄrger\nshare this",
    "ärger\nSHARE this\t",
    "x" * 200_000 + "\nshare this",
    "ÄRGER\n\x0bfoot\x0c",
    "foot\nfoot\nfoot",
    "foot",
    "foot",
]


@pytest.mark.parametrize("bits", [1 << 20, 8])
def test_against_brute_force(spark, bits):
    """Eight bits a segment: both filters are full, and the result is the same."""
    docs = spark.createDataFrame([(i // 2, t, i, "k", "n") for i, t in enumerate(CASES)], SCHEMA).repartition(3)
    got = drop_repeated_lines(docs, min_docs=3, segments=2, once_bits=bits, twice_bits=bits)
    assert got.columns == ["doc_id", "text", "row", "key", "n_lines", "n_dropped", "kept"]
    assert sorted((r["row"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got.collect()) == [(i, *x) for i, x in enumerate(brute(CASES, 3))]


def test_empty_and_null_ids(spark):
    assert drop_repeated_lines(spark.createDataFrame([], SCHEMA), min_docs=2).collect() == []
    docs = spark.createDataFrame([(None, "a\nb", 0, None, None), (None, "A\nc", 1, None, None)], SCHEMA)
    assert sorted(r["kept"] for r in drop_repeated_lines(docs, min_docs=2).collect()) == ["b", "c"]
