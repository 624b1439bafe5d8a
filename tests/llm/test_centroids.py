"""Clusters by lookup tables against the definition."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from streakline.llm import centroids

NAN, INF = float("nan"), float("inf")


def plain_clusters(vectors: list[tuple[int, list[int]]], k: int, rounds: int, prefix: str = "2:") -> list[tuple[int, int, int]]:
    """(vec_id, cluster, distance) by the definition, for tests on a few vectors."""
    seeds = sorted(vectors, key=lambda v: (hashlib.sha256(f"{prefix}{v[0]}".encode()).hexdigest(), v[1]))
    centres = [list(v) for _, v in seeds[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        members: dict[int, list[list[int]]] = {}
        for _, v in vectors:
            members.setdefault(nearest(v)[1], []).append(v)
        for i, rows in members.items():
            centres[i] = [sum(column) // len(rows) for column in zip(*rows, strict=True)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in vectors]


def _ints(v, scale=256):
    return [max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(scale * x))) for x in v]


def _frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>" + extra)


def _found(df):
    return sorted(tuple(r) for r in df.select("vec_id", "cluster", "distance").collect())


@pytest.mark.parametrize("block", [7, 4096])
@pytest.mark.parametrize("n, k, rounds", [(300, 12, 5), (40, 40, 3), (5, 40, 5), (60, 1, 2)])
def test_as_defined(spark, monkeypatch, block, n, k, rounds):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) / 3]) for i in range(n)]
    rows += rows[:20]  # repeated rows
    df = centroids.cluster(_frame(spark, rows).repartition(3), k=k, rounds=rounds, dims=6)
    assert _found(df) == sorted(plain_clusters([(i, _ints(v)) for i, v in rows], k, rounds))


def test_sums_and_centroids(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=3)]) for i in range(200)]
    df = centroids.cluster(_frame(spark, rows), k=5, rounds=4, dims=3).withColumn("sha", centroids.centroid_sha256("centroid")).collect()
    assert {r["inertia"] for r in df} == {sum(r["distance"] for r in df)}
    for c in {r["cluster"] for r in df}:
        of = [r for r in df if r["cluster"] == c]
        assert {r["cluster_inertia"] for r in of} == {sum(r["distance"] for r in of)}
        assert {r["sha"] for r in of} == {hashlib.sha256(",".join(map(str, of[0]["centroid"])).encode()).hexdigest()}
    vectors = dict(rows)
    for r in df:
        assert r["distance"] == sum((a - b) ** 2 for a, b in zip(_ints(vectors[r["vec_id"]]), r["centroid"], strict=True))


def test_unfit_vectors_are_left_out(spark):
    rows = [(1, [0.1, 0.2]), (2, None), (3, [0.1]), (4, [0.1, None]), (5, [NAN, 0.0]), (6, [INF, 0.0]), (None, [0.3, -0.2]), (8, []), (9, [1e300, -1e300])]
    found = centroids.cluster(_frame(spark, rows), k=40, rounds=5, dims=2).collect()
    assert sorted((r["vec_id"] or 0) for r in found) == [0, 1, 9]
    assert {r["distance"] for r in found} == {0}
    far = next(r for r in found if r["vec_id"] == 9)
    assert far["centroid"] == [centroids.LARGEST, -centroids.LARGEST]


def test_ties_and_equal_vectors(spark):
    rows = [(i, [0.5, 0.5]) for i in range(30)]
    assert {r["cluster"] for r in centroids.cluster(_frame(spark, rows), k=4, rounds=2, dims=2).collect()} == {0}


def test_empty_and_clashing_columns(spark):
    empty = centroids.cluster(_frame(spark, []), dims=2)
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    df = _frame(spark, [(1, [0.1, 0.2], "x", 3)], ", cluster string, distance int")
    assert _found(centroids.cluster(df, dims=2)) == [(1, 0, 0)]


def test_wide_values_and_text_ids(spark):
    """More different values than any table of all data could hold; ids of another type."""
    rng = np.random.default_rng(1)
    rows = [(f"v{i}", [float(x) for x in rng.normal(size=2) * 1e5]) for i in range(9000)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>").repartition(2)
    found = centroids.cluster(df, k=3, rounds=1, dims=2)
    assert found.count() == 9000
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in found.collect()}
    want = {i: (c, d) for i, c, d in plain_clusters([(i, _ints(v)) for i, v in rows], 3, 1)}
    assert got == want


def test_query_columns(spark, sf_dir):
    from streakline.llm.queries import QUERIES

    df = QUERIES["op11_centroids"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string",
    }
    assert df.where(F.length("centroid_sha256") != 64).count() == 0
