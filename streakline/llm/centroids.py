"""Centroid clustering of embeddings by scalar lookup tables.

Vectors become blocks of whole numbers: each dimension of a block keeps the values that occur in it, in order, and a
16-bit code per vector. A round tabulates, for each dimension, occurring value and centroid, the squared difference;
the distances of a block are then gathers from these tables and their sum. A block has at most ``BLOCK`` vectors and
therefore at most as many values a dimension, so a table's size does not depend on the input. A task sends one row per
centroid and dimension, and only the centroids meet on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm.common import prepare, stored

BLOCK = 4096
#: Components beyond this count as this, so that 64 squared differences fit a 64-bit integer.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``ints``, floor(scale * x) of each component, for vectors of ``dims`` finite components."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.least(F.greatest(F.floor(c.cast("double") * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("bigint"))
    return vectors.where((F.size(x) == dims) & finite).select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("ints"))


def _to_blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    ids, rows, waiting = [], [], 0
    for batch in batches:
        ids.append(batch.column(0))
        rows.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
        waiting += batch.num_rows
        if waiting >= BLOCK:
            all_ids, all_rows = pa.concat_arrays(ids), np.concatenate(rows)
            full = waiting // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                yield _block(all_ids.slice(at, BLOCK), all_rows[at : at + BLOCK])
            ids, rows, waiting = [all_ids.slice(full)], [all_rows[full:]], waiting - full
    if waiting:
        yield _block(pa.concat_arrays(ids), np.concatenate(rows))


def _block(ids: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
    values, codes, sizes = [], [], []
    for column in rows.T:
        occurring, code = np.unique(column, return_inverse=True)
        values.append(occurring)
        codes.append(code.astype(np.uint16))
        sizes.append(len(occurring))
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([np.concatenate(codes).tobytes()], pa.binary()),
            pa.array([np.concatenate(values).astype(np.int64).tobytes()], pa.binary()),
            pa.array([sizes], pa.list_(pa.int32())),
        ],
        names=["vec_ids", "codes", "values", "sizes"],
    )


class _Block:
    """A block as read back: ids, codes by dimension, occurring values by dimension."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.ids = batch.column("vec_ids")[row].values
        self.sizes = batch.column("sizes")[row].as_py()
        self.codes = np.frombuffer(batch.column("codes")[row].as_buffer(), np.uint16).reshape(len(self.sizes), -1)
        values = np.frombuffer(batch.column("values")[row].as_buffer(), np.int64)
        self.values = np.split(values, np.cumsum(self.sizes)[:-1])

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid (ties: the smaller) and its squared distance."""
        total = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        gathered = np.empty_like(total)
        for values, codes, centre in zip(self.values, self.codes, centroids.T, strict=True):
            table = (values[:, None] - centre) ** 2
            np.take(table, codes, axis=0, out=gathered, mode="clip")
            total += gathered
        number = total.argmin(axis=1)
        return number, total[np.arange(len(number)), number]

    def sums(self, number: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and component sums of each cluster. Doubles hold the sums of a block exactly."""
        member = np.zeros((k, len(number)))
        member[number, np.arange(len(number))] = 1
        rows = np.stack([values[codes] for values, codes in zip(self.values, self.codes, strict=True)], axis=1)
        return np.bincount(number, minlength=k), (member @ rows.astype(np.float64)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Block(batch, row)


def _summed(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per non-empty cluster and dimension for the whole task."""
    k, dims = centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for block in _blocks(batches):
        n, s = block.sums(block.nearest(centroids)[0], k)
        counts += n
        sums += s
    cluster, dim = np.divmod(np.flatnonzero(np.repeat(counts > 0, dims)), dims)
    columns = [cluster.astype(np.int32), dim.astype(np.int32), counts[cluster], sums[cluster, dim]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "n", "s"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        number, distance = block.nearest(centroids)
        yield pa.RecordBatch.from_arrays([block.ids, pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; at most k times dims rows reach the driver."""
    found = blocks.mapInArrow(lambda batches: _summed(batches, centroids), "cluster int, dim int, n bigint, s bigint")
    total = found.groupBy("cluster", "dim").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    moved = centroids.copy()
    for row in total.collect():
        moved[row["cluster"], row["dim"]] = int(row["s"]) // int(row["n"])
    return moved


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors of least sha256 of ``<prefix><vec_id>``; equal ids in order of their components."""
    seed = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    picked = vectors.select(seed.alias("seed"), "ints").orderBy("seed", "ints").limit(k).collect()
    return np.array([row["ints"] for row in picked], np.int64)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    prefix: str = "2:",
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid``, the final
    centroid's components, a row per vector of exactly ``dims`` components, none null or not finite; others are left out.

    Repeated rows count as often as they occur; a null id hashes as empty text. Fewer than ``k`` vectors are as many
    centroids, no vectors give no rows. Ties go to the smaller number. Components beyond +-2^27 after scaling count as
    that. A sum of distances that does not fit 64 bits is null. Other columns are ignored.
    """
    spark: SparkSession = vectors.sparkSession
    prepare(spark)
    whole = whole_vectors(vectors, vec_id, vector, dims, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, cluster int, distance bigint"
    centroids = first_centroids(whole, k, prefix)
    if not len(centroids):
        empty = spark.createDataFrame([], f"{out}, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
        return empty
    schema = f"vec_ids array<{kind}>, codes binary, values binary, sizes array<int>"
    blocks = stored(whole.mapInArrow(lambda batches: _to_blocks(batches, dims), schema), "vector_blocks")
    for _ in range(rounds):
        centroids = _moved(blocks, centroids)
    final = centroids
    assigned = stored(blocks.mapInArrow(lambda batches: _assigned(batches, final), out), "assigned")
    # At most k rows.
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    long = lambda n: n if n < 1 << 63 else None
    rows = [(c, long(d), long(sum(sums.values())), [int(x) for x in centroids[c]]) for c, d in sums.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_sha256(centroid: Column | str) -> Column:
    """Lower-case hex sha256 of the components as decimal integers joined by commas."""
    text = F.array_join((F.col(centroid) if isinstance(centroid, str) else centroid).cast("array<string>"), ",")
    return F.sha2(text.cast("binary"), 256)
