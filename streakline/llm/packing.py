"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces are dealt at random to pools of a bounded size. Each pool is packed by several islands, each a task of its own
with a population of packings. A child takes over whole well-filled bins of one parent, loses the other parent's bins
that share a piece with them, and best-fits the displaced pieces. After an epoch an island's best packings move on to
the next island of the pool. A pool is finished when a packing needs as few bins as the lower bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import prepare, stored
from streakline.llm.tokens import word_encoder


@dataclass(frozen=True)
class PackParams:
    """A pool has about ``pool`` pieces; pieces of different pools never meet in a bin, which costs at most a part of
    one bin for each pool beyond its optimum."""

    capacity: int = 2048
    pool: int = 16_384
    islands: int = 2
    epochs: int = 2
    generations: int = 12
    population: int = 6
    elite: int = 2


PIECES = "n bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(capacity: int, end: int, path: str | None):
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, encoder = TaskContext.get().partitionId() << 40, word_encoder(path)
        for docs, texts in encoder.encode_rows(batches):
            columns = [[] for _ in range(6)]
            for doc, ids in zip(docs, texts, strict=True):
                ids += tail
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(columns, (number, doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
                    number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(columns)], ["n", "doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 2048, end: int = 0, tokenizer: str | None = None) -> DataFrame:
    """The documents' token ids and an end id, cut every ``capacity`` ids: ``n`` (a number of the piece), ``doc_id``,
    ``piece`` from 0, ``start``, ``length``, ``ids_crc32``. A null or empty text is one piece of the end id."""
    prepare(docs.sparkSession)
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(
        _cut(capacity, end, tokenizer), PIECES
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: pieces over half a bin stand alone, small ones fill what these leave."""
    ordered = np.sort(lengths)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    half = int(np.searchsorted(ordered, capacity // 2, "right"))
    best = max(-(-int(sums[-1]) // capacity), len(ordered) - half)
    for alpha in np.unique(ordered[:half]).tolist():
        alone = int(np.searchsorted(ordered, capacity - alpha, "right"))
        small = int(np.searchsorted(ordered, alpha, "left"))
        room = (alone - half) * capacity - int(sums[alone] - sums[half])
        best = max(best, len(ordered) - half + max(0, -(-(int(sums[half] - sums[small]) - room) // capacity)))
    return best


class Packing:
    """``place``: the bin of each piece; ``free``: the room of each bin."""

    def __init__(self, place: np.ndarray, free: list[int]):
        self.place, self.free = place, free

    def score(self, capacity: int) -> tuple[int, int]:
        """Fewer bins are better, then fuller ones."""
        return len(self.free), -sum((capacity - f) ** 2 for f in self.free)


def best_fit(order: list[int], lengths: list[int], capacity: int, packing: Packing) -> Packing:
    """Puts each piece into the bin with the least room that holds it, or into a new one. The bits of ``rooms`` tell
    which amounts of room occur."""
    place, free, rooms, at = packing.place, packing.free, 0, {}
    for b, room in enumerate(free):
        at.setdefault(room, []).append(b)
        rooms |= 1 << room
    for i in order:
        need = lengths[i]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = at[room].pop()
            if not at[room]:
                del at[room]
                rooms ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        place[i] = b
        left = free[b] = room - need
        at.setdefault(left, []).append(b)
        rooms |= 1 << left
    return packing


def crossover(a: Packing, b: Packing, lengths: list[int], sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> Packing:
    """Some of the fuller bins of ``b`` whole; of ``a`` the bins without a piece of these; the rest by best fit."""
    fullest = np.argsort(np.array(b.free), kind="stable")[: max(1, len(b.free) // 2)]
    chosen = np.zeros(len(b.free), bool)
    chosen[rng.choice(fullest, max(1, int(len(fullest) * rng.uniform(0.1, 0.9))), replace=False)] = True
    injected = chosen[b.place]
    left = np.ones(len(a.free), bool)
    left[a.place[injected]] = False
    if rng.random() < 0.5:  # also open a few of the emptiest bins
        left[np.argsort(np.array(a.free), kind="stable")[-max(1, len(a.free) // 50) :]] = False
    stay = left[a.place] & ~injected
    number_a, number_b = np.cumsum(left) - 1, np.cumsum(chosen) - 1 + int(left.sum())
    place = np.full(len(a.place), -1, np.int32)
    place[stay] = number_a[a.place[stay]]
    place[injected] = number_b[b.place[injected]]
    free = np.concatenate([np.array(a.free)[left], np.array(b.free)[chosen]]).tolist()
    displaced = np.flatnonzero(place < 0)
    return best_fit(displaced[np.argsort(-sizes[displaced], kind="stable")].tolist(), lengths, capacity, Packing(place, free))


def evolve(sizes: np.ndarray, start: list[np.ndarray], params: PackParams, seed: int) -> list[Packing]:
    """The island's packings after an epoch, best first."""
    capacity, lengths, rng = params.capacity, sizes.tolist(), np.random.default_rng(seed)
    bound, n = lower_bound(sizes, capacity), len(sizes)
    crowd = []
    for place in {p.tobytes(): p for p in start}.values():
        used = np.bincount(place, weights=sizes).astype(np.int64)
        crowd.append(Packing(place.astype(np.int32), (capacity - used).tolist()))
    first = not crowd
    while len(crowd) < params.population and not (crowd and first and len(crowd[0].free) == bound):
        noise = 1.0 if not crowd else rng.uniform(0.7, 1.3, n)
        crowd.append(best_fit(np.argsort(-sizes * noise, kind="stable").tolist(), lengths, capacity, Packing(np.full(n, -1, np.int32), [])))
    crowd.sort(key=lambda x: x.score(capacity))
    for _ in range(params.generations * params.population):
        if len(crowd[0].free) == bound:
            break
        i, j = rng.choice(len(crowd), 2, replace=False)
        child = crossover(crowd[min(i, j)], crowd[max(i, j)], lengths, sizes, capacity, rng)
        if child.score(capacity) < crowd[-1].score(capacity) and all(child.score(capacity) != x.score(capacity) for x in crowd):
            crowd[-1] = child
            crowd.sort(key=lambda x: x.score(capacity))
    return crowd[: params.population]


GENOMES = "pool bigint, island int, genome binary"


def _epoch(params: PackParams, epoch: int):
    def run(items: pa.Table, genomes: pa.Table) -> pa.Table:
        out: list[tuple[int, int, bytes]] = []
        if items.num_rows:
            items = items.sort_by("n")
            pool, island = items["pool"][0].as_py(), items["island"][0].as_py()
            start = [np.frombuffer(g, np.int32) for g in genomes["genome"].to_pylist()]
            crowd = evolve(items["length"].to_numpy(), start, params, seed=pool * 1009 + island * 31 + epoch)
            for k, packing in enumerate(crowd):
                genome = packing.place.tobytes()
                out.append((pool, island, genome))
                if k < params.elite and params.islands > 1:
                    out.append((pool, (island + 1) % params.islands, genome))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.binary())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("pool", "island", "genome"), columns, kinds, strict=True)})

    return run


def _finish(params: PackParams):
    def run(items: pa.Table, genomes: pa.Table) -> pa.Table:
        items = items.sort_by("n")
        sizes = items["length"].to_numpy()
        if not len(sizes):
            none = pa.array([], pa.int64())
            return pa.table({"n": none, "sequence_id": none, "offset": none})
        best = None
        for genome in genomes["genome"].to_pylist():
            place = np.frombuffer(genome, np.int32)
            used = np.bincount(place, weights=sizes).astype(np.int64)
            score = (len(used), -int((used * used).sum()), genome)
            best = score if best is None or score < best else best
        place = np.frombuffer(best[2], np.int32)
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(sizes[order])
        begins = ends - sizes[order]
        first = np.concatenate([[True], place[order][1:] != place[order][:-1]])
        offset = np.empty(len(sizes), np.int64)
        offset[order] = begins - np.maximum.accumulate(np.where(first, begins, 0))
        sequence = (items["pool"].to_numpy() << 32) + place
        return pa.table({"n": items["n"], "sequence_id": pa.array(sequence.astype(np.int64)), "offset": pa.array(offset)})

    return run


def pack(items: DataFrame, params: PackParams | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a unique ``n`` and a ``length`` from 1 to the capacity.

    Bins are gapless from 0. ``items`` is read several times; give a stored table. The pools follow a hash of ``n``, so
    no key gathers rows; an island holds the lengths of one pool and a few packings of it, whatever the input."""
    params = params or PackParams()
    prepare(items.sparkSession)
    pools = max(1, round(items.count() / params.pool))
    pool = F.pmod(F.xxhash64("n"), F.lit(pools))
    slim = items.select("n", "length", pool.alias("pool"))
    spread = slim.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(params.islands)])))
    genomes = items.sparkSession.createDataFrame([], GENOMES)
    for epoch in range(params.epochs):
        genomes = spread.groupBy("pool", "island").cogroup(genomes.groupBy("pool", "island")).applyInArrow(_epoch(params, epoch), GENOMES)
    placed = slim.groupBy("pool").cogroup(genomes.groupBy("pool")).applyInArrow(_finish(params), "n bigint, sequence_id bigint, offset bigint")
    return items.join(placed, "n")


def packed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", params: PackParams | None = None, end: int = 0, tokenizer: str | None = None) -> DataFrame:
    """A row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Only texts of more ids than the capacity (end id included) are cut. A null or empty text is its end id alone;
    repeated rows are packed as often as they occur, a null id stays null."""
    params = params or PackParams()
    table = stored(pieces(docs, text, doc_id, params.capacity, end, tokenizer), "pieces")
    return pack(table, params).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
