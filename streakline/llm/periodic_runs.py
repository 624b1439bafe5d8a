"""Periodic runs of words, by catching squares online over dyadic blocks.

Words become numbers and are appended in one sweep. At each level, words are cut into blocks of 2^level; a completed
block is a catcher for the words that come two to four block lengths after it. The suffix of a block's length that ends
at an appended word is compared, by hash, with the catchers in reach: a suffix that starts ``p`` words after a
catcher's block and equals it is the middle of a possible square of period ``p``. All suffixes of a level are compared
with their catchers as whole rows of a table, so the sweep costs a few vector operations per level.

Catchers that follow each other and report the same period report one stretch. A stretch long enough for the wanted
exponent is extended at both ends by the longest common extension, found by halving steps on prefix hashes, and
stretches merge into maximal runs; of equal stretches the smallest period is the run's. Each run is verified word by
word; if a hash has misled, the sweep is repeated with other multipliers.

Texts of an Arrow batch are swept together, with a number of its own after each text, which no run can cross. Memory
is a fixed number of 8-byte arrays over the words of a batch, whatever the number of levels.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, packed, prepare, unpacked

#: Texts are swept together up to this many words.
SWEEP = 200_000
#: Two primes below 2^31 for the prefix hashes.
PRIMES = (2_147_483_647, 2_147_483_629)
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


class _Prefixes:
    """Hashes of any stretch of ``words``, from prefix sums of powers modulo two primes."""

    def __init__(self, words: np.ndarray, rng: np.random.Generator):
        self.parts = []
        for prime in map(np.uint64, PRIMES):
            power = np.ones(len(words) + 1, np.uint64)
            factor, done = np.uint64(rng.integers(1 << 20, 1 << 30)), 1
            while done < len(power):  # powers of the first half times the half's own power
                step = min(done, len(power) - done)
                power[done : done + step] = power[:step] * factor % prime
                factor, done = factor * factor % prime, done + step
            # Sums stay below 2^63 for 2^31 words.
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((words.astype(np.uint64) + np.uint64(1)) * power[:-1] % prime, dtype=np.uint64)]) % prime
            self.parts.append((prime, power, sums))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from ``a`` on equal those from ``b`` >= ``a`` on, for ``length`` words."""
        same = np.ones(len(a), bool)
        for prime, power, sums in self.parts:
            left = (sums[a + length] + prime - sums[a]) % prime * power[b - a] % prime
            same &= left == (sums[b + length] + prime - sums[b]) % prime
        return same

    def extension(self, a: np.ndarray, b: np.ndarray, most: int, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (or before them) agree, if fewer than ``most``."""
        n = len(self.parts[0][2]) - 1
        found = np.zeros(len(a), np.int64)
        step = 1 << max(0, most - 1).bit_length()
        while step := step >> 1:
            ahead = found + step
            inside = np.flatnonzero(a >= ahead if back else b + ahead <= n)
            shift = -ahead[inside] if back else found[inside]
            same = self.equal(a[inside] + shift, b[inside] + shift, np.full(len(inside), step))
            found[inside[same]] += step
        return found


def _stretches(words: np.ndarray, exponent: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the maximal stretches that squares and their catchers report, sorted, the smallest
    period of equal stretches first. Every run of the exponent or more is among them."""
    found, prefixes, hashes, level = [], None, words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 0
    while (block := 1 << level) * 2 * exponent <= max(len(words), 2 * exponent):
        if level:
            half = block >> 1
            factor = np.uint64(rng.integers(1 << 62) * 2 + 1)
            hashes = hashes[:-half] * factor + hashes[half:]
            hashes ^= hashes >> np.uint64(31)
        # Rows of the table are blocks, columns the suffixes that start in them.
        rows = len(hashes) // block + (len(hashes) % block > 0)
        table = np.zeros(rows * block, np.uint64)
        table[: len(hashes)] = hashes
        table, inside = table.reshape(rows, block), len(hashes)
        catchers = table[:, 0]
        # Period p = gap * block + column; at the lowest level also period 1.
        for gap in (1, 2, 3) if block == 1 else (2, 3):
            # A run's stretch of agreeing words holds at least this many whole blocks.
            least = max(1, (exponent - 1) * gap - 1)
            if rows - gap < least:
                continue
            caught = table[gap:] == catchers[:-gap, None]
            enough = caught[least - 1 :].copy()
            for k in range(1, least):
                enough &= caught[least - 1 - k : len(caught) - k]
            if not enough.any():
                continue
            columns = np.flatnonzero(enough.any(axis=0))
            # Of each stretch of agreeing blocks, the first and the last one.
            agree = np.zeros((len(caught) + 2, len(columns)), bool)
            agree[1:-1] = caught[:, columns]
            agree[1:-1] &= ((np.arange(len(caught)) + gap)[:, None] * block + columns) < inside
            turns = agree[1:] != agree[:-1]
            column, row = np.nonzero(turns.T)
            first, past = row[0::2], row[1::2]
            column = columns[column[0::2]]
            long = past - first >= least
            first, past, period = first[long], past[long], gap * block + column[long]
            if not len(first):
                continue
            prefixes = prefixes or _Prefixes(words, rng)
            start, end = first * block, past * block
            start = start - prefixes.extension(start, start + period, block, back=True)
            end = end + period + prefixes.extension(end, end + period, block, back=False)
            found.append(np.stack([start, end, period]))
        level += 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    return start[order], end[order], period[order]


def _verified(words: np.ndarray, start: int, end: int, period: int) -> bool:
    left, right = words[start : end - period], words[start + period : end]
    before = start == 0 or words[start - 1] != words[start - 1 + period]
    after = end == len(words) or words[end] != words[end - period]
    return before and after and bool((left == right).all())


def find_runs(words: np.ndarray, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal runs of at least ``least`` words and ``exponent`` times their smallest
    period, by start, then period. ``words`` are whole numbers from 0 on."""
    if exponent < 2:
        raise ValueError("a run has an exponent of at least 2")
    for seed in count():
        start, end, period = _stretches(words, exponent, np.random.default_rng(seed))
        fresh = np.ones(len(start), bool)
        fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        fresh &= (end - start >= exponent * period) & (end - start >= least)
        runs = [(int(s), int(e), int(p)) for s, e, p in zip(start[fresh], end[fresh], period[fresh], strict=True)]
        if all(_verified(words, *run) for run in runs):
            return sorted(runs, key=lambda run: (run[0], run[2]))


def _sweep(texts: list[list[bytes]], exponent: int, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, in words of the text."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts, starts, at = [], [], 0
    for i, words in enumerate(texts):
        part = [numbers[w] for w in words]
        part.append(-1 - i)  # set apart below
        parts.append(np.array(part, np.int64))
        starts.append(at)
        at += len(part)
    joined = np.concatenate(parts)
    joined = np.where(joined < 0, len(numbers) - 1 - joined, joined)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in find_runs(joined, exponent, least):
        text = int(np.searchsorted(starts, start, side="right")) - 1
        found[text].append((start - starts[text], end - starts[text], period))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, end, period in runs:
        kept[start + period : end] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _rows(batches: Iterator[pa.RecordBatch], exponent: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        waiting, size, first = [], 0, 0
        texts = batch.column("text")
        for i in range(batch.num_rows):
            words = (texts[i].as_py() or b"").split()
            waiting.append(words)
            size += len(words) + 1
            if size >= SWEEP or i == batch.num_rows - 1:
                yield _found(batch.slice(first, len(waiting)), waiting, exponent, least)
                waiting, size, first = [], 0, i + 1


def _found(batch: pa.RecordBatch, texts: list[list[bytes]], exponent: int, least: int) -> pa.RecordBatch:
    runs = _sweep(texts, exponent, least)
    fields = {"start": 0, "length": 1, "period": 2}
    lists = pa.array([[{"start": s, "length": e - s, "period": p} for s, e, p in r] for r in runs], pa.list_(pa.struct([(f, pa.int64()) for f in fields])))
    rest = pa.array([b" ".join(collapsed(t, r)) for t, r in zip(texts, runs, strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column(ORIGINAL), lists, rest], names=[ORIGINAL, "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", exponent: int = 4, least: int = 6, keep: list[str] | None = None) -> DataFrame:
    """The documents' columns (those of ``keep``, if given), ``runs`` (start, length and period of every maximal run, by start, then period) and
    ``collapsed`` (the words no run contains after its first period, joined by one space).

    Words are maximal stretches of bytes other than space and U+0009 to U+000D. A null or empty text, or one of white
    space alone, has no runs and an empty ``collapsed``. Repeated rows are read each on their own. Columns of the same
    names are replaced.
    """
    prepare(docs.sparkSession)
    columns = docs.columns if keep is None else keep
    rows = docs.select(packed(docs.select(*[F.col(f"`{c}`") for c in columns])), F.col(f"`{text}`").cast("binary").alias("text"))
    original = rows.schema[ORIGINAL].dataType.simpleString()
    found = rows.mapInArrow(lambda batches: _rows(batches, exponent, least), f"{ORIGINAL} {original}, runs {RUN}, collapsed binary")
    return unpacked(found, columns, runs=F.col("runs"), collapsed=F.col("collapsed").cast("string"))


def longest(runs: Column | str) -> Column:
    """The run of greatest length; ties: the smallest start, then period. Null without a run."""
    column = F.col(runs) if isinstance(runs, str) else runs
    return F.array_min(F.transform(column, lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))


def run_lines(runs: Column | str) -> Column:
    """``start,length,period`` and a line feed for every run."""
    column = F.col(runs) if isinstance(runs, str) else runs
    return F.array_join(F.transform(column, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_repeated_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, where every tenth one (by the crc32 of its decimal id) repeats a stretch of its words to the end:
    each word i >= a becomes word a + (i - a) % p, with a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), g = floor(crc32 / 10).
    A null id or text, or a text without words, stays as it is."""
    words = F.array_remove(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    row = docs.select(packed(docs), F.col(f"`{text}`").alias("text"), F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    row = row.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, a))
    row = row.withColumn("p", F.when(F.col("n") > 0, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    edited = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("words"), at(i))), " ")
    return unpacked(row, docs.columns, **{text: F.when(F.col("n") > 0, edited).otherwise(F.col("text"))})
