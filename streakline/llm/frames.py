"""Token ids in files of independent zstandard frames with a seek table.

A file is a run of frames, each a fixed number of raw bytes (the last one less) of little-endian unsigned 32-bit ids,
then two skippable frames. The first is the index of the documents: for each an id, a flag for a null id and its
number of ids, then the number of documents. The second is the seek table of the public seekable format: compressed
size, raw size and checksum (the low half of XXH64 over the raw bytes) of each frame, the number of frames, a
descriptor and a magic number. A document may span frames; a reader fetches the tail, then only the frames it needs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm.common import partitions, prepare, stored
from streakline.llm.tokens import word_encoder
from streakline.session import scratch_path

FRAME = 1 << 20
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])
SEEK = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("checksum", "<u4")])


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FrameWriter:
    """Appends documents to an output stream; holds one frame and a few bytes per document."""

    def __init__(self, stream, frame: int = FRAME, level: int = 3):
        if frame % 4:
            raise ValueError("a frame holds whole ids")
        self._out, self._frame, self._pending = stream, frame, bytearray()
        self._compressor = zstandard.ZstdCompressor(level=level)
        self._index: list[tuple[int, int, int]] = []
        self._table: list[tuple[int, int, int]] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._index.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.ids += len(ids) // 4
        view = memoryview(ids)
        while len(self._pending) + len(view) >= self._frame:
            room = self._frame - len(self._pending)
            self._pending += view[:room]
            view = view[room:]
            self._flush()
        self._pending += view

    def _flush(self) -> None:
        raw = bytes(self._pending)
        data = self._compressor.compress(raw)
        self._out.write(data)
        self._table.append((len(data), len(raw), _checksum(raw)))
        self._pending.clear()

    def finish(self) -> None:
        if self._pending:
            self._flush()
        index = np.array(self._index, ENTRY).tobytes() + struct.pack("<Q", len(self._index))
        self._out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self._table, SEEK).tobytes() + struct.pack("<IBI", len(self._table), CHECKSUMS, FOOTER_MAGIC)
        self._out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents from a file that can seek. ``frames_read`` counts the frames decompressed."""

    def __init__(self, file):
        self._file, self.frames_read, self._last = file, 0, (-1, b"")
        size = file.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or not descriptor & CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        begin = size - 9 - frames * SEEK.itemsize
        self._table = np.frombuffer(self._at(begin, frames * SEEK.itemsize), SEEK)
        begin -= 8
        (docs,) = struct.unpack("<Q", self._at(begin - 8, 8))
        begin -= 8 + docs * ENTRY.itemsize
        self.index = np.frombuffer(self._at(begin, docs * ENTRY.itemsize), ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.index["n"].astype(np.int64))])
        self._places = np.concatenate([[0], np.cumsum(self._table["packed"].astype(np.int64))])
        self._raw = np.concatenate([[0], np.cumsum(self._table["raw"].astype(np.int64))])

    def _at(self, place: int, size: int) -> bytes:
        self._file.seek(int(place))
        return self._file.read(int(size))

    def doc_id(self, k: int) -> int | None:
        return None if self.index["null"][k] else int(self.index["id"][k])

    def _load(self, frame: int) -> bytes:
        if self._last[0] != frame:
            size = int(self._table["raw"][frame])
            raw = zstandard.ZstdDecompressor().decompress(self._at(self._places[frame], self._table["packed"][frame]), max_output_size=size)
            if len(raw) != size or _checksum(raw) != int(self._table["checksum"][frame]):
                raise ValueError(f"frame {frame} does not match its checksum")
            self.frames_read += 1
            self._last = frame, raw
        return self._last[1]

    def blocks(self, k: int) -> Iterator[bytes]:
        """The ids of the k-th document, frame by frame."""
        begin, end = 4 * int(self.starts[k]), 4 * int(self.starts[k + 1])
        frame = int(np.searchsorted(self._raw, begin, "right")) - 1
        while begin < end:
            raw, base = self._load(frame), int(self._raw[frame])
            part = raw[begin - base : end - base]
            yield part
            begin += len(part)
            frame += 1

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.blocks(k)), "<u4")

    def find(self, doc_id: int) -> list[int]:
        return np.flatnonzero((self.index["id"] == doc_id) & (self.index["null"] == 0)).tolist()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as executors need it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _write(folder: str, end: int | None, tokenizer: str | None, frame: int):
    tail = b"" if end is None else struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder = TaskContext.get(), word_encoder(tokenizer)
        number = task.partitionId()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"part-{number:06d}.ids"
        attempt = f"{root}/.{name}.{task.taskAttemptId()}"
        docs = 0
        with system.open_output_stream(attempt, compression=None) as stream:
            writer = FrameWriter(stream, frame)
            for rows, texts in encoder.encode_rows(batches):
                for doc, ids in zip(rows, texts, strict=True):
                    writer.add(doc, ids + tail)
                    docs += 1
            writer.finish()
        # The whole file takes its name at once; the same content may be there from a lost attempt.
        if system.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
            system.delete_file(f"{root}/{name}")
        system.move(attempt, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([docs], pa.int64()), pa.array([writer.ids], pa.int64())],
            ["number", "file", "docs", "ids"],
        )

    return run


def write_ids(
    docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", end: int | None = 1, tokenizer: str | None = None, frame: int = FRAME
) -> DataFrame:
    """Encodes the texts and writes one file per range of ids, in ascending order of the id (nulls first, equal ids by
    a hash of the text). Returns the files: ``number``, ``file``, ``docs``, ``ids``. A null or empty text has the end
    id only. ``folder`` is a location all executors reach."""
    spark = docs.sparkSession
    prepare(spark)
    place = qualified(spark, folder)
    keyed = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange(partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return stored(ordered.mapInArrow(_write(place, end, tokenizer, frame), "number int, file string, docs bigint, ids bigint"), "files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, path = fs.FileSystem.from_uri(file)
            with system.open_input_file(path) as handle:
                reader = FrameReader(handle)
                for begin in range(0, len(reader.index), 4096):
                    rows = []
                    for k in range(begin, min(begin + 4096, len(reader.index))):
                        crc = 0
                        for block in reader.blocks(k):
                            crc = zlib.crc32(block, crc)
                        rows.append((reader.doc_id(k), before + int(reader.starts[k]), int(reader.index["n"][k]), crc))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def read_digests(files: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    The driver holds one number per file; each file is read by one task, frame by frame."""
    spark = files.sparkSession
    prepare(spark)
    rows, before = [], 0
    for r in files.orderBy("number").collect():
        rows.append((r["file"], before))
        before += r["ids"]
    if not rows:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    table = spark.createDataFrame(rows, "file string, before bigint").repartition(len(rows))
    return table.mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def written_and_read(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", end: int | None = 1, tokenizer: str | None = None) -> DataFrame:
    """The digests of files in a fresh scratch folder."""
    return read_digests(write_ids(docs, scratch_path(docs.sparkSession, "ids"), text, doc_id, end, tokenizer))
