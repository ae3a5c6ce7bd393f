"""Message segments, files of length-prefixed messages, as a batch and streaming data source.

A segment is a run of frames: four bytes of length, big-endian, and the message.
Segments are numbered in their names, read in that order, and only the last may
still grow. The source gives ``value`` (the message), ``segment`` and ``at`` (the
frame's place in it). An offset of a stream is a segment and a place between two
frames, so what lies between two offsets is the same messages at any time, and a
batch that is replayed after a restart has the same rows. ``maxBytesPerTrigger``
limits a micro-batch. Spark does not tell a source where a query goes on before it
asks for an end, so a limited source keeps a record of its newest batch in the
folder ``progress``, one for each query; without that folder the first batch
after a start takes all that is there. A query that drains what is available and
ends asks once, so it is not to be limited.

A frame whose length cannot be right, and what is behind it in the segment, is
one message, which the decoder will not read, so it ends among the dead letters.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from tracewright.sources.shared import Records, listed, place, remove

FORMAT = "framed"
SCHEMA = "value binary, segment string, at bigint"
#: A longer message is taken for a broken frame.
MOST = 1 << 28
_HEAD = struct.Struct(">i")
#: Bytes read from a segment at once, rows and bytes of a batch.
BLOCK, ROWS, BYTES = 1 << 20, 1000, 4 << 20


@dataclass(frozen=True)
class Range(InputPartition):
    """Bytes ``start`` to ``stop`` of a segment, both between frames."""

    segment: str
    start: int
    stop: int


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def segments(folder: str) -> list[tuple[str, int]]:
    """Names and sizes of the segments of a folder, in order."""
    system, path = place(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.base_name.startswith("segment-"))


def frames(folder: str, part: Range) -> Iterator[tuple[int, bytes]]:
    """Places and messages of a range, read block by block."""
    system, path = place(f"{folder}/{part.segment}")
    with system.open_input_file(path) as f:
        f.seek(part.start)
        at, held, used = part.start, b"", 0  # what was read from ``at`` on is held[used:]

        def filled(n: int) -> bool:
            nonlocal held, used
            if len(held) - used < n:
                held, used = held[used:], 0
            while len(held) - used < n and f.tell() < part.stop:
                more = f.read(min(max(BLOCK, n - len(held)), part.stop - f.tell()))
                if not more:
                    break
                held += more
            return len(held) - used >= n

        while at < part.stop:
            length = _HEAD.unpack_from(held, used)[0] if filled(_HEAD.size) else -1
            size = _HEAD.size + length
            if not 0 <= length <= MOST or at + size > part.stop or not filled(size):
                filled(part.stop - at)
                yield at, held[used:]
                return
            yield at, held[used + _HEAD.size : used + size]
            at, used = at + size, used + size


def whole_frames(folder: str, segment: str, start: int, size: int) -> int:
    """The end of the last whole frame from ``start`` on, in a segment that may still grow; a broken frame reaches to its end."""
    system, path = place(f"{folder}/{segment}")
    with system.open_input_file(path) as f:
        while start + _HEAD.size <= size:
            f.seek(start)
            length = _HEAD.unpack(f.read(_HEAD.size))[0]
            if not 0 <= length <= MOST:
                return size
            if start + _HEAD.size + length > size:
                break
            start += _HEAD.size + length
    return start


def _rows(folder: str, part: Range) -> Iterator[pa.RecordBatch]:
    names = ["value", "segment", "at"]

    def batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        columns = [pa.array([v for _, v in rows], pa.binary()), pa.array([part.segment] * len(rows), pa.string()), pa.array([a for a, _ in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    held, size = [], 0
    for row in frames(folder, part):
        held.append(row)
        size += len(row[1])
        if len(held) >= ROWS or size >= BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Range]:
        return [Range(name, 0, size) for name, size in segments(self.folder) if size]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.folder, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, limit: int | None, progress: str | None = None):
        self.folder, self.limit = folder, limit
        self.progress = Records(progress) if progress else None
        self.found: list[tuple[str, int]] = []  # segments as they were when last looked for
        self.last: dict | None = None  # the end of the newest batch, as far as this query has told
        if self.progress:
            known = listed(progress, ".json")
            self.last = self.progress.get(known[-1].removesuffix(".json")) if known else self.initialOffset()

    def initialOffset(self) -> dict:
        return {"segment": "", "at": 0}

    def latestOffset(self) -> dict:
        """Where the next batch ends; the folder is looked into only if it may go beyond the segments that are known to be whole."""
        last = self.last or {"segment": "", "at": 0}
        left = self.limit if self.last is not None else None
        known = sum(s for n, s in self.found[:-1] if n >= last["segment"]) - last["at"]
        if left is None or known < left:
            self.found = [(n, s) for n, s in segments(self.folder) if n >= last["segment"]]
        found = self.found = [(n, s) for n, s in self.found if n >= last["segment"]]
        end = last
        for i, (name, size) in enumerate(found):
            start = last["at"] if name == last["segment"] else 0
            stop = whole_frames(self.folder, name, start, size) if i == len(found) - 1 else size
            if left is not None and stop - start > left:
                stop = self._within(name, start, stop, left)
            end = {"segment": name, "at": stop}
            if left is not None:
                left -= stop - start
                if left <= 0 or stop < size:
                    break
        return end

    def _within(self, name: str, start: int, stop: int, left: int) -> int:
        """The end of the first frames that together reach ``left`` bytes; at least one frame."""
        for at, value in frames(self.folder, Range(name, start, stop)):
            if at + _HEAD.size + len(value) - start >= left:
                return min(stop, at + _HEAD.size + len(value))
        return stop

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.last = end
        if self.progress:
            name = f"{end['segment']}@{end['at']:020d}"
            self.progress.add(name, end)
            for old in listed(self.progress.uri, ".json"):
                if old < f"{name}.json":
                    remove(f"{self.progress.uri}/{old}")
        found = []
        # a replayed batch may begin or end elsewhere than in the segments that this reader has seen
        seen = {n for n, _ in self.found} >= {start["segment"], end["segment"]}
        for name, size in self.found if seen else segments(self.folder):
            if start["segment"] <= name <= end["segment"]:
                a = start["at"] if name == start["segment"] else 0
                b = end["at"] if name == end["segment"] else size
                if a < b:
                    found.append(Range(name, a, b))
        return found

    def commit(self, end: dict) -> None:
        """Segments stay: other queries may read them."""

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.folder, partition)


class _Writer(DataSourceArrowWriter):
    """Tasks write segments under hidden names; the driver numbers them when all are whole."""

    def __init__(self, folder: str, segment_bytes: int):
        self.folder, self.segment_bytes = folder, segment_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = place(self.folder)
        system.create_dir(path, recursive=True)
        task = TaskContext.get()
        files, out, size = [], None, 0
        for rows in iterator:
            for value in rows.column(rows.schema.get_field_index("value")).to_pylist():
                value = value or b""
                if out is None:
                    files.append(f".{task.partitionId() if task else 0:08d}-{uuid.uuid4().hex}")
                    out, size = system.open_output_stream(f"{path}/{files[-1]}"), 0
                out.write(_HEAD.pack(len(value)) + value)
                size += _HEAD.size + len(value)
                if size >= self.segment_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, path = place(self.folder)
        there = segments(self.folder)
        number = int(there[-1][0].rpartition("-")[2]) + 1 if there else 0
        for name in (f for m in messages if m is not None for f in m.files):
            system.move(f"{path}/{name}", f"{path}/segment-{number:012d}")
            number += 1

    def abort(self, messages) -> None:
        system, path = place(self.folder)
        for name in (f for m in messages if m is not None for f in m.files):
            system.delete_file(f"{path}/{name}")


class FramedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    @property
    def folder(self) -> str:
        return self.options["path"].rstrip("/")

    def reader(self, schema) -> _Reader:
        return _Reader(self.folder)

    def streamReader(self, schema) -> _StreamReader:
        limit = self.options.get("maxBytesPerTrigger")
        return _StreamReader(self.folder, int(limit) if limit else None, self.options.get("progress"))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.folder, int(self.options.get("segmentBytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    from tracewright.session import ship_package

    ship_package(spark)
    spark.dataSource.register(FramedSource)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).load(path)


def segment_stream(spark: SparkSession, path: str, max_bytes_per_trigger: int | None = None, progress: str | None = None) -> DataFrame:
    register(spark)
    options = {"maxBytesPerTrigger": max_bytes_per_trigger, "progress": progress}
    return spark.readStream.format(FORMAT).options(**{k: v for k, v in options.items() if v is not None}).load(path)


def write_segments(messages: DataFrame, path: str, segment_bytes: int = 64 << 20) -> None:
    """Appends the messages (``value``) of a table as new segments; a null message is an empty one."""
    register(messages.sparkSession)
    messages.select("value").write.format(FORMAT).mode("append").option("segmentBytes", segment_bytes).save(path)
