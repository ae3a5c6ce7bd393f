"""Token ids in Simple-8b word-aligned files.

A 64-bit word holds a 4-bit selector and 60 bits of payload: the selector tells
how many ids share the word and at what width. Runs of zeros have selectors
without payload. An id of 60 bits or more is an escape: the word of selector 15
with payload 2**60 - 1 is followed by one word with the id itself.

File layout (little-endian), built for vectorised decoding:

====================  =========================================================
``S8B1`` + version    8 bytes
n_docs, n_ids,        four 64-bit numbers
n_blocks, n_words
doc ids               n_docs x int64 (null id: the smallest int64)
doc ends              n_docs x uint64: ids up to and with this document
block offsets         n_blocks x uint64: first word of each block
words                 n_words x uint64
crc32                 4 bytes over everything before
====================  =========================================================

Every block but the last holds ``BLOCK`` ids, so id i is in block i // BLOCK and
all blocks are decoded side by side. One Spark task writes one file: documents
are range-partitioned by id, so file order is id order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import NULL_KEY, shuffle_width
from tracewright.llm.shared_files import open_input, write_atomically
from tracewright.llm.tokens import tokenizer, tokenizer_path
from tracewright.session import scratch_path

#: Ids of a block.
BLOCK = 1024
#: (ids in a word, bits of each) by selector (fixed values of the format).
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
_ESCAPE = np.uint64((15 << 60) | ((1 << 60) - 1))
_HEAD = struct.Struct("<8sQQQQ")
_MAGIC = b"S8B1\x01\x00\x00\x00"


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words, block offsets`` of the ids. Each step fills one word of every unfinished block."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    choice = _choices(ids)
    counts = np.array([c for c, _ in SELECTORS] + [1])
    at = np.arange(0, n, BLOCK)
    stop = np.minimum(at + BLOCK, n)
    begins = np.zeros(n, dtype=bool)
    cursor, stop_live = at.copy(), stop
    while cursor.size:
        begins[cursor] = True
        cursor = cursor + counts[choice[cursor]]
        live = cursor < stop_live
        cursor, stop_live = cursor[live], stop_live[live]
    first = np.flatnonzero(begins)
    kind = choice[first]
    words = np.zeros(len(first), dtype=np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        rows = np.flatnonzero(kind == s)
        if not rows.size:
            continue
        word = np.full(len(rows), np.uint64(s) << np.uint64(60))
        if bits:
            for k in range(count):
                word |= ids[first[rows] + k].astype(np.uint64) << np.uint64(k * bits)
        words[rows] = word
    escaped = kind == 16
    width = 1 + escaped.astype(np.int64)
    place = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), dtype=np.uint64)
    out[place] = np.where(escaped, _ESCAPE, words)
    out[place[escaped] + 1] = ids[first[escaped]]
    return out, place[np.searchsorted(first, at)].astype(np.uint64)


def _choices(ids: np.ndarray) -> np.ndarray:
    """For each position the selector whose word may start there: the most ids that fit and stay in the block (16: escape)."""
    n = len(ids)
    left = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), -(-n // BLOCK))[:n]  # ids left in the block
    rest = n - (n - 1) // BLOCK * BLOCK
    left[n - rest :] = np.arange(rest, 0, -1)
    best = np.full(n, 16, dtype=np.int8)
    largest = int(ids.max())
    for s in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[s]
        limit = (1 << bits) - 1 if bits < 60 else (1 << 60) - 2
        if largest <= limit:
            best[left >= count] = s
            continue
        small = np.flatnonzero(ids <= ids.dtype.type(limit))
        if len(small) < count:
            break  # fewer fit for narrower words
        run = small[: len(small) - count + 1]
        run = run[small[count - 1 :] - run == count - 1]
        best[run[left[run] >= count]] = s
    return best


def decode(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """All ids; words of one selector are unpacked together wherever they stand."""
    if not n_ids:
        return np.empty(0, dtype=np.uint64)
    kind = (words >> np.uint64(60)).astype(np.int64)
    escape = words == _ESCAPE
    if escape.any():
        raw = np.zeros(len(words), dtype=bool)
        for i in np.flatnonzero(escape):  # a raw word may itself look like an escape
            if not raw[i]:
                raw[i + 1] = True
        escape &= ~raw
    else:
        raw = escape
    counts = np.array([c for c, _ in SELECTORS])[kind]
    counts[raw] = 0
    counts[escape] = 1
    first = np.cumsum(counts) - counts
    block_first = first[offsets.astype(np.int64)]
    if not np.array_equal(block_first, np.arange(len(offsets)) * BLOCK):
        raise ValueError("block offsets do not match the words")
    out = np.zeros(n_ids, dtype=np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        rows = np.flatnonzero((kind == s) & ~raw & ~escape)
        if not rows.size or not bits:
            continue
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[first[rows] + k] = (words[rows] >> np.uint64(k * bits)) & mask
    rows = np.flatnonzero(escape)
    out[first[rows]] = words[rows + 1]
    return out


def pack_file(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = encode(ids)
    body = b"".join(
        (
            _HEAD.pack(_MAGIC, len(doc_ids), len(ids), len(offsets), len(words)),
            doc_ids.astype("<i8").tobytes(),
            np.cumsum(lengths).astype("<u8").tobytes(),
            offsets.astype("<u8").tobytes(),
            words.astype("<u8").tobytes(),
        )
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc ids, doc ends, ids`` of a file; a damaged one raises ValueError."""
    if len(data) < _HEAD.size + 4 or struct.unpack("<I", data[-4:])[0] != zlib.crc32(memoryview(data)[:-4]):
        raise ValueError("checksum mismatch")
    magic, n_docs, n_ids, n_blocks, n_words = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b id file")
    at = _HEAD.size
    parts = []
    for kind, n in (("<i8", n_docs), ("<u8", n_docs), ("<u8", n_blocks), ("<u8", n_words)):
        parts.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += 8 * n
    doc_ids, ends, offsets, words = parts
    return doc_ids, ends, decode(words, offsets, n_ids)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str | None = None,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_per_file: int = 1 << 23,
) -> DataFrame:
    """Writes every text's ids, each with ``end_id`` appended, and returns the manifest ``file, n_docs, n_ids, start``.

    Files are in ascending id order; a task starts another file after
    ``ids_per_file`` ids, so its memory is bounded. A file is written under a
    name of its attempt and renamed, so a repeated task replaces it by equal
    content.

    Defined cases: null text: the end id only; null ids come first; rows of
    one id are ordered by their text; an empty table makes no file.
    """
    model = tokenizer_file or tokenizer_path()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encoder = tokenizer(model)
        keys: list[int] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        size, number = 0, 0
        columns = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

        def flush() -> pa.RecordBatch:
            name = f"{path}/part-{part:06d}-{number:06d}.s8b"
            write_atomically(name, pack_file(np.array(keys, dtype=np.int64), np.concatenate(sizes), np.concatenate(held)), attempt)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, number, name, len(keys), size), columns.types)], schema=columns)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids, lengths = encoder.batch(some.column(1).to_pylist(), end_id)
                keys += [NULL_KEY if k is None else k for k in some.column(0).to_pylist()]
                held.append(ids)
                sizes.append(lengths)
                size += len(ids)
                if size >= ids_per_file:
                    yield flush()
                    keys, held, sizes, size, number = [], [], [], 0, number + 1
        if keys:
            yield flush()

    made = ordered.mapInArrow(run, "part int, number int, file string, n_docs long, n_ids long").collect()  # a row per file
    manifest, start = [], 0
    for r in sorted(made, key=lambda r: (r.part, r.number)):
        manifest.append((r.file, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return spark.createDataFrame(manifest, "file string, n_docs long, n_ids long, start long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the files; ``ids`` is little-endian uint32."""
    files = manifest.select("file", "start").repartition(shuffle_width(manifest.sparkSession), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids, ends, ids = unpack_file(open_input(name))
                flat = ids.astype("<u4")
                ends = ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                for a in range(0, len(doc_ids), 4096):
                    b = min(a + 4096, len(doc_ids))
                    edges = np.concatenate([starts[a:b], ends[b - 1 : b]])
                    data = pa.py_buffer(flat[edges[0] : edges[-1]].tobytes())
                    cuts = pa.py_buffer(((edges - edges[0]) * 4).astype(np.int32).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[a:b], mask=doc_ids[a:b] == NULL_KEY),
                            pa.array(starts[a:b] + base),
                            pa.array(ends[a:b] - starts[a:b]),
                            pa.Array.from_buffers(pa.binary(), b - a, [None, cuts, data]),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the files to the shared scratch folder and reads them back."""
    return read_token_files(write_token_files(docs, scratch_path(docs.sparkSession, "token-ids"), tokenizer_file, end_id))
