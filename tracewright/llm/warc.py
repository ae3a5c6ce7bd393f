"""WARC archives: a Spark writer with revisit records and a Python data source that reads them.

Reading (format ``warc``): partitions are planned over files and, for large
files, over byte ranges (a range owns the records that start in it; the reader
finds the first one by its version line and checks that record's headers).
Filters on ``record_type`` and on header columns are pushed down and judged on
the parsed headers; a record that fails them, and every payload when the option
``payload`` is ``false``, is skipped by its length without decoding.

Defined cases: null html is an empty payload; rows of one payload whose id is
the smallest are responses, all others revisit that id (null ids revisit, unless
every id of the payload is null, then all are responses); a truncated record
raises ValueError; an empty table makes an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from tracewright.llm.common import stored
from tracewright.llm.shared_files import Appender, listed, open_input, open_random, write_atomically
from tracewright.session import scratch_path

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a task starts another file, and bytes of a planned range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 64 << 20

SCHEMA = "record_id string, record_type string, target_uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, payload binary"
#: Columns whose filters are judged on headers.
_PUSHED = {"record_id", "record_type", "target_uri", "page_id", "refers_to", "payload_digest", "payload_bytes"}


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@F.pandas_udf(T.StringType())
def _digest(payload: pd.Series) -> pd.Series:
    return payload.map(lambda p: payload_digest(bytes(p)))


# --- writing -----------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. Its block is an HTTP response; a revisit keeps the HTTP header, which states the payload's size, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{_number(page_id)}>",
        f"WARC-Target-URI: {_one_line(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{_number(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(page_id: int | None) -> str:
    return "" if page_id is None else str(page_id)


def _one_line(url: str | None) -> str:
    return " ".join((url or "").split())


def write_archives(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Writes one record per page under ``path``; repeated payloads of at least ``min_revisit_bytes`` become revisits.

    The first id of each repeated payload is an aggregate over (digest, id),
    written out before pages meet it by digest: its size is then known, so
    Spark sends it to all tasks if it is small, and else moves page bytes once
    in a join whose skewed keys it splits.

    Each attempt of a task writes files of its own, and a manifest names those of
    the attempts that counted, so repeated or lost attempts leave no record twice.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", _digest("payload"))
    firsts = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    marked = rows.join(stored(firsts, "warc-firsts"), "digest", "left").select("page_id", "url", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        names, out = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    names.append(f"part-{part:06d}-{len(names):06d}-{attempt}.warc")
                    out = Appender(f"{path}/{names[-1]}", attempt)
                revisit = r["first"] is not None and r["page_id"] != r["first"]
                out.write(record(r["page_id"], r["url"], r["payload"], r["digest"], r["first"] if revisit else None, revisit))
                if out.size >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    names = [r["name"] for r in marked.mapInArrow(run, "name string").collect()]  # a name for each file of ``file_bytes``
    write_atomically(f"{path}/{MANIFEST}", "\n".join(sorted(names)).encode(), 0)


# --- reading -----------------------------------------------------------------

#: Names the files of a folder that :func:`write_archives` has written; folders without one are read whole.
MANIFEST = "manifest.txt"
#: Bytes that a reader takes at once.
BUFFER = 256 << 10


def manifest(path: str) -> set[str] | None:
    if not listed(path, MANIFEST):
        return None
    return set(open_input(f"{path}/{MANIFEST}").decode().split())


class _Range(InputPartition):
    def __init__(self, uri: str, start: int, stop: int):
        super().__init__(None)
        self.uri, self.start, self.stop = uri, start, stop


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option ``payload=false`` leaves payloads out."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.range_bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and membership tests on header columns; the others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if column in _PUSHED and isinstance(f, EqualTo):
                self.tests.append((column, frozenset([f.value])))
            elif column in _PUSHED and isinstance(f, In):
                self.tests.append((column, frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> list[_Range]:
        found = []
        named = manifest(self.path)
        for uri, size in listed(self.path, ".warc"):
            if named is not None and uri.rpartition("/")[2] not in named:
                continue  # of an attempt that did not count
            found += [_Range(uri, a, min(a + self.range_bytes, size)) for a in range(0, size, self.range_bytes)]
        return found or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        if not partition.uri:
            return
        with open_random(partition.uri) as raw:
            f = io.BufferedReader(raw, BUFFER)
            at = _first_record(f, partition.start, partition.stop)
            while at < partition.stop:
                f.seek(at)
                headers, head_bytes = _headers(f)
                length = int(headers["content-length"])
                row = self._row(f, headers, length)
                if row is not None:
                    yield row
                at += head_bytes + length + 4

    def _row(self, f: io.BufferedReader, headers: dict[str, str], length: int) -> tuple | None:
        kind = headers["warc-type"]
        row = {
            "record_id": headers.get("warc-record-id"),
            "record_type": kind,
            "target_uri": headers.get("warc-target-uri"),
            "page_id": _page(headers.get("warc-record-id")),
            "refers_to": _page(headers.get("warc-refers-to")),
            "payload_digest": headers.get("warc-payload-digest", "").rpartition(":")[2] or None,
        }
        if any(row[c] not in allowed for c, allowed in self.tests if c in row):
            return None
        http, http_bytes = _http_head(f, length)
        row["payload_bytes"] = int(http.get("content-length", length - http_bytes))
        if any(row[c] not in allowed for c, allowed in self.tests if c == "payload_bytes"):
            return None
        body = None
        if self.payload and kind != "revisit":
            body = f.read(length - http_bytes)
            if len(body) != length - http_bytes:
                raise ValueError(f"truncated record {row['record_id']}")
        return (*row.values(), body)


def _lines(f: io.BufferedReader, limit: int | None = None) -> tuple[list[bytes], int]:
    """Header lines up to the empty one, and their bytes; the file stands after them."""
    start, held = f.tell(), b""
    while (end := held.find(b"\r\n\r\n")) < 0:
        more = f.read(2048)
        if not more or limit is not None and len(held) > limit + 2048:
            raise ValueError(f"no end of headers from byte {start}")
        held += more
    f.seek(start + end + 4)
    return held[:end].split(b"\r\n"), end + 4


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _headers(f: io.BufferedReader) -> tuple[dict[str, str], int]:
    lines, size = _lines(f)
    if lines[0] + b"\r\n" != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return _fields(lines), size


def _http_head(f: io.BufferedReader, length: int) -> tuple[dict[str, str], int]:
    lines, size = _lines(f, length)
    return _fields(lines), size


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _first_record(f: io.BufferedReader, start: int, stop: int) -> int:
    """Where the first record that starts at or after ``start`` begins (``stop`` if there is none before it).

    A version line within a payload is told apart by walking on from it: what
    follows must be a whole record that ends at another record or at the end.
    """
    if start == 0:
        return 0
    mark = b"\r\n\r\n" + VERSION
    total = f.raw.size()
    at = max(0, start - 4)
    while at < stop:
        f.seek(at)
        held = f.read(1 << 20)
        found = held.find(mark)
        if found < 0:
            if len(held) < len(mark):
                return stop
            at += len(held) - len(mark) + 1
            continue
        here = at + found + 4
        if here >= stop:
            return stop
        if _is_record(f, here, total):
            return here
        at = here
    return stop


def _is_record(f: io.BufferedReader, at: int, total: int) -> bool:
    try:
        f.seek(at)
        headers, size = _headers(f)
        end = at + size + int(headers["content-length"]) + 4
        if "warc-type" not in headers or end > total:
            return False
        f.seek(end - 4)
        return f.read(4 + len(VERSION)) in (b"\r\n\r\n" + VERSION, b"\r\n\r\n") and (end == total or end + len(VERSION) <= total)
    except (ValueError, KeyError):
        return False


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


@F.pandas_udf(T.StructType().add("digest", T.StringType()).add("bytes", T.LongType()))
def _measured(payload: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        {"digest": payload.map(lambda p: payload_digest(bytes(p))), "bytes": payload.map(len).astype("int64")}
    )


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes archives to the shared scratch folder and returns their records.

    What a response states of its payload is measured from the payload read
    back; a revisit states what its headers do.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_revisit_bytes)
    spark = pages.sparkSession
    responses = read_archives(spark, path).where(F.col("record_type") == "response").withColumn("m", _measured("payload"))
    revisits = read_archives(spark, path, payload=False).where(F.col("record_type") == "revisit")
    same = ["page_id", "record_type", "refers_to"]
    return responses.select(*same, F.col("m.digest").alias("payload_digest"), F.col("m.bytes").alias("payload_bytes")).unionByName(
        revisits.select(*same, "payload_digest", "payload_bytes")
    )
