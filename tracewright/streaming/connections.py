"""Own connections. A Spark data source that writes through what user code opens.

A *store* is a class that ``store="module:Class"`` names. On an executor its
:meth:`Store.connect` opens a connection, once a task, when the task's first rows
come; a task without rows opens none. Each task hands the token of its finished
connection to the driver, which commits all of them together: rows of failed,
repeated or killed attempts were never in a committed token, so they do not
count. The same store serves batch writes, ``foreachBatch`` and ``writeStream``.

:class:`FileStore` keeps rows as Parquet files of a shared folder, found through
the records of its commits; a commit of a name that is there already (a replayed
micro-batch) changes nothing.
"""

from __future__ import annotations

import importlib
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from tracewright.sources.shared import Records, listed, place, remove

FORMAT = "connections"


class Connection:
    """What a task writes through."""

    def put(self, rows: pa.RecordBatch) -> None:
        raise NotImplementedError

    def finish(self) -> dict:
        """Closes the connection; what it gives (plain values) goes to :meth:`Store.commit`."""
        raise NotImplementedError

    def discard(self) -> None:
        """Closes the connection of a task that failed; its rows shall not be seen."""


class Store:
    """User code of a sink; made from the writer's options on the driver and on each executor."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def check(self) -> None:
        """Raises if the store cannot be reached; called before a job starts."""

    def connect(self, task: int) -> Connection:
        raise NotImplementedError

    def commit(self, name: str, tokens: list[dict]) -> None:
        """Publishes the rows behind ``tokens`` as ``name``, which a replay uses again."""

    def abort(self, name: str, tokens: list[dict]) -> None:
        """Rows behind the tokens of a write that failed are not to be seen."""

    def read(self, spark: SparkSession, schema: T.StructType | str) -> DataFrame:
        """What the store holds; needed where a ledger writes to it."""
        raise NotImplementedError


def store_of(options: dict[str, str]) -> Store:
    module, _, name = options["store"].partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


@dataclass
class Token(WriterCommitMessage):
    token: dict | None


class _TaskWriter:
    """Runs on an executor: rows of one task through one connection, opened for the first of them."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Token:
        connection, token = None, None
        try:
            for rows in iterator:
                if rows.num_rows:
                    if connection is None:
                        task = TaskContext.get()
                        connection = store_of(self.options).connect(task.partitionId() if task else 0)
                    connection.put(rows)
            if connection is not None:
                token = connection.finish()
        except BaseException:
            if connection is not None:
                connection.discard()
            raise
        return Token(token)

    def tokens(self, messages) -> list[dict]:
        return [m.token for m in messages if m is not None and m.token is not None]


class _BatchWriter(_TaskWriter, DataSourceArrowWriter):
    @property
    def commit_name(self) -> str:
        return self.options.get("commit") or f"write-{uuid.uuid4().hex}"

    def commit(self, messages) -> None:
        store_of(self.options).commit(self.commit_name, self.tokens(messages))

    def abort(self, messages) -> None:
        store_of(self.options).abort(self.commit_name, self.tokens(messages))


class _StreamWriter(_TaskWriter, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        store_of(self.options).commit(f"batch-{batchId}", self.tokens(messages))

    def abort(self, messages, batchId: int) -> None:
        store_of(self.options).abort(f"batch-{batchId}", self.tokens(messages))


class ConnectionSource(DataSource):
    """Write-only: a store is read by its own means (:func:`read_store`)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    from tracewright.session import ship_package

    ship_package(spark)
    spark.dataSource.register(ConnectionSource)


# ------------------------------------------------------------- files -------
class _FileConnection(Connection):
    def __init__(self, uri: str, task: int):
        self.uri, self.task, self.rows, self.writer = uri, task, 0, None
        self.system, self.path = place(uri)

    def put(self, rows: pa.RecordBatch) -> None:
        if self.writer is None:
            folder, _, name = self.path.rpartition("/")
            self.system.create_dir(folder, recursive=True)
            self.own = f"{folder}/.{name}"  # not seen before it is whole
            self.out = self.system.open_output_stream(self.own)
            self.writer = pq.ParquetWriter(self.out, rows.schema)
        self.writer.write_batch(rows)
        self.rows += rows.num_rows

    def finish(self) -> dict:
        self.writer.close()
        self.out.close()
        self.system.move(self.own, self.path)
        return {"file": self.uri, "rows": self.rows, "task": self.task}

    def discard(self) -> None:
        if self.writer is not None:
            self.out.close()
            remove(f"{self.uri.rpartition('/')[0]}/.{self.uri.rpartition('/')[2]}")


class FileStore(Store):
    """Parquet files below ``path``; only those that a commit names are read."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.path = options["path"].rstrip("/")
        self.commits = Records(f"{self.path}/commits")

    def check(self) -> None:
        system, path = place(f"{self.path}/commits")
        system.create_dir(path, recursive=True)

    def connect(self, task: int) -> Connection:
        return _FileConnection(f"{self.path}/data/{uuid.uuid4().hex}.parquet", task)

    def commit(self, name: str, tokens: list[dict]) -> None:
        if self.commits.add(name, {"files": tokens}) != {"files": tokens}:
            self.abort(name, tokens)  # a replay of what is there

    def abort(self, name: str, tokens: list[dict]) -> None:
        for token in tokens:
            remove(token["file"])


    def read(self, spark: SparkSession, schema: T.StructType | str) -> DataFrame:
        return read_store(spark, self.path, schema)


class AppendStore(FileStore):
    """Without commits: a connection's rows are seen as soon as it is closed, also if the write fails later."""

    def commit(self, name: str, tokens: list[dict]) -> None:
        pass

    def abort(self, name: str, tokens: list[dict]) -> None:
        pass

    def read(self, spark: SparkSession, schema: T.StructType | str) -> DataFrame:
        files = listed(f"{self.path}/data", ".parquet")
        return spark.read.schema(schema).parquet(f"{self.path}/data") if files else spark.createDataFrame([], schema)


class HalfwayStore(AppendStore):
    """For trials of failures: until the file ``mended`` is there, tasks of odd number fail once rows of others are seen."""

    def connect(self, task: int) -> Connection:
        folder, _, name = self.options["mended"].rpartition("/")
        if task % 2 and name not in listed(folder):
            until = time.monotonic() + 20
            while not listed(f"{self.path}/data", ".parquet") and time.monotonic() < until:
                time.sleep(0.1)
            raise ConnectionError("the store went away (trial)")
        return super().connect(task)


def commits(path: str) -> dict[str, dict]:
    """What was committed to a :class:`FileStore`: files, rows and tasks of each write."""
    return Records(f"{path.rstrip('/')}/commits").all()


def read_store(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The committed rows of a :class:`FileStore`."""
    files = [f["file"] for c in commits(path).values() for f in c["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
