"""Session construction and the shared scratch location.

Library code never assumes a machine-local folder: intermediate tables go under
the folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset (local tests, the bench) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tracewright",
    conf: dict[str, str] | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with our defaults *merged* with ``conf``.

    A user override replaces single keys, never the whole default map, so
    ``spark.ui.enabled=false`` survives any override.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where none
    is configured, a session within one JVM (tests, the bench) gets a local one
    and a cluster is refused: its executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tracewright-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: computed once, and a lineage cut that outlives executors."""
    return _written(df, scratch_path(df.sparkSession, name))


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as :func:`stored` gives it, for a ``with`` block; its files go at the end.

    A cached partition is read whole, as rows that take many times the bytes of their file, by one task. Of a stored one, tasks
    read the columns they need, and several share a large file.
    """
    path = scratch_path(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Takes away a folder of any file system, if it is there."""
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tracewright`` importable on executors (once per application).

    Functions used by Arrow UDFs and ``mapInArrow`` are pickled by module
    reference, so Python workers must be able to import the package wherever
    the driver was started. The package is zipped on the driver and shipped
    with ``addPyFile`` -- Spark's own code-distribution mechanism.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _shipped:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="tracewright-pyfiles-"), "tracewright.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _shipped.add(app)
