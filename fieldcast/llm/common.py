"""Shared helpers: tables written between jobs, and iteration over Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fieldcast.operators.staging import staging_root

_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_TABLES: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to its Python workers, once per application.

    Needed where the package is not installed on the executors. Spark copies the archive to
    them itself; the folder it is zipped in is read by the driver only.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="package-")  # Spark serves the archive from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, f"{folder}/code/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(
        shutil.make_archive(f"{folder}/{package.name}-{app}", "zip", f"{folder}/code"))
    _SHIPPED.add(app)


def shared_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below ``spark.checkpoint.dir``.

    The session's setting is only read. Where it is unset (tests), the folder lies in the
    warehouse, unless that is a folder of one machine of a cluster.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{staging_root(spark)}/llm-{app}"
        atexit.register(drop_shared, spark)
    return _ROOTS[app]


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder.

    The written table cuts the lineage: if an executor is lost later, nothing above it is
    computed again, and rows numbered inside a task keep their numbers.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """As ``write_shared``, bucketed by ``key``: a join or grouping by it moves no row of the table.

    The catalog of the session knows the table by a name of its own until the application ends.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", shared_path(spark, label)).saveAsTable(name)
    _TABLES.append(name)
    return spark.table(name)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop's (file system, path) pair for any URI that Spark can write to."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop_shared(spark: SparkSession) -> None:
    """Remove the intermediate tables; call it when the results have been read."""
    try:
        while _TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
        root = _ROOTS.pop(spark.sparkContext.applicationId, None)
        if root:
            fs, at = hadoop_fs(spark, root)
            fs.delete(at, True)
    except Exception:  # at exit the session may be gone already
        return


def texts_of(column: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) of consecutive parts of a string column, nulls as empty texts: about
    ``most`` bytes of a batch are Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in slices(sizes, most):
        yield a, ["" if t is None else t for t in column.slice(a, b - a).to_pylist()]


def give_back(trim: bool = True) -> None:
    """Return memory that a finished task no longer needs; Spark keeps its workers alive. The C
    library holds on to freed blocks unless it is asked to ``trim`` them, which costs the next task
    of the worker some time to get them anew."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if not trim:
        return
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs [start, end) of items whose sizes sum to about ``most``, one item at least."""
    start, total, end = 0, 0, 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end
