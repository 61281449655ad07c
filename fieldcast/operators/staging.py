"""Tables written once between two jobs.

An intermediate that several later jobs read is written as Parquet below the folder in
``spark.checkpoint.dir``, or below a shared warehouse where that is unset. Writing cuts the lineage (a lost
executor costs no recomputation), lets later scans prune columns, and gives Spark the true
size for the choice between broadcast and shuffled joins.
"""

from __future__ import annotations

import atexit
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_RUNS: dict[str, list[str]] = {}
_LOCK = threading.Lock()


def staging_root(spark: SparkSession) -> str:
    """The shared folder; nothing is set on the session.

    Where no folder is named, the warehouse serves: in local mode, or if it is on a file system that
    all machines reach. On a cluster a folder of one machine is refused.
    """
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if is_local(warehouse) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder that all executors share; {warehouse} is on one machine")
    return warehouse


def is_local(path: str) -> bool:
    """Whether a path without a scheme, or with that of plain files, names a folder of a machine."""
    return path.startswith(("/", "file:")) or "://" not in path


def _folder(spark: SparkSession) -> str:
    """The folder of the innermost run of this application."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if not _RUNS.get(app):
            _RUNS[app] = [f"{staging_root(spark)}/fieldcast-{app}"]
            atexit.register(remove, spark, _RUNS[app][0])
        return _RUNS[app][-1]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is; at exit the session may be gone."""
    if spark.sparkContext._jsc is None:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging_run(spark: SparkSession):
    """All tables staged inside go to one folder, which is removed at the end.

    Nothing that reads them may leave the block unless it has been written elsewhere.
    """
    outer = _folder(spark)
    runs = _RUNS[spark.sparkContext.applicationId]
    folder = f"{outer}/run-{uuid.uuid4().hex}"
    runs.append(folder)
    try:
        yield folder
    finally:
        runs.remove(folder)
        remove(spark, folder)


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path among the staged tables."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once, keep it as a table, and return the table. Tables staged outside a
    ``staging_run`` stay until the application ends."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
