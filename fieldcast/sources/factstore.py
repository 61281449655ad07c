"""The stored fact table: one folder per crop, horizon and version, and a manifest.

Readers see the partitions that the newest manifest lists, so several partitions change at
once, when a manifest appears under its final name. Whatever fails before leaves the old
manifest and all its files in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldcast.schemas import FACT, FACT_PARTITIONS

MANIFESTS = "_manifests"
MARTS = "_marts"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its constructor of paths."""
    maker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return maker(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), maker


def current_manifest(spark: SparkSession, path: str) -> dict:
    """``{"number": n, "versions": {version: [partition, ...]}}`` of the newest manifest.

    A manifest has one entry per crop and horizon, a closed list.
    """
    fs, at = file_system(spark, path)
    folder = at(f"{path}/{MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())
    if not numbers:
        return {"number": 0, "versions": {}}
    lines = spark.read.text(f"{path}/{MANIFESTS}/{numbers[-1]:012d}.json").collect()
    return json.loads(lines[0][0])


def read_fact(
    spark: SparkSession, path: str, schema=FACT, partitions=FACT_PARTITIONS, manifest: dict | None = None,
) -> DataFrame:
    """The rows of a manifest, by default the newest one; filters on the partition columns prune
    folders."""
    versions = (manifest or current_manifest(spark, path))["versions"]
    if not versions:
        return spark.createDataFrame([], schema)
    found = None
    for version, kept in sorted(versions.items()):
        folders = [
            f"{path}/{version}/" + "/".join(f"{c}={v}" for c, v in zip(partitions, key)) for key in kept]
        rows = spark.read.schema(schema).option("basePath", f"{path}/{version}").parquet(*folders)
        rows = rows.select(schema.fieldNames())
        found = rows if found is None else found.unionByName(rows)
    return found


def write_version(df: DataFrame, path: str, partitions=FACT_PARTITIONS) -> tuple[str, DataFrame]:
    """Write rows under a new version name that no manifest lists yet; the version, and
    ``(partition columns, n_rows)`` counted from the written files.

    Rows go out rebalanced by partition, so that a large partition becomes several files of fair
    size and a small one a single file.
    """
    version = f"version-{uuid.uuid4().hex}"
    df.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(f"{path}/{version}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{version}")
    return version, written.groupBy(*partitions).agg(F.count("*").alias("n_rows"))


def switch(spark: SparkSession, path: str, version: str, keys: list[tuple]) -> None:
    """Make ``version`` the one that holds the partitions ``keys``; the others stay as they are.

    The new manifest is complete under a temporary name before one rename publishes it. Two
    writers at a time cannot both publish the same number: the second fails.
    """
    old = current_manifest(spark, path)
    taken = {tuple(k) for k in keys}
    versions = {v: [k for k in kept if tuple(k) not in taken] for v, kept in old["versions"].items()}
    versions = {v: kept for v, kept in versions.items() if kept} | {version: [list(k) for k in keys]}
    number = old["number"] + 1
    fs, at = file_system(spark, path)
    temporary, final = (at(f"{path}/{MANIFESTS}/{n}") for n in (f".{uuid.uuid4().hex}", f"{number:012d}.json"))
    out = fs.create(temporary)
    out.write(json.dumps({"number": number, "versions": versions}).encode())
    out.close()
    if fs.exists(final) or not fs.rename(temporary, final):
        fs.delete(temporary, False)
        raise RuntimeError(f"another writer has changed {path}")


def replace_partitions(df: DataFrame, path: str, partitions=FACT_PARTITIONS) -> DataFrame:
    """Replace those partitions of a stored table that ``df`` holds; keep all others.

    Returns ``(partition columns, n_rows)``. An empty frame is refused: it would replace
    nothing and hide a failed build. ``df`` is computed once. Replaced files stay for readers
    that have begun with them; ``vacuum`` removes them later.
    """
    spark = df.sparkSession
    version, counts = write_version(df, path, partitions)
    rows = counts.collect()  # one per crop and horizon
    if not rows:
        raise ValueError("nothing to write: the new partitions are empty")
    switch(spark, path, version, sorted(tuple(r[p] for p in partitions) for r in rows))
    return counts


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove versions that the newest manifest does not list, older manifests and their marts."""
    manifest = current_manifest(spark, path)
    fs, at = file_system(spark, path)
    for status in fs.listStatus(at(path)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in manifest["versions"]:
            fs.delete(status.getPath(), True)
    for status in fs.listStatus(at(f"{path}/{MANIFESTS}")):
        if status.getPath().getName() != f"{manifest['number']:012d}.json":
            fs.delete(status.getPath(), False)
    marts = at(f"{path}/{MARTS}")
    for mart in fs.listStatus(marts) if fs.exists(marts) else []:
        for status in fs.listStatus(mart.getPath()):
            if status.getPath().getName() != f"{manifest['number']:012d}":
                fs.delete(status.getPath(), True)
