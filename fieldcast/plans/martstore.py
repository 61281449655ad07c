"""Stored marts, valid for one state of the fact table.

A mart is kept under the number of the manifest that its rows come from. Replacing any partition
publishes a manifest with a higher number, so the next read builds the mart anew, and no reader
is ever given figures of older facts. Nothing expires by time, nothing lives in a process.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldcast.sources.factstore import MARTS, current_manifest, file_system, read_fact


def stored_mart(
    spark: SparkSession, fact_path: str, name: str, build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The mart ``name`` of the fact table as it is now; ``build`` makes it from fact rows.

    The manifest is read once: rows and number belong together even while another job publishes a
    new one. The folder gets its final name by one rename when it is complete. Of two builders at
    a time one wins, the other discards its copy; both copies hold the same rows.
    """
    manifest = current_manifest(spark, fact_path)
    folder = f"{fact_path}/{MARTS}/{name}/{manifest['number']:012d}"
    fs, at = file_system(spark, fact_path)
    if not fs.exists(at(folder)):
        temporary = f"{fact_path}/{MARTS}/{name}/.{uuid.uuid4().hex}"
        build(read_fact(spark, fact_path, manifest=manifest)).write.parquet(temporary)
        if fs.exists(at(folder)) or not fs.rename(at(temporary), at(folder)):
            fs.delete(at(temporary), True)
    return spark.read.parquet(folder)
