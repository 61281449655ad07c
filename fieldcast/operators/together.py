"""Independent Spark jobs side by side."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, *tasks, most: int | None = None):
    """Results of the tasks in order; each may start Spark jobs of its own. ``most`` bounds how
    many run at a time.

    Short jobs leave executors idle between their stages; jobs that do not depend on each
    other fill those gaps. The first error is raised once all tasks have ended.
    """
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=min(len(tasks), most or len(tasks))) as pool:
        futures = [pool.submit(wrap(task)) for task in tasks]
    return [f.result() for f in futures]
