"""What scans really read, from the metrics that Spark keeps of a finished query."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _leaves(plan) -> list:
    """Leaf operators of an executed plan, also below exchanges that ran as stages of their own."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _leaves(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _leaves(plan.plan())
    if kind == "ReusedExchangeExec":
        return []
    children = plan.children()
    if not children.size():
        return [plan]
    return [leaf for i in range(children.size()) for leaf in _leaves(children.apply(i))]


def scan_metrics(df: DataFrame) -> list[dict]:
    """Run ``df`` to its end and return, for each file scan, the location, the files and folders it
    opened and the rows it decoded. Rows are counted after row groups and pages were skipped and
    before any other filter. No row reaches the driver."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    found = []
    for leaf in _leaves(query.executedPlan()):
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        metrics = leaf.metrics()

        def value(name: str):
            return metrics.apply(name).value() if metrics.contains(name) else None

        found.append({
            "location": leaf.relation().location().rootPaths().mkString(","),
            "files": value("numFiles"), "folders": value("numPartitions"), "rows": value("numOutputRows"),
        })
    return found


def scanned_files(df: DataFrame) -> list[str]:
    """Location of every file scan in the optimised plan of ``df``, which is not run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            found.append(leaf.relation().location().rootPaths().mkString(","))
    return found
