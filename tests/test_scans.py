import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from fieldcast.operators.scans import scan_metrics, scanned_files

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no order-system tables here")


def test_metrics_of_finished_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("p", F.col("id") % 4).repartition(2, "p").write.partitionBy("p").parquet(path)
    rows = spark.read.parquet(path)
    (all_of_it,) = scan_metrics(rows)
    assert (all_of_it["folders"], all_of_it["rows"]) == (4, 1000) and all_of_it["location"].endswith(path)
    (one,) = scan_metrics(rows.where("p = 2"))
    assert (one["folders"], one["rows"]) == (1, 250) and one["files"] < all_of_it["files"]
    both = scan_metrics(rows.where("p = 1").groupBy("id").count().join(rows.where("p < 2"), "id"))
    assert sorted(s["rows"] for s in both) == [250, 500]


@needs_tables
def test_fact_build_reads_the_lines_four_times_at_most(spark, monkeypatch):
    """Past climate, future climate, plots and yields: every job of the build is counted."""
    from fieldcast.catalog.queries import REGISTRY

    seen, write = [], DataFrameWriter.parquet

    def counted(self, *args, **options):
        seen.extend(scanned_files(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    result = REGISTRY["projection_fact_table"](spark, FOLDER)
    seen.extend(scanned_files(result))
    assert result.count() > 0
    assert 1 <= sum("lineitem" in s for s in seen) <= 4
