"""Replacing a report: readers get the former one until the new one is complete."""

import pytest
from pyspark.sql import functions as F

from zoneflow.sources import sinks


def test_former_report_until_the_swap(spark, scratch):
    path = f"{scratch}/report"
    assert sinks.snapshot_path(spark, path) is None
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, path)
    sinks.write_snapshot(spark.range(3), path)
    begun = sinks.read_snapshot(spark, path)
    broken = spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_snapshot(broken, path)
    assert sinks.read_snapshot(spark, path).count() == 3
    sinks.write_snapshot(spark.range(7), path)
    assert sinks.read_snapshot(spark, path).count() == 7 and begun.count() == 3
    sinks.write_snapshot(spark.range(0), path)
    assert sinks.read_snapshot(spark, path).count() == 0
