"""Residuals, anomalous zones and the latest anomaly snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import with_doc_ids
from .flows import zone_lookup

DETECT_THRESHOLD = 10


def residuals(pred: DataFrame) -> DataFrame:
    """``|actual - forecast|`` per (flow type, zone, step)."""
    return pred.withColumn("residual", F.abs(F.col("actual") - F.col("forecast")))


def align(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Equi-join of actual flows (a grid) and forecasts on (flow type, step, zone)."""
    return actual.select("flow_type", "interval_start", "zone_id", F.col("flow").alias("actual")).join(
        forecast.select("flow_type", "interval_start", "zone_id", "forecast"),
        ["flow_type", "interval_start", "zone_id"])


def anomalies(res: DataFrame, zones: DataFrame, threshold: float = DETECT_THRESHOLD,
              lookup: DataFrame | None = None) -> DataFrame:
    """Zones whose residual exceeds the threshold (strict), with their dimension attributes,
    over all flow types in one plan. ``lookup`` = a prepared ``zone_lookup(zones)``."""
    hot = res.filter(F.col("residual") > F.lit(threshold))
    return hot.join(lookup if lookup is not None else zone_lookup(zones), "zone_id").select(
        "interval_start", "flow_type", "zone_id", "graph_id", "zone_name", "actual", "forecast", "residual")


def snapshot(anom: DataFrame) -> DataFrame:
    """Only the newest step of an appended anomaly history, numbered 0.. by (flow type,
    graph id) as document ids. One step holds at most flow types x zones rows."""
    newest = anom.agg(F.max("interval_start")).scalar()
    return with_doc_ids(anom.filter(F.col("interval_start") == newest))
