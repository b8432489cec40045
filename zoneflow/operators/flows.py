"""Tumbling-window flow counts and their joins with the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def tumbling_flow(events: DataFrame, width: str = "5 minutes", time_col: str = "time",
                  zone_col: str = "region_id") -> DataFrame:
    """``COUNT(*)`` per (tumbling window, flow type, zone) -> ``interval_start, flow_type, zone_id, flow``.

    Partial (map-side) counting happens before the shuffle, so a hot zone sends at most
    one row per window and map task. Null times and zones belong to the rejects, not here.
    """
    return (events.filter(F.col(time_col).isNotNull() & F.col(zone_col).isNotNull())
            .groupBy(F.window(time_col, width).alias("w"), F.col("flow_type"), F.col(zone_col).alias("zone_id"))
            .agg(F.count(F.lit(1)).alias("flow"))
            .select(F.col("w.start").alias("interval_start"), "flow_type", F.col("zone_id").cast("long"), "flow"))


def zone_lookup(zones: DataFrame) -> DataFrame:
    return broadcast_if_small(zones.select("zone_id", "graph_id", "zone_name"))


def flow_zone_join(flows: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join of flow windows with the zone dimension (adds ``graph_id``, ``zone_name``);
    zones missing from the dimension keep null attributes (see ``unmatched_regions``)."""
    return flows.join(zone_lookup(zones), "zone_id", "left")


def unmatched_regions(flows: DataFrame, zones: DataFrame) -> DataFrame:
    """Flow rows whose zone is not in the dimension (the reject side of ``flow_zone_join``)."""
    return flows.join(zone_lookup(zones).select("zone_id"), "zone_id", "left_anti")
