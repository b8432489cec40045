"""Trips -> flow events, event counts, ordering, first-n, publish payloads, history tail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

INFLOW = "inflow"
OUTFLOW = "outflow"


def trips_to_events(trips: DataFrame) -> DataFrame:
    """Each trip -> one ``inflow`` event (dropoff time, destination zone) and one ``outflow``
    event (pickup time, origin zone), in a single pass over the trips."""
    pair = F.array(
        F.struct(F.lit(INFLOW).alias("flow_type"), F.col("dropoff").alias("time"), F.col("do_zone").alias("region_id")),
        F.struct(F.lit(OUTFLOW).alias("flow_type"), F.col("pickup").alias("time"), F.col("pu_zone").alias("region_id")))
    return trips.select(F.inline(pair))


def with_source(events: DataFrame, source: str) -> DataFrame:
    """Flow types of one source, ``<source>_<flow_type>``, for tables of several sources."""
    return events.withColumn("flow_type", F.concat(F.lit(source + "_"), F.col("flow_type")))


def event_counts(events: DataFrame) -> DataFrame:
    """Rows per flow type (the batch size of each publish)."""
    return events.groupBy("flow_type").agg(F.count(F.lit(1)).alias("n_events"))


def sort_events(events: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Event-time order for writing replay files: range partitions on time, sorted inside.

    A range partitioning keeps the sort distributed (no single-task global sort). The row
    id is the last range key, so a run of identical (time, flow type, zone) rows, however
    long, is still split across partitions instead of landing in one task.
    """
    keys = ["time", "flow_type", "region_id", "_row"]
    df = events.withColumn("_row", F.monotonically_increasing_id())
    df = df.repartitionByRange(n_partitions, *keys) if n_partitions else df.repartitionByRange(*keys)
    return df.sortWithinPartitions(*keys).drop("_row")


def first_events(events: DataFrame, n: int) -> DataFrame:
    """The first ``n`` events in time order (the order key covers every column, so ties are
    whole-row duplicates and the result is deterministic). Top-k: each task keeps only n."""
    return events.orderBy("time", "flow_type", "region_id").limit(n)


def with_tail(history: DataFrame, live: DataFrame, n: int) -> DataFrame:
    """History plus the first ``n`` live rows, which push the event-time watermark past the
    last history window so that it closes."""
    return history.unionByName(first_events(live, n))


def publish_payload(events: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    """Rows of the message log: ``topic = <source>_<flow_type>`` and a JSON value
    ``{"region_id": .., "time": "yyyy-MM-dd HH:mm:ss.SSSSSS"}`` (times lose nothing)."""
    return events.select(
        F.concat(F.lit(source + "_"), F.col("flow_type")).alias("topic"),
        F.to_json(F.struct(F.col("region_id"), F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time")))
        .alias("value"), *(keep or []))


def parse_payload(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Message rows ``topic, value`` -> ``flow_type, time, region_id`` and the columns ``keep``.

    The flow type is the part of the topic name after its last ``_`` (null without one); the
    JSON is parsed permissively. Stray topics and malformed rows come out with null fields
    (see ``streaming.source.split_rejects``).
    """
    ev = F.from_json(F.col("value").cast("string"), schemas.FLOW_EVENT_JSON, {"mode": "PERMISSIVE"})
    return messages.select(F.when(F.col("topic").contains("_"), F.substring_index("topic", "_", -1)).alias("flow_type"),
                           ev["time"].alias("time"), ev["region_id"].alias("region_id"), *(keep or []))
