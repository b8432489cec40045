"""Streaming queries over the test tables.

The message log is stood in for by files in the shared checkpoint folder: the bound
events are written there (whole tables) and read back by Structured Streaming file
sources, a few files a trigger; the results are read from the sinks' tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import quantize
from ..session import shared_path
from ..sources import sinks
from ..sources import testdata as td
from ..streaming import clocks, live, source, tumbling
from . import catalog
from .catalog import DAY, query

LOG_FILES = 12
FILES_PER_TRIGGER = 4


publish_to_files = sinks.write_event_log


def tumbling_windows(spark: SparkSession, events: DataFrame, base: str, n_files: int = LOG_FILES,
                     per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Events as a time-ordered message log of ``n_files`` files, read ``per_trigger`` files at
    a time; 5-minute counts with delay 0 go to an append table, rejects to another. The log's
    order makes the result independent of the trigger size; dropped rows would fail the query."""
    sinks.write_ordered_log(events, f"{base}/log", n_files, "event")
    msgs = source.file_messages(spark, f"{base}/log", per_trigger)
    valid, rejects = source.split_rejects(source.flow_events(msgs))
    agg = tumbling.with_date(tumbling.stream_tumbling(valid, "5 minutes", "0 seconds"))
    tumbling.finish(tumbling.start_append(agg, f"{base}/windows", f"{base}/ckpt", partition_by=["interval_date"],
                                          n_state_partitions=spark.sparkContext.defaultParallelism))
    tumbling.finish(tumbling.start_append(rejects, f"{base}/rejects", f"{base}/ckpt_rejects",
                                          n_state_partitions=spark.sparkContext.defaultParallelism))
    return spark.read.parquet(f"{base}/windows").drop("interval_date")


@query("stream_tumbling")
def q_stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Events -> ordered message files -> stream parse -> rejects split -> 5-minute tumbling counts
    with watermark delay 0 -> append parquet sink (checkpointed) -> the sink table."""
    return tumbling_windows(spark, td.events(spark, d), shared_path(spark, "stream_tumbling"))


def live_detector(spark: SparkSession, d: str, n_files: int = LOG_FILES, per_trigger: int = FILES_PER_TRIGGER) -> live.LiveDetector:
    """One live stream over the ordered single-channel log: 1-day windows closed by a delay-0
    watermark, anomalies per closed step; returns the detector that wrote them."""
    base = shared_path(spark, "live")
    evs = td.events_total(spark, d)
    sinks.write_ordered_log(evs, f"{base}/log", n_files)
    det = live.LiveDetector(f"{base}/out", td.zone_dim(spark, d), catalog.p_edges(spark, d), DAY)
    stream = spark.readStream.schema(evs.schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{base}/log")
    valid, rejects = source.split_rejects(stream)
    closed = tumbling.stream_tumbling(valid, "1 day", "0 seconds")
    cores = spark.sparkContext.defaultParallelism
    tumbling.finish(live.start_live(closed, det, f"{base}/ckpt", n_state_partitions=cores))
    tumbling.finish(tumbling.start_append(rejects, f"{base}/rejects", f"{base}/ckpt_rejects", n_state_partitions=cores))
    return det


@query("live_anomalies")
def q_live_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Live loop over the single-channel events: anomalies of every closed day."""
    return live.read_anomalies(spark, live_detector(spark, d))


@query("stream_passthrough")
def q_stream_passthrough(spark: SparkSession, d: str) -> DataFrame:
    """Wide bike rows (both ends with coordinates and zones) -> JSON files -> stream with the
    8-column schema -> unchanged append sink -> the sink table."""
    from .. import schemas

    base = shared_path(spark, "passthrough")
    wide = catalog.assigned_bike(spark, d).select(
        "starttime", "stoptime", "start station latitude", "start station longitude",
        "end station latitude", "end station longitude",
        F.col("pu_zone").alias("PULocationID"), F.col("do_zone").alias("DOLocationID"))
    wide.write.mode("append").json(f"{base}/log")
    stream = spark.readStream.schema(schemas.BIKE_STREAM).json(f"{base}/log")
    cores = spark.sparkContext.defaultParallelism
    tumbling.finish(tumbling.start_append(stream, f"{base}/sink", f"{base}/ckpt", n_state_partitions=cores))
    out = spark.read.parquet(f"{base}/sink")
    return out.select(*[quantize(F.col(c)).alias(c) if "station" in c else F.col(c) for c in out.columns])


@query("stream_source")
def q_stream_source(spark: SparkSession, d: str) -> DataFrame:
    """Trip flow events published as ``topic, value`` message files, read from the beginning
    by a stream, parsed (topic -> flow type, JSON -> time, zone), rejects split off, valid
    rows appended to a table."""
    base = shared_path(spark, "stream_source")
    publish_to_files(catalog.flow_events(spark, d), f"{base}/log", catalog.SOURCE)
    valid, rejects = source.split_rejects(source.flow_events(source.file_messages(spark, f"{base}/log")))
    cores = spark.sparkContext.defaultParallelism
    tumbling.finish(tumbling.start_append(valid, f"{base}/events", f"{base}/ckpt", n_state_partitions=cores))
    tumbling.finish(tumbling.start_append(rejects, f"{base}/rejects", f"{base}/ckpt_rejects", n_state_partitions=cores))
    return spark.read.parquet(f"{base}/events")


def topic_counts(spark: SparkSession, events: DataFrame, base: str, delay: float, per_trigger: int = FILES_PER_TRIGGER) -> clocks.TopicCounts:
    """Counts of a log of ``events`` (with offsets), each flow type by its own clock."""
    sinks.write_offset_log(events, f"{base}/log", LOG_FILES, "event")
    valid, rejects = source.split_rejects(source.placed_events(source.offset_messages(spark, f"{base}/log", per_trigger)))
    counts = clocks.TopicCounts(f"{base}/counts", 300, delay)
    cores = spark.sparkContext.defaultParallelism
    tumbling.finish(clocks.start_counts(valid, counts, f"{base}/ckpt", n_state_partitions=cores))
    tumbling.finish(tumbling.start_append(rejects, f"{base}/rejects", f"{base}/ckpt_rejects", n_state_partitions=cores))
    return counts


@query("stream_topics")
def q_stream_topics(spark: SparkSession, d: str) -> DataFrame:
    """Topics whose clocks are ten hours apart in one log: the closed 5-minute windows of each."""
    return topic_counts(spark, td.arriving_events(spark, d, lag=True), shared_path(spark, "stream_topics"), 0.0).closed(spark)


@query("stream_late")
def q_stream_late(spark: SparkSession, d: str) -> DataFrame:
    """A log in disorder, delay 5 s: closed windows and, as ``late``, what came after their end."""
    counts = topic_counts(spark, td.arriving_events(spark, d, jitter=True), shared_path(spark, "stream_late"), 5.0)
    late = counts.late(spark).groupBy(F.window("time", "5 minutes")["start"].cast("timestamp_ntz").alias("interval_start"), "flow_type", F.col("region_id").alias("zone_id"))
    late = late.agg(F.count(F.lit(1)).alias("flow"))
    return counts.closed(spark).withColumn("kind", F.lit("closed")).unionByName(late.withColumn("kind", F.lit("late")))
