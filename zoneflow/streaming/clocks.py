"""Tumbling counts with a clock for each flow type, decided record by record.

A watermark of Structured Streaming is one time for a whole query and moves between triggers:
a fast flow type makes a slow one late, and the same log gives other counts with other trigger
sizes. Here every flow type has its own clock, the largest time among its earlier records in log
order, and a record is late if its window ended by that clock (less the delay). So the outcome
depends on the log alone. Late records go to a table of their own.

Each micro-batch is a set of distributed jobs: the running maximum is a two-level prefix maximum
(ranges of the log order, then records inside a range), so that no flow type is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import broadcast_if_small, checkpoint_table
from ..sources.sinks import write_batch_partition
from .tumbling import state_partitions

CLOSED = "interval_start timestamp_ntz, flow_type string, zone_id bigint, flow bigint"
LATE = "flow_type string, time timestamp_ntz, region_id bigint, offset bigint, behind_seconds double"
CLOCK = "flow_type string, clock timestamp_ntz"


def _interval(seconds: float) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def running_clock(rows: DataFrame, clocks: DataFrame, n_ranges: int) -> DataFrame:
    """``rows`` with ``clock``: the largest time among the flow type's earlier records, those of
    ``rows`` in the order of offset (ties by time, then zone) and those behind ``clocks``.

    The records are cut into ranges of the log order; the ranges' maxima (one row a range and
    flow type) are prefixed, and records are looked at inside their range.
    """
    order = ["offset", "time", "region_id"]
    ranged = checkpoint_table(rows.repartitionByRange(n_ranges, "flow_type", *order).withColumn("_range", F.spark_partition_id()), "clock_ranges")
    earlier = Window.partitionBy("flow_type").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = ranged.groupBy("flow_type", "_range").agg(F.max("time").alias("_top")).withColumn("_before", F.max("_top").over(earlier)).drop("_top")
    inside = Window.partitionBy("flow_type", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    known = ranged.withColumn("_inside", F.max("time").over(inside)).join(broadcast_if_small(tops, "clock_tops"), ["flow_type", "_range"])
    known = known.join(F.broadcast(clocks.withColumnRenamed("clock", "_old")), "flow_type", "left")  # one row a flow type
    return known.withColumn("clock", F.greatest("_inside", "_before", "_old")).drop("_inside", "_before", "_old", "_range")


class TopicCounts:
    """Counts per (window, flow type, zone) of a log ``flow_type, time, region_id, offset``.

    Tables under ``path``, one partition a batch, which a replayed batch replaces: ``closed`` (each
    window once, when its flow type's clock passes its end plus the delay), ``late`` (records whose
    window had closed, with how far the clock was ahead), ``open`` (counts of open windows) and
    ``clock``. A batch reads the state that the one before left. Times and zones must not be null
    (``source.split_rejects``).
    """

    def __init__(self, path: str, width_seconds: int = 300, delay_seconds: float = 0.0, n_ranges: int | None = None):
        self.path, self.width, self.delay, self.n_ranges = path, width_seconds, delay_seconds, n_ranges

    def _state(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        table = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{self.path}/{name}")
        return table.where(F.col("batch_id") == batch_id - 1).drop("batch_id")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clocks = self._state(spark, "clock", CLOCK, batch_id)
        rows = running_clock(batch.select("flow_type", "time", "region_id", "offset"), clocks, self.n_ranges or spark.sparkContext.defaultParallelism)
        start = F.window("time", f"{self.width} seconds")["start"].cast("timestamp_ntz")
        rows = rows.withColumn("interval_start", start).withColumn("_passed", F.col("clock") - _interval(self.delay))
        late = F.coalesce(F.col("interval_start") + _interval(self.width) <= F.col("_passed"), F.lit(False))
        rows = checkpoint_table(rows.withColumn("_late", late).drop("_passed"), "clock_rows")
        behind = (F.unix_micros(F.col("clock").cast("timestamp")) - F.unix_micros(F.col("time").cast("timestamp"))) / 1e6
        write_batch_partition(rows.where("_late").select("flow_type", "time", "region_id", "offset", behind.alias("behind_seconds")), f"{self.path}/late", batch_id)
        now = clocks.unionByName(rows.select("flow_type", F.col("time").alias("clock"))).groupBy("flow_type").agg(F.max("clock").alias("clock"))
        now = checkpoint_table(now, "clock_now")
        write_batch_partition(now, f"{self.path}/clock", batch_id)
        fresh = rows.where("not _late").select("interval_start", "flow_type", F.col("region_id").alias("zone_id"), F.lit(1).cast("long").alias("flow"))
        counts = fresh.unionByName(self._state(spark, "open", CLOSED, batch_id)).groupBy("interval_start", "flow_type", "zone_id").agg(F.sum("flow").alias("flow"))
        done = F.col("interval_start") + _interval(self.width) <= F.col("clock") - _interval(self.delay)
        counts = checkpoint_table(counts.join(F.broadcast(now), "flow_type").withColumn("_done", done).drop("clock"), "clock_counts")
        columns = ["interval_start", "flow_type", "zone_id", "flow"]
        write_batch_partition(counts.where("not _done").select(columns), f"{self.path}/open", batch_id)
        write_batch_partition(counts.where("_done").select(columns), f"{self.path}/closed", batch_id)

    def closed(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{CLOSED}, batch_id bigint").parquet(f"{self.path}/closed").drop("batch_id")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{LATE}, batch_id bigint").parquet(f"{self.path}/late").drop("batch_id")


def start_counts(events: DataFrame, counts: TopicCounts, checkpoint: str, available_now: bool = True, n_state_partitions: int | None = None) -> StreamingQuery:
    """Runs ``counts`` over the stream ``events`` (``flow_type, time, region_id, offset``)."""
    w = events.writeStream.foreachBatch(counts.process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    with state_partitions(events.sparkSession, n_state_partitions):
        return w.start()
