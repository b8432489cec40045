"""Event-time tumbling counts on a stream, emitted once per window when it closes."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class DropCounter(StreamingQueryListener):
    """Rows that watermarks dropped, summed over every progress report of a run."""

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def end_of(self, run_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        run, n = str(event.progress.runId), sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[run] = self.dropped.get(run, 0) + n

    def onQueryTerminated(self, event):
        self.end_of(str(event.runId)).set()


_COUNTERS: dict[str, DropCounter] = {}
EVENT_SECONDS = 60  # reports reach the listener a little after the query has ended


def drop_counter(spark: SparkSession) -> DropCounter:
    """The listener of the application; queries started through ``state_partitions`` report to it."""
    app = spark.sparkContext.applicationId
    if app not in _COUNTERS:
        _COUNTERS[app] = DropCounter()
        spark.streams.addListener(_COUNTERS[app])
    return _COUNTERS[app]


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Number of state-store partitions of stateful queries started inside the block.

    Streaming runs without AQE, and the partition count of a stateful operator is fixed
    when the query first starts (then kept in its checkpoint). It should match the
    cluster's cores, not a batch-oriented shuffle setting, and has to be given there; in local
    mode the default is ``defaultParallelism``.
    """
    if n is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("give n_state_partitions: the number of state partitions is fixed when a query first starts")
    drop_counter(spark)
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def stream_tumbling(events: DataFrame, width: str = "5 minutes", delay: str = "0 seconds",
                    time_col: str = "time", zone_col: str = "region_id") -> DataFrame:
    """``COUNT(*)`` per (window, flow type, zone) with watermark ``max(time) - delay``.

    ``withWatermark`` needs a TIMESTAMP (with zone) column, so wall-clock NTZ times are cast
    to TIMESTAMP (session zone UTC) before it and the window start is cast back to NTZ after
    the aggregate. In append mode a window is written once, when the watermark passes its
    end; later rows of a closed window are dropped (``numRowsDroppedByWatermark``).
    """
    ts = events.withColumn("_t", F.col(time_col).cast("timestamp"))
    return (ts.withWatermark("_t", delay)
            .groupBy(F.window("_t", width).alias("w"), F.col("flow_type"), F.col(zone_col).alias("zone_id"))
            .agg(F.count(F.lit(1)).alias("flow"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("interval_start"), "flow_type",
                    F.col("zone_id").cast("long"), "flow"))


def start_append(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                 available_now: bool = True, fmt: str = "parquet", query_name: str | None = None,
                 n_state_partitions: int | None = None) -> StreamingQuery:
    """Append sink with a checkpoint: each closed window is written exactly once, and a
    restart resumes from the checkpoint instead of appending duplicates."""
    w = df.writeStream.outputMode("append").format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    with state_partitions(df.sparkSession, n_state_partitions):
        return w.start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that ends by itself; fail if the watermark dropped rows (the log's
    disorder was larger than the delay), so that a count is never short without notice. Drops
    are summed over all batches by a listener, however many there were. (Where late rows are
    wanted as a table, see ``clocks``.)"""
    query.awaitTermination()
    run = str(query.runId)
    counter = drop_counter(SparkSession.active())
    if not counter.end_of(run).wait(EVENT_SECONDS):
        raise RuntimeError("the query's reports did not arrive, so rows dropped by the watermark are not known")
    if counter.dropped.get(run):
        raise RuntimeError(f"{counter.dropped[run]} rows came after their window was closed: raise the watermark delay or order the log")
    return query


def with_date(df: DataFrame) -> DataFrame:
    """Adds ``interval_date`` so window tables are partitioned by day and step reads prune."""
    return df.withColumn("interval_date", F.to_date("interval_start"))
