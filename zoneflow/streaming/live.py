"""Live anomaly detection on closed windows, written as a ``foreachBatch`` function.

Every micro-batch of closed windows is appended to a window table, the steps it closed
are forecast from the 12 steps before them (the same batch functions as the backtest),
and the anomalies are appended to a history table; the newest step's report replaces
the snapshot. Tables are partitioned by batch id and written with dynamic partition
overwrite, so a replayed batch replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, forecast, history
from ..operators.flows import zone_lookup
from ..sources import sinks
from ..sources.window_table import WindowTable
from .tumbling import state_partitions


def _exists(spark: SparkSession, path: str) -> bool:
    """Has the table at ``path`` been written? Asked of the file system, so that any other
    failure is an error and not an empty table."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_write_partition = sinks.write_batch_partition


@dataclass
class LiveDetector:
    base: str
    zones: DataFrame
    p_edges: DataFrame
    step_seconds: int
    n: int = 12
    threshold: float = anomaly.DETECT_THRESHOLD
    a: float = 0.5
    b: float = 0.5
    compact_every: int = 64  # batches of the window table that are compacted together

    def __post_init__(self) -> None:
        # Decided once for the whole stream: the broadcast of the zone lookup and of the
        # transition matrix (each by its measured size), and the numbered zones of the grid.
        self._axis = history.zone_axis(self.zones)
        self._lookup = zone_lookup(self.zones)
        self._p = forecast.transition_table(self.p_edges)

    @property
    def windows(self) -> WindowTable:
        return WindowTable(f"{self.base}/windows")

    @property
    def windows_path(self) -> str:
        return self.windows.batches_path

    @property
    def progress_path(self) -> str:
        return f"{self.base}/progress"

    @property
    def anomalies_path(self) -> str:
        return f"{self.base}/anomalies"

    @property
    def snapshot_path(self) -> str:
        return f"{self.base}/snapshot"

    def _earlier(self, spark: SparkSession, batch_id: int) -> dict:
        """Per flow type, first and last closed step over the batches before ``batch_id``. The
        progress file names the last batch with closed windows, and the state before and after
        it: a batch that is replayed starts from the former."""
        text = sinks.read_pointer(spark, self.progress_path)
        if text is None:
            return {}
        kept = json.loads(text)
        steps = kept["before"] if kept["batch"] >= batch_id else kept["after"]
        return {t: (datetime.fromisoformat(lo), datetime.fromisoformat(hi)) for t, lo, hi in steps}

    def _remember(self, spark: SparkSession, batch_id: int, before: dict, now: dict) -> None:
        """Replaces the progress file (a line a flow type) in one step."""
        after = {t: (min(r[0] for r in rs), max(r[1] for r in rs)) for t in before | now
                 for rs in [[d[t] for d in (before, now) if t in d]]}
        lines = [[[t, lo.isoformat(), hi.isoformat()] for t, (lo, hi) in sorted(d.items())] for d in (before, after)]
        sinks.swap_pointer(spark, self.progress_path, json.dumps({"batch": batch_id, "before": lines[0], "after": lines[1]}))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("interval_start", "flow_type", "zone_id", "flow").persist()
        try:
            self._run(batch, batch_id)
        finally:
            batch.unpersist()

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        # The micro-batch belongs to the stream's cloned session, which runs without AQE;
        # the tables are read through the caller's session so their batch jobs keep it.
        spark = self.zones.sparkSession
        steps = batch.groupBy("flow_type").agg(F.min("interval_start").alias("lo"), F.max("interval_start").alias("hi"))
        now = {t: (lo, hi) for t, lo, hi in steps.select("flow_type", "lo", "hi").collect() if t is not None}  # a row a flow type
        if not now:  # no window closed in this trigger (also true on its replay)
            return
        # Windows partitioned by batch and day: a replay overwrites only its own batch, and
        # the history read below lists only the days it needs. All earlier batches are finished.
        self.windows.write_batch(batch, batch_id)
        if len(self.windows.open_batches(spark, batch_id - 1)) >= self.compact_every:
            self.windows.compact(spark, batch_id - 1)
        before = self._earlier(spark, batch_id)
        types = sorted(before | now)
        lo = min(r[0] for r in [*now.values(), *before.values()])
        new_max = max(r[1] for r in [*now.values(), *before.values()])
        prev_max = max((r[1] for r in before.values()), default=None)
        if prev_max is not None and new_max <= prev_max:
            self._remember(spark, batch_id, before, now)
            return
        # Only the steps closed now, and the n steps before them, are read.
        start = lo if prev_max is None else max(lo, prev_max - timedelta(seconds=self.n * self.step_seconds))
        hist = (self.windows.read(spark, start.date(), batch_id)
                .filter(F.col("interval_start") >= history.ts_literal(start)).drop("interval_date", "batch_id"))
        grid = history.dense_grid(hist, self._axis, self.step_seconds, t0=start, t1=new_max, flow_types=types)
        pred = forecast.next_step(grid, self._p, self.a, self.b, self.n)
        if prev_max is not None:
            pred = pred.filter(F.col("interval_start") > history.ts_literal(prev_max))
        found = anomaly.anomalies(anomaly.residuals(pred), self.zones, self.threshold, self._lookup)
        _write_partition(found, self.anomalies_path, batch_id)
        # The report of the newest step comes back from the partition just written.
        schema = found.schema.add("batch_id", "long")
        if _exists(spark, self.anomalies_path):
            written = spark.read.schema(schema).parquet(self.anomalies_path)
        else:  # no anomaly so far
            written = spark.createDataFrame([], schema)
        last = (written.filter((F.col("batch_id") == batch_id)
                               & (F.col("interval_start") == history.ts_literal(new_max))).drop("batch_id"))
        sinks.write_snapshot(sinks.with_doc_ids(last), self.snapshot_path)
        self._remember(spark, batch_id, before, now)


_ANOMALIES = ("interval_start timestamp_ntz, flow_type string, zone_id bigint, graph_id bigint, zone_name string, "
              "actual bigint, forecast bigint, residual bigint")


def start_live(closed_windows: DataFrame, detector: LiveDetector, checkpoint: str, available_now: bool = True,
               n_state_partitions: int | None = None):
    """Run ``detector`` on every micro-batch of closed windows (append output mode)."""
    w = closed_windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(detector)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    with state_partitions(closed_windows.sparkSession, n_state_partitions):
        return w.start()


def read_anomalies(spark: SparkSession, detector: LiveDetector) -> DataFrame:
    if not _exists(spark, detector.anomalies_path):
        return spark.createDataFrame([], _ANOMALIES)
    # the schema is given: a stream without anomalies leaves a folder without files
    return spark.read.schema(_ANOMALIES + ", batch_id bigint").parquet(detector.anomalies_path).drop("batch_id")
