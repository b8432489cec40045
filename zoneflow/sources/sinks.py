"""Table writers: window table (day partitions), idempotent batch partitions, snapshot
replace, event log payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.events import publish_payload, sort_events


def with_interval_date(windows: DataFrame) -> DataFrame:
    return windows.withColumn("interval_date", F.to_date("interval_start"))


def write_windows(windows: DataFrame, path: str, mode: str = "append") -> None:
    """Window table partitioned by day, so step reads prune to one or a few partitions."""
    with_interval_date(windows).write.mode(mode).partitionBy("interval_date").parquet(path)


def write_batch_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Write ``df`` as partition ``batch_id=<id>`` with dynamic partition overwrite: a
    replayed micro-batch replaces its own output and leaves every other batch alone."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def with_doc_ids(report: DataFrame, order: tuple[str, ...] = ("flow_type", "graph_id")) -> DataFrame:
    """Ordinal document ids 0.. (the report holds one step: flow types x zones rows at most)."""
    return report.withColumn("doc_id", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def _pointer(spark: SparkSession, path: str):
    """Hadoop's file context and the path of the snapshot's pointer."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path, "_current")
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()), at


def swap_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replaces the pointer of ``path`` in one step: written beside it, then renamed over it
    (one step on HDFS and local file systems)."""
    jvm = spark.sparkContext._jvm
    files, current = _pointer(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(path, f"_next-{uuid.uuid4().hex}")
    out = fresh.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(fresh, True)
    out.write(bytearray(text, "ascii"))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fresh, current, overwrite)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """Text of the pointer of ``path``; None before the first."""
    files, current = _pointer(spark, path)
    if not files.util().exists(current):
        return None
    stream = files.open(current)
    text = bytes(stream.readAllBytes()).decode("ascii")
    stream.close()
    return text


def write_snapshot(report: DataFrame, path: str) -> str:
    """Replace the whole snapshot with the new report: it is written to a folder of its own and
    the pointer is swapped last. Until then, and if the write fails, readers get the former
    report. Returns the version. Former versions stay for readers that have begun; expire
    them by the storage's lifecycle rules."""
    version = uuid.uuid4().hex
    report.write.parquet(f"{path}/versions/{version}")
    swap_pointer(report.sparkSession, path, version)
    return version


def snapshot_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the report that the pointer names; None before the first."""
    version = read_pointer(spark, path)
    return None if version is None else f"{path}/versions/{version}"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The latest complete report."""
    at = snapshot_path(spark, path)
    if at is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    return spark.read.parquet(at)


def write_event_log(events: DataFrame, path: str, source: str) -> None:
    """Append events as JSON-lines messages ``{"topic", "value"}`` (the file form of the log)."""
    publish_payload(events, source).write.mode("append").json(path)


def order_files(spark: SparkSession, path: str) -> int:
    """Give the data files under ``path`` modification times in the order of their names, one
    second apart and in the past: file streams read in that order. Returns their number.
    (Stores that cannot set times raise; a stream over them needs a delay instead.)"""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("part-"))
    first = jvm.System.currentTimeMillis() - 1000 * (len(names) + 60)
    for i, name in enumerate(names):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(root, name), first + 1000 * i, -1)
    return len(names)


def write_ordered_log(events: DataFrame, path: str, n_files: int, source: str | None = None) -> int:
    """A new log of ``n_files`` files in event-time order: range-partitioned on time, one file
    a range, read by file streams from the oldest on. With ``source`` as JSON messages, else
    as the rows themselves in parquet."""
    ordered = sort_events(events, n_files)
    if source is None:
        ordered.write.mode("overwrite").parquet(path)
    else:
        publish_payload(ordered, source).write.mode("overwrite").json(path)
    return order_files(events.sparkSession, path)


def write_offset_log(events: DataFrame, path: str, n_files: int, source: str) -> int:
    """A new log of messages ``topic, value, offset`` in the order of ``offset`` (the place in which
    the records arrived), one file a range of offsets, read by file streams from the oldest on."""
    placed = events.repartitionByRange(n_files, "offset").sortWithinPartitions("offset")
    publish_payload(placed, source, keep=["offset"]).write.mode("overwrite").json(path)
    return order_files(events.sparkSession, path)


def write_kafka(events: DataFrame, servers: str, source: str) -> None:
    """Publish events to Kafka topics ``<source>_<flow_type>`` (needs the Kafka connector)."""
    (publish_payload(events, source).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())
