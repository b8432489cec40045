"""A window table that streams append to and readers may scan at any time: one folder a
micro-batch, compacted into sorted runs without readers noticing.

Layout under the table's path:

- ``batches/batch_id=<k>/interval_date=<day>/``: what micro-batch k wrote; a replay replaces it.
- ``runs/<id>/interval_date=<day>/``: rows of a range of finished batches, sorted, in files of
  about ``file_bytes``.
- ``_current``: the manifest, a JSON list of runs with their batch ranges, replaced by a rename.

The rows of the table are those of the manifest's runs and of the batches after the last
run. A batch belongs to one or the other by its number, so a replay of a batch that a run
already holds changes nothing. Runs are merged by size: a new run takes in the ones before it
that are not larger, so sizes at least halve from run to run and a row is rewritten at most
a logarithmic number of times.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import read_pointer, swap_pointer, with_interval_date

ROWS = "interval_start timestamp_ntz, flow_type string, zone_id bigint, flow bigint"
FILE_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class WindowTable:
    path: str
    rows: str = ROWS
    file_bytes: int = FILE_BYTES

    @property
    def batches_path(self) -> str:
        return f"{self.path}/batches"

    def _fs(self, spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p

    def _bytes(self, spark: SparkSession, path: str) -> int:
        fs, p = self._fs(spark, path)
        return fs.getContentSummary(p).getLength()

    def _folders(self, spark: SparkSession, path: str) -> list[tuple[str, int]]:
        """Name and modification time (ms) of the folders under ``path``; none if it is missing."""
        fs, p = self._fs(spark, path)
        found = fs.listStatus(p) if fs.exists(p) else []
        return [(s.getPath().getName(), s.getModificationTime()) for s in found if s.isDirectory()]

    def batch_ids(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches whose folders are there, in order."""
        prefix = "batch_id="
        return sorted(int(n[len(prefix):]) for n, _ in self._folders(spark, self.batches_path) if n.startswith(prefix))

    def manifest(self, spark: SparkSession) -> list[dict]:
        """Runs in the order of their batches: ``id, first, last, bytes``."""
        text = read_pointer(spark, self.path)
        return json.loads(text) if text else []

    def open_batches(self, spark: SparkSession, upto: int | None = None, runs: list[dict] | None = None) -> list[int]:
        """Numbers of the batches, up to ``upto``, that are in no run."""
        runs = self.manifest(spark) if runs is None else runs
        through = runs[-1]["last"] if runs else -1
        return [k for k in self.batch_ids(spark) if k > through and (upto is None or k <= upto)]

    def write_batches(self, windows: DataFrame) -> None:
        """Writes the batches of ``windows`` (``rows`` and ``batch_id``); a batch that is there
        is replaced, others are left alone."""
        (with_interval_date(windows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "interval_date").parquet(self.batches_path))

    def write_batch(self, windows: DataFrame, batch_id: int) -> None:
        self.write_batches(windows.withColumn("batch_id", F.lit(batch_id).cast("long")))

    def _read(self, spark: SparkSession, runs: list[str], batches: list[int]) -> DataFrame:
        schema = f"{self.rows}, batch_id bigint, interval_date date"
        parts = [spark.read.schema(schema).parquet(f"{self.path}/runs/{r}") for r in runs]
        if batches:
            paths = [f"{self.batches_path}/batch_id={k}" for k in batches]
            parts.append(spark.read.schema(schema).option("basePath", self.batches_path).parquet(*paths))
        out = parts[0] if parts else spark.createDataFrame([], schema)
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def read(self, spark: SparkSession, since: date | None = None, upto: int | None = None) -> DataFrame:
        """The table's rows with ``batch_id`` and ``interval_date``: from day ``since`` on, of
        batches up to ``upto``. The files are settled when this is called: batches and runs
        written later do not show, and replaced ones stay until ``expire``."""
        runs = self.manifest(spark)
        batches = self.open_batches(spark, upto, runs)
        if upto is not None:
            runs = [r for r in runs if r["first"] <= upto]
        out = self._read(spark, [r["id"] for r in runs], batches)
        if since is not None:
            out = out.filter(F.col("interval_date") >= F.lit(since))
        return out if upto is None else out.filter(F.col("batch_id") <= upto)

    def compact(self, spark: SparkSession, upto: int) -> dict | None:
        """Puts the batches up to ``upto``, all of them finished, into a run and returns it (None
        if no batch is waiting). Rows are range-partitioned by day and time, so a day of any
        size is dealt over tasks, and the run has about one file a day or ``file_bytes``."""
        runs = self.manifest(spark)
        batches = self.open_batches(spark, upto, runs)
        if not batches:
            return None
        size = sum(self._bytes(spark, f"{self.batches_path}/batch_id={k}") for k in batches)
        taken: list[dict] = []
        while runs and runs[-1]["bytes"] <= size:
            taken.insert(0, runs.pop())
            size += taken[0]["bytes"]
        rows = self._read(spark, [r["id"] for r in taken], batches)
        run = {"id": uuid.uuid4().hex, "first": taken[0]["first"] if taken else batches[0], "last": batches[-1]}
        order = ["interval_date", "interval_start", "flow_type", "zone_id"]
        at = f"{self.path}/runs/{run['id']}"
        (rows.repartitionByRange(math.ceil(size / self.file_bytes), *order).sortWithinPartitions(*order)
         .write.partitionBy("interval_date").parquet(at))
        run["bytes"] = self._bytes(spark, at)
        swap_pointer(spark, self.path, json.dumps([*runs, run]))
        return run

    def expire(self, spark: SparkSession, grace_seconds: float) -> int:
        """Deletes runs that the manifest does not name and batches that its runs hold, if they
        have not been changed for ``grace_seconds`` (longer than any reader runs). Returns the
        number of folders deleted."""
        runs = self.manifest(spark)
        named, through = {r["id"] for r in runs}, runs[-1]["last"] if runs else -1
        before = spark.sparkContext._jvm.System.currentTimeMillis() - 1000 * grace_seconds
        old = [f"{self.path}/runs/{n}" for n, t in self._folders(spark, f"{self.path}/runs") if n not in named and t < before]
        old += [f"{self.batches_path}/{n}" for n, t in self._folders(spark, self.batches_path)
                if n.startswith("batch_id=") and int(n[len("batch_id="):]) <= through and t < before]
        for path in old:
            fs, p = self._fs(spark, path)
            fs.delete(p, True)
        return len(old)
