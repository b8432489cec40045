"""Session settings and small plan helpers shared by every module.

Nothing here holds data: the helpers build sessions, locate the shared checkpoint folder,
write small reused tables there, and decide between a broadcast and a shuffled join from
the measured size.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job of this package relies on. AQE re-plans joins from real stage sizes
# (broadcast only when the materialised side is under the threshold), coalesces small
# shuffle partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "zoneflow",
                  extra: dict | None = None) -> SparkSession:
    """A session with SESSION_CONF for everything that neither the submit settings nor the
    caller sets. Without ``master`` and ``shuffle_partitions`` those of the submit settings
    (or of an active session) stay."""
    submitted = SparkConf()
    conf = {k: v for k, v in SESSION_CONF.items() if not submitted.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    b = SparkSession.builder.appName(app)
    if master is not None:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this package expects to an existing session (wall-clock
    times are read as UTC, ANSI casts, AQE)."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without the
    setting (tests) gets a folder of our own; on a cluster a missing setting is an error,
    since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS, object store, ...)")
        d = tempfile.mkdtemp(prefix="zoneflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "zoneflow", *parts, uuid.uuid4().hex])


BROADCAST_MAX_BYTES = 8 * 1024 * 1024


def _value_bytes(c: Column, t: T.DataType) -> Column:
    """In-memory size of a value: 8 bytes for a primitive, 16 more than its length for a
    string, the sum over the entries of arrays and the fields of structs."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        size = F.octet_length(c) + 16
    elif isinstance(t, T.ArrayType):
        size = F.aggregate(c, F.lit(24).cast("long"), lambda acc, x: acc + _value_bytes(x, t.elementType))
    elif isinstance(t, T.StructType):
        size = sum((_value_bytes(c.getField(f.name), f.dataType) for f in t.fields), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of all values of ``df``, from one aggregation over every row (not from file
    sizes, which compression makes arbitrarily small)."""
    row = sum((_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, name: str | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured size is at most ``max_bytes``; otherwise
    as it is, so that both sides are shuffled (AQE splits hot keys). With ``name`` it is first
    written to the shared folder: computed once, and measured while it is written."""
    if not name:
        return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
    t, _, size = measured_table(df, name)
    return F.broadcast(t) if size <= max_bytes else t


def measured_table(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """``checkpoint_table`` with the number and the size of its rows, observed during the write."""
    seen = Observation()
    row = sum((_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    t = checkpoint_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")), name)
    return t, seen.get["rows"], seen.get["bytes"]


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint folder and
    reading it back. Survives executor loss (the files live in shared storage), unlike
    a local checkpoint."""
    spark = df.sparkSession
    path = shared_path(spark, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
