"""Helpers shared by the corpus operators: the word definition, written tables, measured
broadcasts, byte-bounded Arrow slices and the distributed prefix sum."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.session import checkpoint_table

# A word is a run of characters other than ASCII white space.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a fixed set of rows
    that survives the loss of executors and is computed once."""
    return checkpoint_table(df, f"llm-{name}")


def sized(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) marked for broadcast if its measured content (8 bytes a
    value, plus the length of every string and array) is at most ``max_bytes``; otherwise
    unchanged, so that the planner shuffles both sides."""
    total = F.count(F.lit(1)) * (8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            total = total + F.coalesce(F.sum(F.greatest(F.size(f.name), F.lit(0))), F.lit(0)) * 16
    return F.broadcast(df) if df.agg(total.alias("b")).first()["b"] <= max_bytes else df


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def group_key(col: Column) -> Column:
    """A string that is equal for equal values, null included, and never null."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col.cast("string")))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of ``batch`` of about ``max_bytes`` of text each (a longer single
    text is a piece of its own), so that working memory follows bytes and not row counts."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(size):
        if total and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


def prefix_sums(df: DataFrame, group: str, key: str, value: str, ties: list[str], key_bits: int = 64,
                rows_per_bin: int = 1000, max_bits: int = 14) -> DataFrame:
    """Adds ``before`` (sum of ``value`` over the rows of the same ``group`` that come earlier
    by ``key``, then ``ties``) without bringing a group into one task.

    ``df`` is a written table, ``group`` never null and ``key`` a uniform hash of
    ``key_bits`` bits (64: signed). The top bits of the key cut every group into ranges of about ``rows_per_bin`` rows; the
    ranges' totals are prefix-summed per group (one row a range, 2^14 a group at most),
    and rows are summed inside their range. Both steps share one shuffle of the rows.
    """
    bits = min(max_bits, max(1, (df.count() // rows_per_bin).bit_length()))
    ranged = df.withColumn("_bin", F.shiftright(F.col(key), key_bits - bits))
    totals = ranged.groupBy(group, "_bin").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(group, "_bin", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bin").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_inside", F.sum(value).over(inside) - F.col(value))
    return (summed.join(bases, [group, "_bin"]).withColumn("before", F.col("_base") + F.col("_inside"))
            .drop("_bin", "_base", "_inside"))


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows, for eager jobs whose rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of jobs that are over: it does so when the
    driver's garbage collector finds their plans unreachable."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
