"""File readers: trip CSVs, zone dimension, zone polygons, wide adjacency matrix, window tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import broadcast_if_small, checkpoint_table


def read_taxi_trips(spark: SparkSession, path: str) -> DataFrame:
    """Raw taxi trips, every column a string (no inference: bad values survive to the cast)."""
    return spark.read.schema(schemas.TAXI_RAW).option("header", True).csv(path)


def read_bike_trips(spark: SparkSession, path: str) -> DataFrame:
    """Raw bike trips, every column a string."""
    return spark.read.schema(schemas.BIKE_RAW).option("header", True).csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension CSV ``zone_id, graph_id, zone_name`` (names repeat: never key on them)."""
    return spark.read.schema(schemas.ZONES).option("header", True).csv(path)


def read_zone_shapes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Zone polygons as ``zone_id, ring array<struct<x,y>>`` (projected feet)."""
    return spark.read.schema(schemas.ZONE_SHAPES).format(fmt).load(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file that aren't blank, with their number from 0: ``number, line``.

    Every split is read by a task of its own. A line's number is its place in its split plus
    the lines of the splits before (one row a split), so a large file is many tasks and blank
    lines, also at split borders, don't count. The numbered table is written once: places
    come from the order of reading and must not be computed twice.
    """
    line = F.regexp_replace("value", "\r", "")
    read = spark.read.text(path).select(line.alias("line"), F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("start"))
    placed = read.filter(F.length(F.trim("line")) > 0).withColumn("place", F.monotonically_increasing_id())
    placed = checkpoint_table(placed, "numbered_lines")
    splits = placed.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    splits = splits.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(broadcast_if_small(splits), ["file", "start"]).select(
        (F.col("place") - F.col("first") + F.col("offset")).alias("number"), "line")


def read_adjacency_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide N x N adjacency CSV (header = column ids, one row per source, blank lines allowed)
    -> edge list ``src, dst, w`` with every cell kept (zeros included).

    The source of a row is its line number after the header (``numbered_lines``), so the file
    is read in splits. The header's ids reach the rows as one array, N numbers long.
    """
    lines = numbered_lines(spark, path)
    header = lines.filter(F.col("number") == 0).select(F.transform(F.split("line", ","), lambda c: F.trim(c).cast("long"))).scalar()
    cells = lines.filter(F.col("number") > 0).select((F.col("number") - 1).alias("src"), F.posexplode(F.split("line", ",")).alias("pos", "cell"))
    return cells.select("src", F.element_at(header, F.col("pos") + 1).alias("dst"), F.trim("cell").cast("double").alias("w"))


def wide_to_edges(wide: DataFrame, row_col: str, value_cols: list[str], col_ids: list[int] | None = None) -> DataFrame:
    """Wide matrix DataFrame (one row per source, one column per destination) -> ``src, dst, w``.

    ``col_ids`` gives the destination id of each value column (default: position).
    """
    ids = col_ids if col_ids is not None else list(range(len(value_cols)))
    cells = F.array(*[F.struct(F.lit(int(i)).cast("long").alias("dst"), F.col(c).cast("double").alias("w"))
                      for i, c in zip(ids, value_cols)])
    return (wide.select(F.col(row_col).cast("long").alias("src"), F.inline(cells))
            .select("src", "dst", F.coalesce("w", F.lit(0.0)).alias("w")))


def window_step_filter(interval_col: Column, t0: Column, step_seconds: int, first: int, n: int) -> Column:
    """Predicate selecting the steps ``first .. first+n-1`` counted from ``t0``.

    A range on the timestamp column itself, pushed into the parquet scan (row-group
    statistics); ``load_history`` / ``load_step`` add the day-partition filter.
    """
    lo = t0 + F.make_dt_interval(secs=F.lit(step_seconds * first))
    hi = t0 + F.make_dt_interval(secs=F.lit(step_seconds * (first + n)))
    return (interval_col >= lo) & (interval_col < hi)


def _date_prune(windows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """On a day-partitioned window table also filter the partition column, so only the
    partitions of the wanted days are listed and read."""
    if "interval_date" not in windows.columns:
        return windows
    return windows.filter(F.col("interval_date").between(F.to_date(lo), F.to_date(hi)))


def load_history(windows: DataFrame, t0: Column, step_seconds: int, n_steps: int = 12) -> DataFrame:
    """Full history read: the ``n_steps`` windows starting at ``t0`` (filter, not a row limit)."""
    hi = t0 + F.make_dt_interval(secs=F.lit(step_seconds * n_steps))
    w = _date_prune(windows, t0, hi)
    return w.filter(window_step_filter(F.col("interval_start"), t0, step_seconds, 0, n_steps))


def load_step(windows: DataFrame, t0: Column, step_seconds: int, step: int) -> DataFrame:
    """One-step read: windows whose ``interval_start == t0 + step * width``, for every zone."""
    at = t0 + F.make_dt_interval(secs=F.lit(step_seconds * step))
    return _date_prune(windows, at, at).filter(F.col("interval_start") == at)
