"""Time-series views of flow windows: step numbers, dense zero-filled grid, wide matrices,
sliding 12-step history and per-zone standardisation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, broadcast_if_small, measured_table

GRID_ROWS_PER_PARTITION = 2_000_000
SERIES_KEYS = ["flow_type", "zone_id"]


def ts_literal(value) -> Column:
    return F.lit(value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)).cast("timestamp_ntz")


def add_seconds(ts: Column, seconds: Column | int) -> Column:
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def origin(windows: DataFrame) -> Column:
    """First window start as a scalar subquery (computed once, used as a constant)."""
    return windows.agg(F.min("interval_start")).scalar()


def step_number(interval_col: Column, t0: Column, step_seconds: int) -> Column:
    """``floor((t - t0) / width)``: the step of a window counted from the origin."""
    return F.floor(F.timestamp_diff("SECOND", t0, interval_col) / F.lit(step_seconds)).cast("long")


def step_time(t0: Column, step: Column, step_seconds: int) -> Column:
    """Inverse of ``step_number``: ``t0 + width * step``."""
    return add_seconds(t0, step * F.lit(step_seconds))


def time_steps(windows: DataFrame, step_seconds: int, t0: Column | None = None, n_steps: int | None = None) -> DataFrame:
    """Windows with their step number; with ``n_steps`` only steps ``0 .. n_steps-1`` remain."""
    t0c = origin(windows) if t0 is None else t0
    out = windows.withColumn("step", step_number(F.col("interval_start"), t0c, step_seconds))
    if n_steps is not None:
        out = out.filter(F.col("step").between(0, n_steps - 1))
    return out


def _indexed(df: DataFrame, order: str) -> DataFrame:
    """``df`` (a dimension) with ``_i`` = 0.. in the order of ``order``."""
    return df.withColumn("_i", (F.row_number().over(Window.orderBy(order)) - 1).cast("long"))


def channels(windows: DataFrame) -> DataFrame:
    """Distinct non-null flow types (the channels)."""
    return windows.select("flow_type").filter(F.col("flow_type").isNotNull()).distinct()


@dataclass(frozen=True)
class GridAxis:
    """A numbered dimension of the grid (``_zone`` or ``_type`` = 0..) with its rows and size."""
    table: DataFrame
    n: int
    size: int

    def joined(self, grid: DataFrame, number: str) -> DataFrame:
        return grid.join(F.broadcast(self.table) if self.size <= BROADCAST_MAX_BYTES else self.table, number)


def zone_axis(zones: DataFrame) -> GridAxis:
    """The zones, numbered and written once; a caller that builds many grids keeps it."""
    return GridAxis(*measured_table(_indexed(zones.select(F.col("zone_id").cast("long"), F.col("graph_id").cast("long")), "zone_id")
                                    .withColumnRenamed("_i", "_zone"), "grid_zones"))


def type_axis(spark: SparkSession, flow_types: DataFrame | list[str]) -> GridAxis:
    """The flow types, numbered; a list of names is not written, it is part of the plan."""
    if isinstance(flow_types, list):
        rows = [(t, i) for i, t in enumerate(sorted(flow_types))]
        return GridAxis(spark.createDataFrame(rows, "flow_type string, _type bigint"), len(rows), sum(len(t.encode()) + 48 for t in flow_types))
    return GridAxis(*measured_table(_indexed(flow_types, "flow_type").withColumnRenamed("_i", "_type"), "grid_types"))


def dense_grid(windows: DataFrame, zones: DataFrame | GridAxis, step_seconds: int, t0=None, t1=None,
               flow_types: DataFrame | list[str] | None = None) -> DataFrame:
    """Zero-filled grid ``flow_type x step x zone`` between ``t0`` and ``t1`` (inclusive;
    by default the first and last window start).

    Windows are mapped to steps by ``step_number`` and summed, so windows that are finer
    than the step or off its raster count in the step they start in; those that fit no cell
    are in ``outside_grid``. Only the time range and the two dimension sizes reach the driver:
    cells come from one ``range`` whose number is split into step, type and zone index, and
    meet the dimensions in equi-joins. Cells and windows are unioned, hash-partitioned once
    by series and summed per cell.
    """
    spark = windows.sparkSession
    types = type_axis(spark, channels(windows) if flow_types is None else flow_types)
    zones = zones if isinstance(zones, GridAxis) else zone_axis(zones)
    n_types, n_zones = types.n, zones.n
    if t0 is None or t1 is None:
        lo, hi = windows.filter(F.col("flow_type").isNotNull()).agg(F.min("interval_start"), F.max("interval_start")).first()
        t0 = lo if t0 is None else t0
        t1 = hi if t1 is None else t1
    n_steps = 0 if t0 is None or t1 is None else max(0, int((t1 - t0).total_seconds() // step_seconds) + 1)
    cells = n_steps * n_types * n_zones
    if not cells:
        return spark.createDataFrame(
            [], "flow_type string, interval_start timestamp_ntz, zone_id bigint, graph_id bigint, flow bigint")
    number = F.col("id")
    grid = spark.range(0, cells, 1, math.ceil(cells / GRID_ROWS_PER_PARTITION)).select(
        F.floor(number / (n_types * n_zones)).cast("long").alias("_step"),
        F.pmod(F.floor(number / n_zones).cast("long"), F.lit(n_types)).alias("_type"), F.pmod(number, F.lit(n_zones)).alias("_zone"))
    grid = zones.joined(types.joined(grid, "_type"), "_zone")
    start = ts_literal(t0)
    zeros = grid.select("flow_type", F.col("_step"), "zone_id", "graph_id", F.lit(0).cast("long").alias("flow"), F.lit(True).alias("_cell"))
    obs = (windows.withColumn("_step", step_number(F.col("interval_start"), start, step_seconds))
           .filter(F.col("_step").between(0, n_steps - 1))
           .select("flow_type", "_step", F.col("zone_id").cast("long"), F.lit(None).cast("long").alias("graph_id"),
                   F.col("flow").cast("long"), F.lit(False).alias("_cell")))
    # One hash partitioning by series (flow type, zone) serves the aggregate below and the
    # per-series windows that usually follow (history, standardisation): no further shuffle.
    both = zeros.unionByName(obs).repartition(*SERIES_KEYS)
    return (both.groupBy("flow_type", "_step", "zone_id")
            .agg(F.sum("flow").alias("flow"), F.max("graph_id").alias("graph_id"), F.max("_cell").alias("_cell"))
            .filter(F.col("_cell"))
            .select("flow_type", step_time(start, F.col("_step"), step_seconds).alias("interval_start"), "zone_id", "graph_id",
                    F.col("flow").cast("long").alias("flow")))


def outside_grid(windows: DataFrame, zones: DataFrame, step_seconds: int, t0, t1) -> DataFrame:
    """The windows that no cell of the grid from ``t0`` to ``t1`` counts: null flow type,
    a zone missing from the dimension, or a start outside the steps (the grid's rejects)."""
    known = broadcast_if_small(zones.select(F.col("zone_id").cast("long").alias("_known")))
    n_steps = int((t1 - t0).total_seconds() // step_seconds) + 1
    step = step_number(F.col("interval_start"), ts_literal(t0), step_seconds)
    fits = F.col("flow_type").isNotNull() & F.col("_known").isNotNull() & step.between(0, n_steps - 1)
    return windows.join(known, F.col("zone_id") == F.col("_known"), "left").filter(~F.coalesce(fits, F.lit(False))).drop("_known")


def flow_matrix(grid: DataFrame, graph_ids: list[int]) -> DataFrame:
    """Long grid -> one row per (flow type, step) and one column ``g<graph id>`` per zone,
    in graph-index order (the column layout of the (T x N) flow matrix)."""
    wide = grid.groupBy("flow_type", "interval_start").pivot("graph_id", graph_ids).agg(F.sum("flow"))
    return wide.select("flow_type", "interval_start",
                       *[F.coalesce(F.col(str(g)), F.lit(0)).cast("long").alias(f"g{g}") for g in graph_ids])


def flow_channels(grid: DataFrame, flow_types: list[str]) -> DataFrame:
    """Long grid -> one row per (step, zone), one column per flow type (the channel axis)."""
    wide = grid.groupBy("interval_start", "zone_id").pivot("flow_type", flow_types).agg(F.sum("flow"))
    return wide.select("interval_start", "zone_id",
                       *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(t) for t in flow_types])


def history_window(n: int) -> Window:
    return Window.partitionBy(*SERIES_KEYS).orderBy("interval_start").rowsBetween(-n, -1)


def with_history(grid: DataFrame, n: int = 12) -> DataFrame:
    """Attach the previous ``n`` steps of each series to every grid row, and the per-zone
    statistics over them. Rows without ``n`` previous steps are dropped.

    One sort per (flow type, zone) series; the series are already aggregated to one row per
    step, so a hot zone costs no more than any other.
    """
    w = history_window(n)
    sd = F.stddev_pop("flow").over(w)
    return (grid
            .withColumn("history", F.collect_list("flow").over(w))
            .withColumn("n_hist", F.count(F.lit(1)).over(w))
            .withColumn("mu", F.avg("flow").over(w))
            .withColumn("sd", F.when(sd > 0, sd).otherwise(F.lit(1.0)))
            .withColumn("last", F.lag("flow", 1).over(Window.partitionBy(*SERIES_KEYS).orderBy("interval_start")))
            .filter(F.col("n_hist") == n))


def sliding_history(grid: DataFrame, n: int = 12) -> DataFrame:
    """``flow_type, zone_id, interval_start, flow, history`` with ``history`` the previous
    ``n`` flows, oldest first, as text ``"a,b,c,..."``."""
    h = with_history(grid, n)
    return h.select("flow_type", "zone_id", "interval_start", "flow",
                    F.array_join(F.transform("history", lambda x: x.cast("string")), ",").alias("history"))


def standardize(grid: DataFrame, n: int = 12) -> DataFrame:
    """Per series and target step: mean and population std of the previous ``n`` flows
    (std 0 -> 1) and the standardised last flow ``z_last = (x[t-1] - mu) / sd``."""
    h = with_history(grid, n)
    return h.select("flow_type", "zone_id", "interval_start", "mu", "sd",
                    ((F.col("last") - F.col("mu")) / F.col("sd")).alias("z_last"))
