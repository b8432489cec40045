"""Binding of the driver's TPC-H-style test tables to this package's input schemas.

These functions only shape rows into the schemas the jobs expect; the jobs themselves
(cleaning, windowing, graphs, forecasts, ...) live in ``operators`` and run on the result.

  trips  = lineitem x orders x customer x supplier
           pickup = o_orderdate, dropoff = l_shipdate, pu_zone = c_nationkey, do_zone = s_nationkey
  zones  = nation (graph_id = rank of n_nationkey - 1), area = nations with n_regionkey <= 1
  events = events (time = ts, region_id = user_id % 25, flow_type = event_type)
  bike   = the same trips with coordinates taken from account balances and prices
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the binding (FIXTURES.md §2).
AREA_MAX_REGIONKEY = 1
EVENT_ZONES = 25
CLEAN_FROM = "1996-01-01"
CLEAN_TO = "1997-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(c, o.o_custkey == c.c_custkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .select(F.col("o_orderdate").alias("pickup"), F.col("l_shipdate").alias("dropoff"),
                    F.col("c_nationkey").cast("long").alias("pu_zone"),
                    F.col("s_nationkey").cast("long").alias("do_zone")))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: 25 rows, ordered window on a dimension-sized table only."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("long").alias("zone_id"),
        (F.row_number().over(Window.orderBy("n_nationkey")) - 1).cast("long").alias("graph_id"),
        F.col("n_name").alias("zone_name"),
        F.col("n_regionkey").alias("_region"))


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones(spark, sf_dir).drop("_region")


def area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysed area: the zones of regions 0 and 1 (10 of 25)."""
    return zones(spark, sf_dir).filter(F.col("_region") <= AREA_MAX_REGIONKEY).drop("_region")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow events ``flow_type, time, region_id`` from the ``events`` table."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("flow_type"), F.col("ts").alias("time"),
                    (F.col("user_id") % EVENT_ZONES).cast("long").alias("region_id"))


def events_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in a single channel ``all`` (every event type counted together)."""
    return events(spark, sf_dir).withColumn("flow_type", F.lit("all"))


# Fixed values of the arrival rule: flow types with a name of odd length arrive ten hours after the
# others; with jitter a record arrives up to 30 minutes after its time.
LAG_SECONDS = 36_000
JITTER_SECONDS = 1_800
JITTER_FACTOR = 7_919


def arriving_events(spark: SparkSession, sf_dir: str, lag: bool = False, jitter: bool = False) -> DataFrame:
    """``events`` with ``offset``, their place in the log: the microsecond in which they arrive."""
    e = table(spark, sf_dir, "events")
    wait = F.lit(0).cast("long")
    if lag:
        wait = wait + F.when(F.length("event_type") % 2 == 1, LAG_SECONDS).otherwise(0)
    if jitter:
        wait = wait + F.pmod(F.col("event_id") * JITTER_FACTOR, F.lit(JITTER_SECONDS))
    return e.select(F.col("event_type").alias("flow_type"), F.col("ts").alias("time"), (F.col("user_id") % EVENT_ZONES).cast("long").alias("region_id"),
                    (F.unix_micros(F.col("ts").cast("timestamp")) + wait * 1_000_000).alias("offset"))


def bike_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bike-style trips with station coordinates (lat/lon inside a 0.1 x 0.1 degree box).

    Coordinates come from money columns by a fixed rule; the zone of each end is NOT given
    and has to be found by the spatial join.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")

    def frac(col):
        return F.abs(col * 7.31) - F.floor(F.abs(col * 7.31))

    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderdate").alias("starttime"),
                    (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 97).cast("int")))
                    .alias("stoptime"),
                    (F.lit(40.70) + 0.1 * frac(F.col("c_acctbal"))).alias("start station latitude"),
                    (F.lit(-74.02) + 0.1 * frac(F.col("o_totalprice"))).alias("start station longitude"),
                    (F.lit(40.70) + 0.1 * frac(F.col("o_totalprice") * 3.0)).alias("end station latitude"),
                    (F.lit(-74.02) + 0.1 * frac(F.col("c_acctbal") * 3.0)).alias("end station longitude")))


# Fixed values of the zone-polygon binding: a 5 x 5 tiling of rectangles (feet) over the
# projected coordinate box of ``bike_trips``; zone with graph id g is tile (g % 5, g // 5).
TILE_X0 = 975_000.0
TILE_Y0 = 190_000.0
TILE_W = 6_000.0
TILE_H = 9_000.0
TILES_PER_ROW = 5


def zone_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone_id, ring`` for every zone of the dimension (rectangles by the rule above)."""
    z = zone_dim(spark, sf_dir)
    gx = (F.col("graph_id") % TILES_PER_ROW).cast("double")
    gy = F.floor(F.col("graph_id") / TILES_PER_ROW).cast("double")
    x0 = F.lit(TILE_X0) + gx * TILE_W
    y0 = F.lit(TILE_Y0) + gy * TILE_H

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(pt(x0, y0), pt(x0 + TILE_W, y0), pt(x0 + TILE_W, y0 + TILE_H), pt(x0, y0 + TILE_H))
    return z.select("zone_id", ring.alias("ring"))


def zone_shapes_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone_id, rings``: in each tile a rectangle with a hole, an island in the hole, and a second
    part (offsets in feet from the tile's corner)."""
    z = zone_dim(spark, sf_dir)
    x0 = F.lit(TILE_X0) + (F.col("graph_id") % TILES_PER_ROW).cast("double") * TILE_W
    y0 = F.lit(TILE_Y0) + F.floor(F.col("graph_id") / TILES_PER_ROW).cast("double") * TILE_H

    def ring(left, right, low, high):
        return F.array(*[F.struct((x0 + a).alias("x"), (y0 + b).alias("y")) for a, b in ((left, low), (right, low), (right, high), (left, high))])

    rings = F.array(ring(0.0, 4000.0, 0.0, 9000.0), ring(1000.0, 3000.0, 2000.0, 7000.0), ring(1500.0, 2500.0, 3000.0, 6000.0), ring(4500.0, 6000.0, 1000.0, 8000.0))
    return z.select("zone_id", rings.alias("rings"))
