"""Projection and strict point-in-polygon assignment (FIXTURES §5)."""

import math

from pyspark.sql import functions as F

from zoneflow.functions import geo
from zoneflow.operators import spatial


def test_projection(spark):
    df = spark.createDataFrame([(40.758, -73.9855), (40.16666666666666, -74.0)], "lat double, lon double")
    x, y = geo.project(F.col("lat"), F.col("lon"))
    r = df.select(x.alias("x"), y.alias("y")).collect()
    assert math.isclose(r[0]["x"], 988267.0741, abs_tol=1e-3) and math.isclose(r[0]["y"], 215436.8786, abs_tol=1e-3)
    assert math.isclose(r[1]["x"], 984250.0, abs_tol=1e-6) and abs(r[1]["y"]) < 1e-6


def test_strict_interior_with_concave_zone(spark):
    def ring(pts):
        return [{"x": float(a), "y": float(b)} for a, b in pts]
    shapes = spark.createDataFrame(
        [(1, ring([(0, 0), (2, 0), (2, 2), (0, 2)])), (2, ring([(2, 0), (4, 0), (4, 2), (3, 1), (2, 2)]))],
        "zone_id long, ring array<struct<x:double,y:double>>")
    pts = [(1, 1.0, 1.0, 1), (2, 0.0, 1.0, None), (3, 2.0, 1.0, None), (4, 3.0, 1.5, None), (5, 3.0, 0.5, 2),
           (6, 5.0, 5.0, None), (7, 3.0, 1.0, None), (8, 2.5, 1.25, 2)]
    df = spark.createDataFrame([(i, x, y) for i, x, y, _ in pts], "pid long, x double, y double")
    got = {r["pid"]: r["zone"] for r in spatial.assign_zone(df, "x", "y", shapes, "zone", cell=1.5).collect()}
    assert got == {i: z for i, _, _, z in pts}


def test_overlap_takes_smallest_zone(spark):
    sq = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 2.0}]
    shapes = spark.createDataFrame([(7, sq), (3, sq)], "zone_id long, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert spatial.assign_zone(df, "x", "y", shapes, "zone", cell=0.7).first()["zone"] == 3
