"""Zones with holes, islands and parts: the quadtree join against a plain even-odd test."""

import random

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import spatial
from zoneflow.sources import testdata as td

from conftest import SF_SMALL

SHAPES = {
    7: [[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (8, 2), (8, 8), (2, 8)], [(4, 4), (6, 4), (6, 6), (4, 6)]],  # hole and island
    3: [[(12, 0), (20, 0), (16, 9)], [(12, 20), (20, 20), (20, 12), (18, 18), (12, 19)]],                             # two parts, one concave
    5: [[(-9, -9), (-1, -8), (-3, -1), (-8, -2)], [(-6, -6), (-4, -6), (-5, -4)]],
    9: [[(0, 0), (30, 0), (30, 30), (0, 30)]],                                                                        # overlaps: the smaller id wins
}


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("root, levels", [(4.0, 3), (64.0, 5), (1.0, 0)])
def test_matches_even_odd(spark, root, levels):
    rng = random.Random(1)
    points = [(rng.uniform(-11, 32), rng.uniform(-11, 32)) for _ in range(1500)]
    points += [(float(x), float(y)) for x in range(-10, 32) for y in range(-10, 32)]  # corners, borders, cell lines
    points += [(None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (1e12, 1e12)]
    shapes = spark.createDataFrame([(z, [[(float(x), float(y)) for x, y in r] for r in rings]) for z, rings in SHAPES.items()] + [(1, []), (2, None)],
                                   "zone_id long, rings array<array<struct<x:double,y:double>>>")
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i long, x double, y double")
    got = {r["i"]: r for r in spatial.assign_zone_multi(df, "x", "y", spatial.quad_index(shapes, root, levels), "zone", root, exact="tested").collect()}
    assert len(got) == len(points)
    for i, (x, y) in enumerate(points[:-4]):
        assert got[i]["zone"] == min((z for z, rings in SHAPES.items() if inside(rings, x, y)), default=None), (x, y)
    assert all(got[i]["zone"] is None and not got[i]["tested"] for i in range(len(points) - 4, len(points)))
    if levels == 5:
        assert sum(r["tested"] for r in got.values()) < 0.5 * len(points)


def test_interior_cells_need_no_edge_test(spark):
    shapes = td.zone_shapes_multi(spark, SF_SMALL)
    cover = spatial.quad_cover(shapes, 5000.0).groupBy("interior").agg(F.max(F.size("edges")).alias("edges"), F.count(F.lit(1)).alias("n"))
    rows = {r["interior"]: r for r in cover.collect()}
    assert rows[True]["edges"] == 0 and rows[True]["n"] > 0 and 0 < rows[False]["edges"] < 16


def test_empty_layer(spark):
    shapes = spark.createDataFrame([], "zone_id long, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert spatial.assign_zone_multi(points, "x", "y", spatial.quad_index(shapes), "zone").first()["zone"] is None
