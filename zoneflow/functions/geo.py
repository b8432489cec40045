"""Geometry as Catalyst expressions (no UDF): lat/lon -> state-plane feet, strict
point-in-polygon with an explicit on-edge test, polygon bounding boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# NAD83 / New York Long Island, US survey feet (Lambert conformal conic, two
# standard parallels) on the GRS 1980 ellipsoid, as given by the zone projection file.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
FALSE_EASTING_FT = 984250.0
FALSE_NORTHING_FT = 0.0
CENTRAL_MERIDIAN = -74.0
STANDARD_PARALLEL_1 = 40.66666666666666
STANDARD_PARALLEL_2 = 41.03333333333333
LATITUDE_OF_ORIGIN = 40.16666666666666
US_FOOT_M = 0.3048006096012192


def _lcc_constants():
    f = 1.0 / GRS80_INV_F
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        es = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (STANDARD_PARALLEL_1, STANDARD_PARALLEL_2, LATITUDE_OF_ORIGIN))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


_E, _N, _F, _RHO0 = _lcc_constants()


def project(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Geodetic (degrees) -> (x, y) in US survey feet. The WGS84 -> NAD83 datum shift
    (about a metre) is treated as zero."""
    phi = F.radians(lat)
    es = F.sin(phi) * _E
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(_E / 2))
    rho = F.pow(t, F.lit(_N)) * (GRS80_A * _F)
    theta = F.radians(lon - F.lit(CENTRAL_MERIDIAN)) * _N
    x = (rho * F.sin(theta)) / US_FOOT_M + FALSE_EASTING_FT
    y = (F.lit(_RHO0) - rho * F.cos(theta)) / US_FOOT_M + FALSE_NORTHING_FT
    return x, y


def ring_edges(ring: Column) -> Column:
    """Polygon ring (array of {x, y}) -> array of edges {x1, y1, x2, y2}, closing the ring."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, nxt, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                                                       b["x"].alias("x2"), b["y"].alias("y2")))


def on_boundary(ring: Column, px: Column, py: Column, eps: float = 1e-9) -> Column:
    """True when the point lies on an edge (collinear and inside the edge's extent)."""
    return edges_touch(ring_edges(ring), px, py, eps)


def edges_touch(edges: Column, px: Column, py: Column, eps: float = 1e-9) -> Column:
    """``on_boundary`` over a precomputed edge array."""
    def on_edge(e):
        dx = e["x2"] - e["x1"]
        dy = e["y2"] - e["y1"]
        cross = dx * (py - e["y1"]) - dy * (px - e["x1"])
        tol = (F.abs(dx) + F.abs(dy) + F.lit(1.0)) * eps
        return ((F.abs(cross) <= tol)
                & (px >= F.least(e["x1"], e["x2"]) - eps) & (px <= F.greatest(e["x1"], e["x2"]) + eps)
                & (py >= F.least(e["y1"], e["y2"]) - eps) & (py <= F.greatest(e["y1"], e["y2"]) + eps))
    return F.exists(edges, on_edge)


def crosses(ring: Column, px: Column, py: Column) -> Column:
    """Even-odd rule: the number of edges a ray to +x crosses is odd."""
    return edges_cross(ring_edges(ring), px, py)


def edges_cross(edges: Column, px: Column, py: Column) -> Column:
    """``crosses`` over a precomputed edge array."""
    def crossing(e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        x_at = F.when(e["y2"] != e["y1"],
                      (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
        return straddles & (px < x_at)
    return (F.size(F.filter(edges, crossing)) % 2) == 1


def strictly_inside(ring: Column, px: Column, py: Column) -> Column:
    """Point in the polygon's interior; points on the border are outside."""
    return crosses(ring, px, py) & ~on_boundary(ring, px, py)


def strictly_inside_edges(edges: Column, px: Column, py: Column) -> Column:
    """``strictly_inside`` over a precomputed edge array."""
    return edges_cross(edges, px, py) & ~edges_touch(edges, px, py)


def bbox(ring: Column) -> dict[str, Column]:
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def rings_edges(rings: Column) -> Column:
    """Edges of all rings of a polygon (outer rings, holes, islands, further parts). The even-odd
    rule over all of them together tells the inside, whatever the order of the rings."""
    return F.flatten(F.transform(rings, ring_edges))


def edge_meets_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """True unless the edge surely misses the closed box: their extents overlap and the corners
    of the box are not all on one side of the edge's line."""
    extents = ((F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1)
               & (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1))
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    sides = [dx * (y - e["y1"]) - dy * (x - e["x1"]) for x in (x0, x1) for y in (y0, y1)]
    return extents & ~((F.least(*sides) > 0) | (F.greatest(*sides) < 0))
