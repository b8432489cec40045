"""Point -> zone assignment (point-in-polygon join), map joins and the index alias union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import broadcast_if_small, checkpoint_table


def restrict_shapes(shapes: DataFrame, zones: DataFrame) -> DataFrame:
    """Polygons of the wanted zones only (left-semi on the zone ids)."""
    return shapes.join(zones.select("zone_id"), "zone_id", "left_semi")


def shape_summary(shapes: DataFrame) -> DataFrame:
    """``zone_id, n_vertices, xmin, xmax, ymin, ymax`` of each polygon."""
    b = geo.bbox(F.col("ring"))
    return shapes.select("zone_id", F.size("ring").cast("long").alias("n_vertices"),
                         *[v.alias(k) for k, v in b.items()])


def cell_index(shapes: DataFrame, cell: float) -> DataFrame:
    """Grid cells of side ``cell`` covering each polygon's bounding box -> per cell the
    candidate polygons (edges and bounding box precomputed once per polygon), sorted by
    zone id. Size = polygons x covered cells (bounded by the zone layer and the cell
    size, not by the data)."""
    b = geo.bbox(F.col("ring"))
    poly = shapes.select("zone_id", geo.ring_edges(F.col("ring")).alias("edges"),
                         *[v.alias(k) for k, v in b.items()])
    c = poly.select("*", F.floor(F.col("xmin") / cell).alias("x0"), F.floor(F.col("xmax") / cell).alias("x1"),
                    F.floor(F.col("ymin") / cell).alias("y0"), F.floor(F.col("ymax") / cell).alias("y1"))
    c = c.withColumn("cx", F.explode(F.sequence("x0", "x1")))
    c = c.withColumn("cy", F.explode(F.sequence("y0", "y1")))
    cand = F.struct("zone_id", "xmin", "xmax", "ymin", "ymax", "edges")
    return c.groupBy("cx", "cy").agg(F.sort_array(F.collect_list(cand)).alias("candidates"))


def zone_index(shapes: DataFrame, cell: float = 5000.0) -> DataFrame:
    """Cell index ready for ``assign_zone``, written once to the shared checkpoint folder
    and broadcast only if its measured size is small. Beyond that the points are joined to
    it by cell with a shuffle (AQE splits a hot cell)."""
    return broadcast_if_small(cell_index(shapes, cell), "cell_index")


def assign_zone(points: DataFrame, x: str, y: str, shapes: DataFrame | None, out: str, cell: float = 5000.0,
                index: DataFrame | None = None) -> DataFrame:
    """Adds ``out`` = the smallest zone id whose polygon strictly contains (x, y), or null.

    The point's grid cell is an equi-join key against the cell index, so no point x
    polygon product is formed and the exact test runs only on the few candidates of that
    cell. While the index is within its broadcast bound (``zone_index``) the points are
    not shuffled; beyond it the join shuffles by cell.
    """
    idx = index if index is not None else zone_index(shapes, cell)
    pts = points.withColumn("_cx", F.floor(F.col(x) / cell)).withColumn("_cy", F.floor(F.col(y) / cell))
    j = pts.join(idx, (pts["_cx"] == idx["cx"]) & (pts["_cy"] == idx["cy"]), "left")
    px, py = F.col(x), F.col(y)
    hit = F.filter(F.col("candidates"),
                   lambda c: (px > c["xmin"]) & (px < c["xmax"]) & (py > c["ymin"]) & (py < c["ymax"])
                   & geo.strictly_inside_edges(c["edges"], px, py))
    return j.withColumn(out, F.try_element_at(hit, F.lit(1))["zone_id"]).drop("_cx", "_cy", "cx", "cy", "candidates")


QUAD_LEVELS = 5     # a root cell is split at most so many times
QUAD_MARGIN = 1e-6  # cells are widened by this share of their side, so that rounding never makes a border cell interior


def quad_cover(shapes: DataFrame, root: float, levels: int = QUAD_LEVELS) -> DataFrame:
    """``zone_id, rings`` -> leaves of an adaptive quadtree over root cells of side ``root``:
    ``zone_id, rx, ry, level, cx, cy, interior, edges``.

    A cell that no edge touches is interior or left out. A cell on the border is split, down to
    ``levels``; the leaves left on the border keep the edges that decide for their points: those
    that a ray to +x from the cell can meet. The tree is built level by level with joins-free
    array expressions, one row a cell, so a large zone layer is many tasks.
    """
    poly = shapes.select("zone_id", geo.rings_edges(F.col("rings")).alias("all"))
    xs, ys = (F.concat(F.transform("all", lambda e: e[f"{v}1"]), F.transform("all", lambda e: e[f"{v}2"])) for v in "xy")
    poly = poly.where(F.size("all") > 0)
    box = poly.select("*", F.floor(F.array_min(xs) / root).alias("x0"), F.floor(F.array_max(xs) / root).alias("x1"),
                      F.floor(F.array_min(ys) / root).alias("y0"), F.floor(F.array_max(ys) / root).alias("y1"))
    cells = (box.withColumn("cx", F.explode(F.sequence("x0", "x1"))).withColumn("cy", F.explode(F.sequence("y0", "y1")))
             .select("zone_id", F.col("cx").alias("rx"), F.col("cy").alias("ry"), "cx", "cy", F.col("all").alias("near"), "all"))
    leaves = None
    for level in range(levels + 1):
        side = root / 2 ** level
        pad = side * QUAD_MARGIN
        x0, y0 = F.col("cx") * side - pad, F.col("cy") * side - pad
        x1, y1 = x0 + (side + 2 * pad), y0 + (side + 2 * pad)
        cells = cells.withColumn("near", F.filter("near", lambda e: geo.edge_meets_box(e, x0, y0, x1, y1)))
        # edges whose height range meets the cell and that are not wholly to its left
        ray = F.filter("all", lambda e: (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["x1"], e["x2"]) >= x0))
        cells = checkpoint_table(cells.withColumn("all", ray), "quad_cells")
        clear = F.size("near") == 0
        middle = geo.edges_cross(F.col("all"), (F.col("cx") + 0.5) * side, (F.col("cy") + 0.5) * side)
        columns = ["zone_id", "rx", "ry", F.lit(level).alias("level"), "cx", "cy"]
        inside = cells.where(clear & middle).select(*columns, F.lit(True).alias("interior"), F.slice("all", 1, 0).alias("edges"))
        border = cells.where(~clear)
        leaves = inside if leaves is None else leaves.unionByName(inside)
        if level == levels:
            return leaves.unionByName(border.select(*columns, F.lit(False).alias("interior"), F.col("all").alias("edges")))
        quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
        cells = border.withColumn("q", quarter).select("zone_id", "rx", "ry", (F.col("cx") * 2 + F.col("q.i")).alias("cx"), (F.col("cy") * 2 + F.col("q.j")).alias("cy"), "near", "all")


def quad_index(shapes: DataFrame, root: float = 5000.0, levels: int = QUAD_LEVELS) -> DataFrame:
    """The leaves of ``quad_cover`` by root cell, written once and broadcast only if small."""
    leaf = F.struct("zone_id", "level", "cx", "cy", "interior", "edges")
    grouped = quad_cover(shapes, root, levels).groupBy("rx", "ry").agg(F.sort_array(F.collect_list(leaf)).alias("leaves"))
    return broadcast_if_small(grouped, "quad_index")


def assign_zone_multi(points: DataFrame, x: str, y: str, index: DataFrame, out: str, root: float = 5000.0, exact: str | None = None) -> DataFrame:
    """Adds ``out`` = the smallest zone id whose polygon (holes and parts by the even-odd rule)
    strictly contains (x, y), or null. ``index`` is ``quad_index`` with the same ``root``.

    A point meets the leaves of its root cell in an equi-join. An interior leaf that holds the
    point decides at once; only border leaves test edges, and only those a ray can meet. With
    ``exact`` a column of that name tells whether the point needed an edge test. Null or
    non-finite coordinates have no zone.
    """
    px, py = F.col(x), F.col(y)
    fine = F.when(F.abs(px) + F.abs(py) < F.lit(float("inf")), True)
    pts = points.withColumn("_rx", F.when(fine, F.floor(px / root))).withColumn("_ry", F.when(fine, F.floor(py / root)))
    j = pts.join(index, (pts["_rx"] == index["rx"]) & (pts["_ry"] == index["ry"]), "left")

    def holds(c):
        side = F.lit(root) / F.pow(F.lit(2.0), c["level"])
        return (F.floor(px / side) == c["cx"]) & (F.floor(py / side) == c["cy"])
    held = F.filter("leaves", holds)
    j = j.withColumn("_held", held)
    hit = F.filter("_held", lambda c: c["interior"] | geo.strictly_inside_edges(c["edges"], px, py))
    j = j.withColumn(out, F.array_min(F.transform(hit, lambda c: c["zone_id"])))
    if exact:
        j = j.withColumn(exact, F.coalesce(F.exists("_held", lambda c: ~c["interior"]), F.lit(False)))
    return j.drop("_rx", "_ry", "rx", "ry", "leaves", "_held")


def assign_trip_zones(bike: DataFrame, shapes: DataFrame, cell: float = 5000.0) -> DataFrame:
    """Bike trips with station coordinates -> ``starttime, stoptime, pu_zone, do_zone``:
    both ends projected to feet, assigned by the point-in-polygon join, trips with an
    unassigned end dropped (``dropna`` on the zone columns)."""
    sx, sy = geo.project(F.col("start station latitude"), F.col("start station longitude"))
    ex, ey = geo.project(F.col("end station latitude"), F.col("end station longitude"))
    pts = bike.select("*", sx.alias("_sx"), sy.alias("_sy"), ex.alias("_ex"), ey.alias("_ey"))
    idx = zone_index(shapes, cell)
    pts = assign_zone(pts, "_sx", "_sy", None, "pu_zone", cell, idx)
    pts = assign_zone(pts, "_ex", "_ey", None, "do_zone", cell, idx)
    return pts.dropna(how="any", subset=["pu_zone", "do_zone"]).drop("_sx", "_sy", "_ex", "_ey")


def geo_points(df: DataFrame, lat: str, lon: str, out: str = "location", as_text: bool = False) -> DataFrame:
    """(lat, lon) pair as a map-ready geo point: a struct, or with ``as_text`` the
    ``"lat,lon"`` text form (6 decimals) that map indexes accept for geo points."""
    if as_text:
        return df.withColumn(out, F.format_string("%.6f,%.6f", F.col(lat), F.col(lon)))
    return df.withColumn(out, F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")))


def flow_map(flows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Flows joined with their zone outline (bounding box here) for map display."""
    return flows.join(shape_summary(shapes), "zone_id")


def alias_union(flows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Two indexes read as one: rows side by side, missing columns null."""
    return flows.unionByName(shape_summary(shapes), allowMissingColumns=True)
