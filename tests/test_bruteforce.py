"""Graph and spatial operators against brute force on random small inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from zoneflow.operators import graph, spatial

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def dense(rows, n):
    m = np.zeros((n, n))
    for r in rows:
        m[r["src"], r["dst"]] += r["w"]
    return m


def inv(x, p):
    out = np.zeros_like(x)
    nz = x != 0
    out[nz] = x[nz] ** p
    return out


graphs = st.integers(3, 6).flatmap(lambda n: st.tuples(
    st.just(n),
    st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 9)), min_size=1, max_size=12,
             unique_by=lambda e: (e[0], e[1]))))


@SETTINGS
@given(graphs)
def test_supports_match_numpy(spark, g):
    n, edges = g
    a = np.zeros((n, n))
    for s, d, w in edges:
        a[s, d] = w
    e = spark.createDataFrame([(s, d, float(w)) for s, d, w in edges], "src long, dst long, w double")
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node long")
    d = a.sum(1)
    trans = np.diag(inv(d, -1.0)) @ a
    sym = (a @ np.diag(inv(d, -0.5))).T @ np.diag(inv(d, -0.5))
    am = np.maximum(a, a.T)
    dm = am.sum(1)
    lap_m = np.eye(n) - (am @ np.diag(inv(dm, -0.5))).T @ np.diag(inv(dm, -0.5))
    expect = {
        "transition": trans,
        "symnadj": sym,
        "normlap": np.eye(n) - sym,
        "scalap": lap_m - np.eye(n),
        "identity": np.eye(n),
    }
    for kind, m in expect.items():
        got = dense(graph.supports(e, nodes, kind).collect(), n)
        assert np.allclose(got, m, atol=1e-9), kind
    p = trans.T
    cheb = graph.chebyshev_supports(graph.supports(e, nodes, "transition"), nodes, 3, [0]).collect()
    for k, m in enumerate([np.eye(n), p, 2 * p @ p - np.eye(n)]):
        assert np.allclose(dense([r for r in cheb if r["k"] == k], n), m, atol=1e-9)
    x = np.arange(1, n + 1, dtype=float)
    sig = spark.createDataFrame([(0, i, float(x[i])) for i in range(n)], "g long, zone_id long, x double")
    cheb_df = graph.chebyshev_supports(graph.supports(e, nodes, "transition"), nodes, 3, [0])
    out = graph.diffusion(sig, cheb_df, ["g"], "zone_id", "x", [0, 1, 2]).collect()
    for k, m in enumerate([np.eye(n), p, 2 * p @ p - np.eye(n)]):
        got = np.zeros(n)
        for r in out:
            if r["k"] == k:
                got[r["zone_id"]] = r["value"]
        assert np.allclose(got, m @ x, atol=1e-9)


CONCAVE = [(2, 0), (4, 0), (4, 2), (3, 1), (2, 2)]
SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2)]


def inside_strict(poly, x, y):
    n = len(poly)
    inside = False
    for i in range(n):
        (x1, y1), (x2, y2) = poly[i], poly[(i + 1) % n]
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if abs(cross) < 1e-12 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


@SETTINGS
@given(st.lists(st.tuples(st.integers(-2, 18), st.integers(-2, 10)), min_size=5, max_size=40))
def test_point_in_polygon_matches_brute_force(spark, pts):
    pts = [(x / 4.0, y / 4.0) for x, y in pts]           # quarter grid: many border and vertex hits
    shapes = spark.createDataFrame(
        [(1, [{"x": float(a), "y": float(b)} for a, b in SQUARE]),
         (2, [{"x": float(a), "y": float(b)} for a, b in CONCAVE])],
        "zone_id long, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, x double, y double")
    got = {r["pid"]: r["zone"] for r in spatial.assign_zone(df, "x", "y", shapes, "zone", cell=0.75).collect()}
    for i, (x, y) in enumerate(pts):
        want = 1 if inside_strict(SQUARE, x, y) else (2 if inside_strict(CONCAVE, x, y) else None)
        assert got[i] == want, (x, y, got[i], want)


windows_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 9), st.integers(0, 6), st.integers(1, 9)),
                      min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1], r[2]))


@SETTINGS
@given(windows_st, st.integers(0, 3), st.integers(5, 9))
def test_dense_grid_matches_brute_force(spark, rows, lo, hi):
    """Zones 0..4 form the dimension (5 and 6 are rejects); the grid spans days lo..hi."""
    import datetime as dt

    from zoneflow.operators import history

    t0 = dt.datetime(2024, 1, 1)
    w = spark.createDataFrame([(ft, t0 + dt.timedelta(days=d), z, n) for ft, d, z, n in rows],
                              "flow_type string, interval_start timestamp_ntz, zone_id long, flow long")
    zones = spark.createDataFrame([(z, 10 + z, f"z{z}") for z in range(5)], "zone_id long, graph_id long, zone_name string")
    lo_t, hi_t = t0 + dt.timedelta(days=lo), t0 + dt.timedelta(days=hi)
    got = {(r["flow_type"], r["interval_start"], r["zone_id"]): (r["graph_id"], r["flow"])
           for r in history.dense_grid(w, zones, 86400, t0=lo_t, t1=hi_t, flow_types=["a", "b"]).collect()}
    obs = {(ft, t0 + dt.timedelta(days=d), z): n for ft, d, z, n in rows}
    want = {(ft, t0 + dt.timedelta(days=d), z): (10 + z, obs.get((ft, t0 + dt.timedelta(days=d), z), 0))
            for ft in ["a", "b"] for d in range(lo, hi + 1) for z in range(5)}
    assert got == want
