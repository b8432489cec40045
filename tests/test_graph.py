"""Graph operators on the small asymmetric graph with one isolated node (FIXTURES §4)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.operators import graph
from zoneflow.sources import files

EDGES = [(0, 1, 2.0), (1, 0, 1.0), (1, 2, 1.0), (2, 0, 4.0)]


@pytest.fixture()
def g(spark):
    return spark.createDataFrame(EDGES, "src long, dst long, w double")


@pytest.fixture()
def nodes(spark):
    return spark.createDataFrame([(i,) for i in range(4)], "node long")


def cells(df, key=("src", "dst")):
    return {tuple(r[k] for k in key): r["w"] for r in df.collect()}


def close(a, b, tol=1e-6):
    assert set(a) == set(b), (sorted(a), sorted(b))
    for k in a:
        assert math.isclose(a[k], b[k], abs_tol=tol), (k, a[k], b[k])


def test_kernel(g, nodes):
    k = graph.gaussian_kernel(g, nodes).collect()
    assert math.isclose(k[0]["sigma"], 1.060660, abs_tol=1e-6)
    close({(r["src"], r["dst"]): r["w"] for r in k},
          {(0, 1): 0.028566, (1, 0): 0.411112, (1, 2): 0.411112, (2, 0): 0.000001})


def test_kernel_infinite_distance(spark, nodes):
    e = spark.createDataFrame([(0, 1, 1.0), (1, 0, float("inf"))], "src long, dst long, w double")
    k = {(r["src"], r["dst"]): r["w"] for r in graph.gaussian_kernel(e, nodes).collect()}
    assert k[(1, 0)] == 0.0 and 0 < k[(0, 1)] < 1


def test_degrees(g, nodes):
    assert {r["node"]: r["degree"] for r in graph.degrees(g, nodes).collect()} == {0: 2.0, 1: 2.0, 2: 4.0, 3: 0.0}


def test_transition_and_backward(g, nodes):
    close(cells(graph.transition(g)), {(0, 1): 1, (1, 0): 0.5, (1, 2): 0.5, (2, 0): 1})
    d = graph.supports(g, nodes, "doubletransition")
    close(cells(d.filter("support = 1")), {(0, 1): 0.2, (0, 2): 0.8, (1, 0): 1, (2, 1): 1})


def test_sym_normalize_and_laplacians(g, nodes):
    sym = {(0, 1): 0.5, (0, 2): 1.414214, (1, 0): 1.0, (2, 1): 0.353553}
    close(cells(graph.sym_normalize(g)), sym)
    lap = {k: -v for k, v in sym.items()}
    lap.update({(i, i): 1.0 for i in range(4)})
    close(cells(graph.normalized_laplacian(g, nodes)), lap)
    close(cells(graph.scaled_laplacian(g, nodes, 2.0)),
          {(0, 1): -0.471405, (1, 0): -0.471405, (0, 2): -0.730297, (2, 0): -0.730297,
           (1, 2): -0.258199, (2, 1): -0.258199})


def test_symmetrize_and_identity(g, nodes):
    assert cells(graph.symmetrize_max(g)) == {(0, 1): 2, (1, 0): 2, (1, 2): 1, (2, 1): 1, (2, 0): 4, (0, 2): 4}
    assert cells(graph.identity_edges(nodes)) == {(i, i): 1.0 for i in range(4)}


def test_chebyshev_and_diffusion(spark, g, nodes):
    sup = graph.supports(g, nodes, "transition")
    cheb = graph.chebyshev_supports(sup, nodes, 3)
    close(cells(cheb.filter("k = 2")), {(0, 1): 1, (1, 2): 2, (2, 0): 1, (2, 2): -1, (3, 3): -1})
    close(cells(cheb.filter("k = 0")), {(i, i): 1.0 for i in range(4)})
    x = spark.createDataFrame([(0, i, float(i + 1)) for i in range(4)], "t long, zone_id long, x double")
    out = graph.diffusion(x, cheb, ["t"], "zone_id", "x").filter("k = 1")
    assert {r["zone_id"]: r["value"] for r in out.collect()} == {0: 4.0, 1: 1.0, 2: 1.0, 3: 0.0}


def test_double_transition_has_six_chebyshev_supports(g, nodes):
    cheb = graph.chebyshev_supports(graph.supports(g, nodes, "doubletransition"), nodes, 3)
    assert sorted(r[0] for r in cheb.select("k").distinct().collect()) == list(range(6))


def test_unknown_support_kind(g, nodes):
    with pytest.raises(ValueError, match="doubletransition"):
        graph.supports(g, nodes, "nope")


def test_wide_adjacency_csv(spark, scratch):
    path = f"{scratch}/adj.csv"
    with open(path, "w") as f:
        f.write("0,1,2,3\n\n0,2,0,0\n\n1,0,1,0\n\n4,0,0,0\n\n0,0,0,0\n\n")
    e = files.read_adjacency_csv(spark, path)
    assert e.count() == 16
    assert cells(e.filter("w != 0")) == {(0, 1): 2.0, (1, 0): 1.0, (1, 2): 1.0, (2, 0): 4.0}


def test_matrix_file_reads_the_same_in_one_and_in_many_splits(spark, scratch):
    n, rng = 60, np.random.default_rng(3)
    m = rng.integers(0, 2, (n, n))
    path = scratch + "/split.csv"
    with open(path, "w") as f:
        f.write("\n" + ",".join(map(str, range(n))) + "\r\n")
        for i, row in enumerate(m):
            f.write(",".join(map(str, row)) + ("\n\n \n" if i % 7 == 0 else "\n"))
    size = "spark.sql.files.maxPartitionBytes"
    old, opened = spark.conf.get(size), spark.conf.get("spark.sql.files.openCostInBytes")
    want = [(i, j, float(m[i, j])) for i in range(n) for j in range(n)]
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for limit in (old, "150", "97"):
            spark.conf.set(size, limit)
            assert limit == old or spark.read.text(path).rdd.getNumPartitions() > 45
            assert sorted(map(tuple, files.read_adjacency_csv(spark, path).collect())) == want
    finally:
        spark.conf.set(size, old)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)


def _table(spark, m):
    return spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "src long, dst long, w double")


def test_blocked_product_of_a_hub_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = [np.where(rng.random((40, 40)) < 0.1, rng.integers(-3, 4, (40, 40)), 0) for _ in range(2)]
    a[:, 7], b[7, :], a[3, :], b[:, 9] = 1, 2, 1, 1  # a column and a row that hold every node
    want = a @ b
    for cell in (1, 3, 4096):
        got = np.zeros((40, 40))
        for r in graph.matmul_blocked(_table(spark, a), _table(spark, b), cell).collect():
            got[r["src"], r["dst"]] = r["w"]
        assert (got == want).all(), cell
    assert graph.matmul_blocked(_table(spark, a).limit(0), _table(spark, b), 3).count() == 0


def test_blocks_bound_the_products_of_a_key(spark):
    star = spark.range(1, 4001).select(F.col("id").alias("src"), F.lit(0).cast("long").alias("dst"), F.lit(1.0).alias("w"))
    plan = graph.matmul_blocked(star, graph.transpose(star).filter("dst <= 200"), 100)
    assert plan.count() == 4000 * 200 and plan.agg(F.min("w"), F.max("w")).first() == (1.0, 1.0)


def test_measured_eigenvalue_matches_numpy(spark):
    rng = np.random.default_rng(1)
    for n, share in ((30, 0.1), (12, 0.4)):
        m = np.where(rng.random((n, n)) < share, rng.integers(1, 5, (n, n)), 0).astype(float)
        np.fill_diagonal(m, 0)
        m[:, 2] = m[2, :] = 0  # an isolated node
        nodes = spark.range(n).withColumnRenamed("id", "node")
        s = np.maximum(m, m.T)
        d = s.sum(1)
        inv = np.divide(1, np.sqrt(d), out=np.zeros(n), where=d > 0)
        want = np.linalg.eigvalsh(np.eye(n) - inv[:, None] * s * inv[None, :])[-1]
        value, bound = graph.lambda_max(_table(spark, m), nodes)
        assert abs(value - want) < 1e-9 and bound < 1e-8
    value, bound = graph.largest_eigenvalue(_table(spark, np.eye(4)), spark.range(4).withColumnRenamed("id", "node"))
    assert abs(value - 1.0) < 1e-12
    assert graph.largest_eigenvalue(_table(spark, np.eye(4)), spark.range(0).withColumnRenamed("id", "node")) == (0.0, 0.0)
