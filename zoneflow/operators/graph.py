"""Graph operators on sparse edge tables ``(src, dst, w)`` (``src`` = matrix row).

Cells absent from the table are 0. Results keep only non-zero cells. Node sets are
zone dimensions; edge tables are at most N^2 rows, and the degree / support tables that
every product joins against are broadcast only if their measured size is small (see
``session.broadcast_if_small``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, checkpoint_table

# Names of the support types (fixed values).
SUPPORT_KINDS = ("scalap", "normlap", "symnadj", "transition", "doubletransition", "identity")


def support_ids(kind: str) -> list[int]:
    """Support indices produced by ``supports(kind)``."""
    return [0, 1] if kind == "doubletransition" else [0]


def edges_of(df: DataFrame) -> DataFrame:
    return df.select(F.col("src").cast("long"), F.col("dst").cast("long"), F.col("w").cast("double"))


def nonzero(df: DataFrame) -> DataFrame:
    return df.filter(F.col("w") != 0.0)


def transpose(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w", *[
        c for c in edges.columns if c not in ("src", "dst", "w")])


def od_graph(trips: DataFrame) -> DataFrame:
    """Origin-destination graph: number of trips per (origin zone, destination zone)."""
    return (trips.filter(F.col("pu_zone").isNotNull() & F.col("do_zone").isNotNull())
            .groupBy(F.col("pu_zone").alias("src"), F.col("do_zone").alias("dst"))
            .agg(F.count(F.lit(1)).cast("double").alias("w")))


def identity_edges(nodes: DataFrame) -> DataFrame:
    """Unit diagonal over the node set (column ``node``)."""
    return nodes.select(F.col("node").cast("long").alias("src"), F.col("node").cast("long").alias("dst"),
                        F.lit(1.0).alias("w"))


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Weighted out-degree ``d_i = sum_j A_ij`` of every node (0 without out-edges)."""
    d = edges.groupBy("src").agg(F.sum("w").alias("degree"))
    return (nodes.select(F.col("node").cast("long"))
            .join(broadcast_if_small(d, "degrees"), F.col("node") == F.col("src"), "left")
            .select("node", F.coalesce("degree", F.lit(0.0)).alias("degree")))


def _row_sums(edges: DataFrame) -> DataFrame:
    """Non-zero row sums; rows with sum 0 have none."""
    return broadcast_if_small(edges.groupBy("src").agg(F.sum("w").alias("_d")).filter(F.col("_d") != 0.0), "row_sums")


def finite(col: Column) -> Column:
    return ~F.isnan(col) & ~col.isin(float("inf"), float("-inf"))


def kernel_sigma(edges: DataFrame, n_nodes: Column) -> Column:
    """Population std of every finite cell of the N x N matrix (absent cells count as 0),
    computed in two passes (mean, then squared deviations) as scalar subqueries."""
    cells = (n_nodes * n_nodes).cast("double")
    n_inf = edges.agg(F.count(F.when(~finite(F.col("w")), 1))).scalar()
    m = cells - n_inf
    mean = edges.agg(F.sum(F.when(finite(F.col("w")), F.col("w")))).scalar() / m
    stats = edges.filter(finite(F.col("w"))).agg(
        F.sum(F.pow(F.col("w") - mean, 2)).alias("ss"), F.count(F.lit(1)).alias("k"))
    ss = stats.select("ss").scalar()
    k = stats.select("k").scalar()
    return F.sqrt((F.coalesce(ss, F.lit(0.0)) + (m - k) * mean * mean) / m)


def gaussian_kernel(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``exp(-(w / sigma)^2)`` on the stored cells, infinite distances -> 0.

    Absent cells (w = 0) have kernel value 1; they are implied, not materialised, so the
    result stays as sparse as the input. It is not a weight table for the sparse operators,
    which read absent cells as 0: use ``kernel_correction`` and ``kernel_diffusion``.
    ``sigma`` is returned as a column.
    """
    sigma = kernel_sigma(edges, nodes.agg(F.count(F.lit(1))).scalar())
    k = F.when(finite(F.col("w")), F.exp(-F.pow(F.col("w") / sigma, 2))).otherwise(F.lit(0.0))
    return edges.select("src", "dst", F.col("w").alias("w_in"), k.alias("w"), sigma.alias("sigma"))


def kernel_correction(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The kernel matrix as all-ones plus these sparse cells ``src, dst, w`` = kernel - 1."""
    k = gaussian_kernel(edges, nodes)
    return nonzero(k.select("src", "dst", (F.col("w") - 1.0).alias("w")))


def kernel_row_sums(correction: DataFrame, nodes: DataFrame) -> DataFrame:
    """Row sums ``node, d`` of the dense kernel: N plus the row's corrections."""
    n = nodes.agg(F.count(F.lit(1))).scalar()
    c = correction.groupBy("src").agg(F.sum("w").alias("_c"))
    return (nodes.select(F.col("node").cast("long")).join(broadcast_if_small(c, "kernel_rows"), F.col("node") == F.col("src"), "left")
            .select("node", (n + F.coalesce("_c", F.lit(0.0))).alias("d")))


def _apply_kernel(state: DataFrame, keys: list[str], sums: DataFrame, cells: DataFrame) -> DataFrame:
    """``(P^T x)_i = sum_j K_ji x_j / d_j`` for P = the row-normalised kernel with row sums
    ``sums``: the block's sum of ``x_j / d_j`` (the all-ones part) plus the corrections, which
    ``cells`` lists by j. Linear in nodes and stored cells; rows with sum 0 add nothing."""
    y = F.when(F.col("d") != 0, F.col("x") / F.col("d")).otherwise(F.lit(0.0))
    s = state.join(sums, state["zone_id"] == sums["node"]).withColumn("y", y).withColumn("total", F.sum("y").over(Window.partitionBy(*keys)))
    j = s.join(cells, s["zone_id"] == cells["_j"], "left")
    own = F.struct(F.col("zone_id").alias("i"), F.col("total").alias("v"))
    rest = F.transform(F.coalesce(F.col("_cells"), F.array().cast("array<struct<i:bigint,w:double>>")),
                       lambda c: F.struct(c["i"].alias("i"), (c["w"] * F.col("y")).alias("v")))
    parts = j.select(*keys, F.inline(F.concat(F.array(own), rest)))
    return parts.groupBy(*keys, F.col("i").alias("zone_id")).agg(F.sum("v").alias("x"))


def kernel_diffusion(signal: DataFrame, edges: DataFrame, nodes: DataFrame, keys: list[str], value_col: str = "flow",
                     order: int = 3) -> DataFrame:
    """The configured chain dense kernel -> double transition -> Chebyshev terms, applied to a
    signal that has every node in every group of ``keys``: ``T0 x = x``, ``T1 x = p x``,
    ``Tk x = 2 p T(k-1) x - T(k-2) x`` with p the transposed forward (support 0) or backward
    (support 1) transition. The recurrence runs on the signal, so no product of matrices and
    no dense matrix is formed. Output ``keys, k, zone_id, value`` with k = support * order + degree.
    """
    correction = checkpoint_table(kernel_correction(edges, nodes), "kernel_correction")
    x0 = signal.select(*keys, F.col("zone_id").cast("long"), F.col(value_col).cast("double").alias("x")).repartition(*keys)
    out = None
    for support, c in enumerate((correction, transpose(correction))):
        sums = broadcast_if_small(kernel_row_sums(c, nodes), "kernel_sums")
        cells = c.groupBy(F.col("src").alias("_j")).agg(F.collect_list(F.struct(F.col("dst").alias("i"), "w")).alias("_cells"))
        cells = broadcast_if_small(cells, "kernel_cells")
        terms = [x0]
        for degree in range(1, order):
            nxt = _apply_kernel(terms[-1], keys, sums, cells)
            if degree > 1:
                both = nxt.withColumn("x", F.col("x") * 2).unionByName(terms[-2].withColumn("x", -F.col("x")))
                nxt = both.groupBy(*keys, "zone_id").agg(F.sum("x").alias("x"))
            terms.append(nxt)
        for degree, t in enumerate(terms[:order]):
            t = t.select(*keys, F.lit(support * order + degree).cast("long").alias("k"), "zone_id", F.col("x").alias("value"))
            out = t if out is None else out.unionByName(t)
    return out


def transition(edges: DataFrame) -> DataFrame:
    """Row-normalised ``A_ij / d_i`` (rows with d = 0 stay empty)."""
    d = _row_sums(edges)
    return nonzero(edges.join(d, "src").select("src", "dst", (F.col("w") / F.col("_d")).alias("w")))


def double_transition(edges: DataFrame) -> DataFrame:
    """Forward and backward transition supports, tagged ``support`` 0 and 1."""
    return (transition(edges).withColumn("support", F.lit(0))
            .unionByName(transition(transpose(edges)).withColumn("support", F.lit(1))))


def _inv_sqrt_degrees(edges: DataFrame) -> DataFrame:
    d = edges.groupBy("src").agg(F.sum("w").alias("d"))
    inv = F.when(F.col("d") > 0, F.lit(1.0) / F.sqrt("d")).otherwise(F.lit(0.0))
    return broadcast_if_small(d.select(F.col("src").alias("node"), inv.alias("inv")), "inv_sqrt_degrees")


def sym_normalize(edges: DataFrame) -> DataFrame:
    """``(A D^-1/2)^T D^-1/2``: cell (i, j) = ``A_ji / sqrt(d_i d_j)``, d = row sums of A,
    0 where a degree is 0 (so the cell of an edge lands transposed)."""
    inv = _inv_sqrt_degrees(edges)
    a = inv.select(F.col("node").alias("_a"), F.col("inv").alias("_ia"))
    b = inv.select(F.col("node").alias("_b"), F.col("inv").alias("_ib"))
    out = (edges.join(a, F.col("src") == F.col("_a")).join(b, F.col("dst") == F.col("_b"))
           .select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                   (F.col("w") * F.col("_ia") * F.col("_ib")).alias("w")))
    return nonzero(out)


def _cell_sum(parts: DataFrame) -> DataFrame:
    keys = [c for c in parts.columns if c != "w"]
    return nonzero(parts.groupBy(*keys).agg(F.sum("w").alias("w")))


def normalized_laplacian(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``I - D^-1/2 A D^-1/2`` (in the transposed form of ``sym_normalize``)."""
    neg = sym_normalize(edges).select("src", "dst", (-F.col("w")).alias("w"))
    return _cell_sum(identity_edges(nodes).unionByName(neg))


def symmetrize_max(edges: DataFrame) -> DataFrame:
    """Element-wise ``max(A, A^T)``; a cell missing on one side counts as 0."""
    both = edges.unionByName(transpose(edges))
    return nonzero(both.groupBy("src", "dst").agg(F.greatest(F.max("w"), F.lit(0.0)).alias("w")))


def scaled_laplacian(edges: DataFrame, nodes: DataFrame, lambda_max: float | None = 2.0,
                     undirected: bool = True) -> DataFrame:
    """``(2 / lambda_max) L - I`` with L the normalised Laplacian of ``max(A, A^T)``.

    ``lambda_max`` is an argument (default 2); None measures it (``largest_eigenvalue``).
    """
    a = symmetrize_max(edges) if undirected else edges
    if lambda_max is None:
        lambda_max, _ = largest_eigenvalue(checkpoint_table(normalized_laplacian(a, nodes), "laplacian"), nodes)
    lap = normalized_laplacian(a, nodes).select("src", "dst", (F.col("w") * (2.0 / lambda_max)).alias("w"))
    neg_i = identity_edges(nodes).select("src", "dst", F.lit(-1.0).alias("w"))
    return _cell_sum(lap.unionByName(neg_i))


def supports(edges: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """Support matrices of one named kind, tagged with a ``support`` index."""
    if kind == "scalap":
        out = scaled_laplacian(edges, nodes).withColumn("support", F.lit(0))
    elif kind == "normlap":
        out = normalized_laplacian(edges, nodes).withColumn("support", F.lit(0))
    elif kind == "symnadj":
        out = sym_normalize(edges).withColumn("support", F.lit(0))
    elif kind == "transition":
        out = transition(edges).withColumn("support", F.lit(0))
    elif kind == "doubletransition":
        out = double_transition(edges)
    elif kind == "identity":
        out = identity_edges(nodes).withColumn("support", F.lit(0))
    else:
        raise ValueError(f"unknown support type {kind!r}; expected one of {', '.join(SUPPORT_KINDS)}")
    return out.select(F.col("support").cast("long"), "src", "dst", "w")


def matmul(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("support",)) -> DataFrame:
    """Sparse product per key: ``C_ij = sum_k A_ik B_kj`` as a join on ``a.dst = b.src``."""
    kk = list(keys)
    aa = a.select(*[F.col(k).alias(f"_a_{k}") for k in kk], F.col("src").alias("_src"), F.col("dst").alias("_mid"),
                  F.col("w").alias("_aw"))
    bb = broadcast_if_small(
        b.select(*[F.col(k).alias(f"_b_{k}") for k in kk], F.col("src").alias("_bmid"), F.col("dst").alias("_dst"),
                 F.col("w").alias("_bw")), "factor")
    cond = [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in kk] + [F.col("_mid") == F.col("_bmid")]
    j = aa.join(bb, cond)
    return nonzero(j.groupBy(*[F.col(f"_a_{k}").alias(k) for k in kk], F.col("_src").alias("src"),
                             F.col("_dst").alias("dst"))
                   .agg(F.sum(F.col("_aw") * F.col("_bw")).alias("w")))


def matmul_blocked(a: DataFrame, b: DataFrame, cell: int = 4096) -> DataFrame:
    """``C = A B`` on edge tables ``src, dst, w`` with two-dimensional blocks for hubs.

    The entries of column k of A meet those of row k of B. A node k with more than ``cell``
    entries on a side is cut there into blocks by the hash of the other index; its blocks
    meet pairwise, each pair of about ``cell`` x ``cell`` products under a key of its own. So
    a hub's products spread over many tasks, other nodes keep one key, and nothing is
    replicated for them. Cells that sum to 0 are left out.
    """
    def blocks(n: Column) -> Column:
        return F.ceil(F.coalesce(n, F.lit(1)) / F.lit(cell)).cast("int")

    left = a.groupBy(F.col("dst").alias("_k")).agg(F.count(F.lit(1)).alias("_na"))
    right = b.groupBy(F.col("src").alias("_k")).agg(F.count(F.lit(1)).alias("_nb"))
    cut = left.join(right, "_k").where((F.col("_na") > cell) | (F.col("_nb") > cell))
    cut = broadcast_if_small(cut.select("_k", blocks(F.col("_na")).alias("_rows"), blocks(F.col("_nb")).alias("_cols")), "hub_blocks")

    def dealt(side: DataFrame, node: str, other: str, own: str, across: str) -> DataFrame:
        j = side.join(cut, side[node] == cut["_k"], "left")
        n_own, n_across = F.coalesce(own, F.lit(1)), F.coalesce(across, F.lit(1))
        return j.select(F.col(node).alias("_mid"), F.col(other).alias(f"_{other}"), F.col("w").alias(f"_w{other}"),
                        F.pmod(F.xxhash64(other), n_own).cast("int").alias(own), F.explode(F.sequence(F.lit(0), n_across - 1)).alias(across))

    x = dealt(a.select("src", "dst", "w"), "dst", "src", "_rows", "_cols")
    y = dealt(b.select("src", "dst", "w"), "src", "dst", "_cols", "_rows")
    products = x.join(y, ["_mid", "_rows", "_cols"])
    return nonzero(products.groupBy(F.col("_src").alias("src"), F.col("_dst").alias("dst"))
                   .agg(F.sum(F.col("_wsrc") * F.col("_wdst")).alias("w")))


def _dots(rows: DataFrame) -> list[float]:
    """Inner products of ``v`` with the vectors whose entries ``q`` lists, and with itself."""
    parts = rows.select("v", F.posexplode(F.concat("q", F.array("v"))).alias("i", "x"))
    return [r[1] for r in sorted(parts.groupBy("i").agg(F.sum(F.col("x") * F.col("v"))).collect())]  # a row a basis vector


def largest_eigenvalue(edges: DataFrame, nodes: DataFrame, tolerance: float = 1e-10, max_steps: int = 64) -> tuple[float, float]:
    """Largest eigenvalue of the symmetric matrix ``edges`` and a bound on its error.

    Lanczos steps: each multiplies the last basis vector by the edge table (a join and an
    aggregation), makes it orthogonal to the whole basis twice, and writes the basis, one row a
    node with at most ``max_steps`` numbers; the driver holds the small tridiagonal matrix
    alone. It stops when the residual of the largest Ritz pair, which bounds the distance to an
    eigenvalue, is at most ``tolerance`` times the value, or the vectors reached span an
    invariant space, or after ``max_steps`` (the bound then says how good the value is). The
    start has hash-random entries, so it isn't orthogonal to a wanted vector but by chance. No
    nodes: (0, 0).
    """
    e = edges_of(edges)
    unit = F.pmod(F.xxhash64(F.col("node").cast("long"), F.lit(17)), F.lit(1 << 20)) / float(1 << 19) - 1.0
    start = nodes.select(F.col("node").cast("long")).distinct().select("node", unit.alias("x"))
    norm = start.agg(F.sqrt(F.sum(F.col("x") * F.col("x")))).first()[0]
    if not norm:
        return 0.0, 0.0
    basis = checkpoint_table(start.select("node", F.array(F.col("x") / norm).alias("q")), "lanczos")
    alpha: list[float] = []
    beta: list[float] = []
    while True:
        k = len(alpha)
        moved = (e.join(basis.select(F.col("node").alias("dst"), F.col("q")[k].alias("x")), "dst")
                 .groupBy(F.col("src").alias("node")).agg(F.sum(F.col("w") * F.col("x")).alias("v")))
        rows = basis.join(moved, "node", "left").select("node", "q", F.coalesce("v", F.lit(0.0)).alias("v"))
        rows = checkpoint_table(rows, "lanczos")
        for turn in range(2):
            dots = _dots(rows)  # with every basis vector, then v's own
            alpha[k:] = [dots[k] + (alpha[k] if turn else 0.0)]
            along = F.zip_with("q", F.array(*map(F.lit, dots[:-1])), lambda x, d: x * d)
            rows = rows.withColumn("v", F.col("v") - F.aggregate(along, F.lit(0.0), lambda acc, x: acc + x))
        length = float(np.sqrt(max(0.0, dots[-1] - sum(x * x for x in dots[:-1]))))
        t = np.diag(alpha) + np.diag(beta, 1) + np.diag(beta, -1)
        values, vectors = np.linalg.eigh(t)
        bound = length * abs(vectors[-1, -1])
        if bound <= tolerance * abs(values[-1]) or length <= 1e-12 or len(alpha) == max_steps:
            return float(values[-1]), float(bound)
        beta.append(length)
        basis = checkpoint_table(rows.select("node", F.concat("q", F.array(F.col("v") / length)).alias("q")), "lanczos")


def lambda_max(edges: DataFrame, nodes: DataFrame, undirected: bool = True, tolerance: float = 1e-10) -> tuple[float, float]:
    """``largest_eigenvalue`` of the normalised Laplacian that ``scaled_laplacian`` scales (of
    ``max(A, A^T)``; a directed graph's Laplacian must be symmetric itself)."""
    lap = checkpoint_table(normalized_laplacian(symmetrize_max(edges) if undirected else edges, nodes), "laplacian")
    return largest_eigenvalue(lap, nodes, tolerance)


def chebyshev_supports(sup: DataFrame, nodes: DataFrame, order: int = 3,
                       support_ids: list[int] | None = None) -> DataFrame:
    """Chebyshev polynomials of each support: ``p = S^T``, ``T0 = I``, ``T1 = p``,
    ``Tk = 2 p T(k-1) - T(k-2)``. Output ``k = support * order + degree`` with all
    ``order`` terms of every support (``doubletransition`` -> 6 matrices for order 3)."""
    p = transpose(sup.select("support", "src", "dst", "w")).select("support", "src", "dst", "w")
    ids = support_ids if support_ids is not None else [r[0] for r in sup.select("support").distinct().collect()]
    eye = identity_edges(nodes).select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("support"),
                                       "src", "dst", "w")
    terms = [eye, p]
    for _ in range(2, order):
        prod = matmul(p, terms[-1]).select("support", "src", "dst", (F.col("w") * 2.0).alias("w"))
        prev = terms[-2].select("support", "src", "dst", (-F.col("w")).alias("w"))
        terms.append(_cell_sum(prod.unionByName(prev)))
    out = None
    for deg, t in enumerate(terms[:order]):
        t = t.select(((F.col("support") * order) + deg).cast("long").alias("k"), "src", "dst", "w")
        out = t if out is None else out.unionByName(t)
    return out


def diffusion(signal: DataFrame, sup: DataFrame, keys: list[str], zone_col: str = "zone_id",
              value_col: str = "x", support_ks: list[int] | None = None) -> DataFrame:
    """Graph diffusion ``(S_k x)_i = sum_j S_k[i, j] x_j`` for every support ``k`` and every
    signal group ``keys``; nodes without neighbours get 0.

    Scatter-gather: each signal value x_j meets the broadcast list of the cells
    ``(k, i, S_k[i, j])`` of its column j, is exploded into one term per cell plus a zero
    term per support for itself, and one aggregation per (group, k, i) sums them. The
    signal is read once; no node x support product is joined.
    """
    ks = support_ks if support_ks is not None else [r[0] for r in sup.select("k").distinct().collect()]
    cols = broadcast_if_small(
        sup.groupBy(F.col("dst").cast("long").alias("_j")).agg(
            F.collect_list(F.struct(F.col("k").cast("long").alias("k"), F.col("src").cast("long").alias("i"),
                                    F.col("w").cast("double").alias("w"))).alias("_cells")),
        "support_columns")
    sig = signal.select(*keys, F.col(zone_col).cast("long").alias("_z"), F.col(value_col).cast("double").alias("_x"))
    sig = sig.repartition(*keys)  # the one shuffle: the aggregation below keeps this partitioning
    j = sig.join(cols, sig["_z"] == cols["_j"], "left")
    cells = F.transform(F.coalesce(F.col("_cells"), F.array().cast("array<struct<k:bigint,i:bigint,w:double>>")),
                        lambda c: F.struct(c["k"].alias("k"), c["i"].alias("i"), (c["w"] * F.col("_x")).alias("v")))
    zeros = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.col("_z").alias("i"), F.lit(0.0).alias("v"))
                      for k in ks])
    parts = j.select(*keys, F.inline(F.concat(cells, zeros)))
    return parts.groupBy(*keys, "k", F.col("i").alias(zone_col)).agg(F.sum("v").alias("value"))
