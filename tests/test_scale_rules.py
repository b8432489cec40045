"""Rules that hold at any size: measured broadcasts, trigger-independent stream counts,
zero rows, dense kernel, grids off the raster, ordered logs, session settings."""

import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow import session
from zoneflow.operators import events, flows, forecast, graph, history
from zoneflow.plans import catalog, streams
from zoneflow.sources import sinks
from zoneflow.sources import testdata as td
from zoneflow.streaming import source, tumbling

from conftest import SF_CHECK as D


def test_a_compressible_table_is_not_broadcast(spark):
    big = session.checkpoint_table(spark.range(3_000_000).select((F.col("id") % 2).alias("k"), F.lit(0).cast("long").alias("v")), "constant")
    assert session.measured_bytes(big) >= 3_000_000 * 16
    assert "ResolvedHint" not in session.broadcast_if_small(big)._jdf.queryExecution().analyzed().toString()
    small = spark.range(10)
    assert "ResolvedHint" in session.broadcast_if_small(small)._jdf.queryExecution().analyzed().toString()


def test_measured_bytes_follow_content(spark):
    df = spark.createDataFrame([("x" * 1000, [1, 2, 3], None), (None, None, [[1.0] * 100])], "a string, b array<long>, c array<array<double>>")
    assert 1000 + 24 + 24 + 800 <= session.measured_bytes(df) <= 2500


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_stream_counts_do_not_depend_on_the_trigger(spark, scratch, per_trigger):
    evs = td.events(spark, D)
    got = streams.tumbling_windows(spark, evs, scratch, n_files=4, per_trigger=per_trigger)
    last = evs.agg(F.max("time")).scalar()
    want = flows.tumbling_flow(evs, "5 minutes").filter(F.col("interval_start") + F.make_dt_interval(mins=F.lit(5)) <= last)
    columns = ["interval_start", "flow_type", "zone_id", "flow"]
    assert got.count() == want.count() and got.select(columns).exceptAll(want.select(columns)).count() == 0


def test_dropped_rows_fail_the_stream(spark, scratch):
    rows = [("a", f"2024-01-01 0{h}:00:00", 1) for h in range(1, 9)]
    df = spark.createDataFrame(rows, "flow_type string, t string, region_id long").select("flow_type", F.col("t").cast("timestamp_ntz").alias("time"), "region_id")
    late = df.orderBy(F.desc("time")).coalesce(1)  # newest first
    late.repartitionByRange(4, F.desc("time")).write.parquet(f"{scratch}/log")
    sinks.order_files(spark, f"{scratch}/log")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/log")
    q = tumbling.start_append(tumbling.stream_tumbling(stream, "5 minutes", "0 seconds"), f"{scratch}/out", f"{scratch}/ckpt")
    with pytest.raises(RuntimeError, match="after their window was closed"):
        tumbling.finish(q)


def test_stray_topics_and_fractions_of_seconds(spark):
    ev = spark.createDataFrame([("inflow", "2024-01-01 00:00:01.250001", 3), ("outflow", "2024-01-01 00:00:02", 4)], "flow_type string, t string, region_id long")
    ev = ev.select("flow_type", F.col("t").cast("timestamp_ntz").alias("time"), "region_id")
    back = events.parse_payload(events.publish_payload(ev, "nyc_taxi"))
    assert back.exceptAll(ev).count() == 0 and back.count() == 2
    stray = spark.createDataFrame([("weather", '{"region_id":1,"time":"2024-01-01 00:00:00"}'), (None, "{}")], "topic string, value string")
    valid, rejects = source.split_rejects(events.parse_payload(stray))
    assert valid.count() == 0 and rejects.count() == 2


def test_state_partitions_are_required_on_a_cluster(spark):
    class Cluster:
        class sparkContext:
            master = "yarn"
    with pytest.raises(ValueError), tumbling.state_partitions(Cluster, None):
        pass


def test_an_active_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = session.build_session()
        assert again.conf.get("spark.sql.shuffle.partitions") == "13" and again.sparkContext.master == spark.sparkContext.master
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


EDGES = [(0, 1, 2.0), (1, 0, 1.0), (1, 2, 1.0), (2, 0, 4.0), (3, 3, 0.0), (3, 1, 0.0)]


def test_rows_of_zeros_have_no_transition(spark):
    e = spark.createDataFrame(EDGES, "src long, dst long, w double")
    got = {(r["src"], r["dst"]): r["w"] for r in graph.transition(e).collect()}
    assert got == {(0, 1): 1.0, (1, 0): 0.5, (1, 2): 0.5, (2, 0): 1.0}
    back = {(r["src"], r["dst"]): r["w"] for r in graph.double_transition(e).filter("support = 1").collect()}
    assert back == {(0, 1): 0.2, (0, 2): 0.8, (1, 0): 1.0, (2, 1): 1.0}


def dense_kernel(a):
    finite = a[np.isfinite(a)]
    k = np.exp(-np.square(a / finite.std()))
    k[~np.isfinite(a)] = 0
    return k


def test_dense_kernel_cells(spark):
    nodes = spark.range(4).select(F.col("id").alias("node"))
    e = spark.createDataFrame(EDGES[:4], "src long, dst long, w double")
    k = np.ones((4, 4))
    for r in graph.kernel_correction(e, nodes).collect():
        k[r["src"], r["dst"]] += r["w"]
    want = np.ones((4, 4))
    want[0, 1], want[1, 0], want[1, 2], want[2, 0] = 0.028566, 0.411112, 0.411112, 0.000001
    assert np.allclose(k, want, atol=1e-6)


def test_kernel_of_the_real_size(spark):
    """69 nodes and 332 edges of weight 1: sigma and kernel value of FIXTURES section 4."""
    cells = [(i // 69, i % 69, 1.0) for i in range(0, 69 * 69, 14)][:332]
    e, nodes = spark.createDataFrame(cells, "src long, dst long, w double"), spark.range(69).select(F.col("id").alias("node"))
    r = graph.gaussian_kernel(e, nodes).first()
    assert len(cells) == 332 and math.isclose(r["sigma"], 0.254697, abs_tol=1e-6) and math.isclose(r["w"], 2.0193e-7, rel_tol=1e-3)


def test_kernel_diffusion_matches_dense_matrices(spark):
    rng = np.random.default_rng(0)
    n, order = 9, 4
    a = rng.uniform(0, 5, (n, n)) * (rng.uniform(size=(n, n)) < 0.25)
    a[4] = a[:, 4] = 0
    a[1, 2] = np.inf
    e = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(n) for j in range(n) if a[i, j]], "src long, dst long, w double")
    x = rng.integers(0, 20, (2, n))
    signal = spark.createDataFrame([(f"t{t}", i, int(x[t, i])) for t in range(2) for i in range(n)], "flow_type string, zone_id long, flow long")
    got = graph.kernel_diffusion(signal, e, spark.range(n).select(F.col("id").alias("node")), ["flow_type"], order=order).collect()
    k = dense_kernel(a)
    assert len(got) == 2 * 2 * order * n
    for support, m in enumerate((k, k.T)):
        p = (m / m.sum(axis=1, keepdims=True)).T
        terms = [np.eye(n), p]
        for _ in range(2, order):
            terms.append(2 * p @ terms[-1] - terms[-2])
        for r in got:
            if r["k"] // order == support:
                assert math.isclose(r["value"], (terms[r["k"] % order] @ x[int(r["flow_type"][1])])[r["zone_id"]], abs_tol=1e-9)


def test_grid_off_the_raster_loses_nothing(spark):
    rows = [("a", 5 * i, z, 1) for i in range(7) for z in (1, 2)] + [("a", 5, 99, 4), (None, 5, 1, 8), ("a", 500, 1, 16)]
    w = spark.createDataFrame(rows, "flow_type string, m int, zone_id long, flow long")
    w = w.select("flow_type", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("m"))).alias("interval_start"), "zone_id", "flow")
    zones = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "zone_id long, graph_id long")
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 30)
    grid = history.dense_grid(w, zones, 600, t0, t1)
    assert grid.count() == 4 * 3 and grid.agg(F.sum("flow")).first()[0] == 14
    out = history.outside_grid(w, zones, 600, t0, t1)
    assert sorted(r["flow"] for r in out.collect()) == [4, 8, 16]


def test_a_grid_of_many_zones_is_planned_quickly(spark):
    zones = spark.range(10_000).select(F.col("id").alias("zone_id"), F.col("id").alias("graph_id"))
    w = catalog.day_windows(spark, D)
    start = time.time()
    grid = history.dense_grid(session.checkpoint_table(w, "w"), zones, catalog.DAY)
    grid._jdf.queryExecution().optimizedPlan()
    assert time.time() - start < 20
    assert grid.count() == 10_000 * 30 * 5


def test_horizons_share_one_shuffle(spark):
    g = session.checkpoint_table(catalog.day_grid(spark, D), "grid")
    df = forecast.diffusion_forecast(g, catalog.p_edges(spark, D), catalog.DAY, horizon=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(flow_type#\d+, zone_id", plan)) == 1  # the series windows
    assert len(re.findall(r"Exchange hashpartitioning\(flow_type#\d+, interval_start", plan)) == 1


def test_sorted_events_are_in_order_over_partitions(spark):
    out = events.sort_events(td.events(spark, D), 4)
    rows = out.select(F.spark_partition_id().alias("p"), "time", "flow_type", "region_id").collect()
    assert len({r["p"] for r in rows}) == 4
    by_part = {}
    for r in rows:
        by_part.setdefault(r["p"], []).append((r["time"], r["flow_type"], r["region_id"]))
    flat = [x for p in sorted(by_part) for x in by_part[p]]
    assert flat == sorted(flat)


def test_reports_hold_several_flow_types(spark):
    found = catalog.q_anomalies(spark, D)
    assert found.select("flow_type").distinct().count() > 1 and catalog.q_anomaly_snapshot(spark, D).count() > 0
