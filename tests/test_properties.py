"""Invariants of the operators on the sf0.001 tables."""

from pyspark.sql import functions as F

from zoneflow.operators import anomaly, events, flows, forecast, graph, history
from zoneflow.plans import catalog as c
from zoneflow.sources import testdata as td

from conftest import SF_SMALL as D


def test_two_events_per_clean_trip(spark):
    assert c.flow_events(spark, D).count() == 2 * c.clean(spark, D).count()


def test_window_counts_sum_to_events(spark):
    ev = td.events(spark, D)
    total = flows.tumbling_flow(ev, "5 minutes").agg(F.sum("flow")).first()[0]
    assert total == ev.count()


def test_grid_is_dense(spark):
    w = c.day_windows(spark, D)
    g = c.day_grid(spark, D)
    lo, hi = w.agg(F.min("interval_start"), F.max("interval_start")).first()
    steps = int((hi - lo).total_seconds() // c.DAY) + 1
    n_types = w.select("flow_type").distinct().count()
    assert g.count() == steps * 25 * n_types
    assert g.agg(F.sum("flow")).first()[0] == w.agg(F.sum("flow")).first()[0]


def test_transition_rows_sum_to_one(spark):
    t = graph.transition(c.od_edges(spark, D)).groupBy("src").agg(F.sum("w").alias("s"))
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in t.collect())


def test_history_is_ordered_oldest_first(spark):
    g = c.day_grid(spark, D)
    h = history.with_history(g, 12).select("history", "last").collect()
    assert all(r["history"][-1] == r["last"] and len(r["history"]) == 12 for r in h)


def test_numpy_block_scorer_matches_join_forecast(spark):
    """The same horizon-1 diffusion, once as joins and once per block in pandas."""
    p = c.p_edges(spark, D)
    g = c.day_grid(spark, D)
    a = {(r["flow_type"], r["interval_start"], r["zone_id"]): r["forecast"]
         for r in forecast.next_step(g, p).collect()}
    b = {(r["flow_type"], r["interval_start"], r["zone_id"]): r["forecast"]
         for r in forecast.score_windows(g, p, forecast.diffusion_scorer()).collect()}
    assert a == b and len(a) > 0


def test_horizon_one_equals_next_step(spark):
    g = c.day_grid(spark, D)
    p = c.p_edges(spark, D)
    h = forecast.diffusion_forecast(g, p, c.DAY, 3)
    one = {(r["flow_type"], r["interval_start"], r["zone_id"]): r["forecast"] for r in h.filter("horizon = 1").collect()}
    nxt = {(r["flow_type"], r["interval_start"], r["zone_id"]): r["forecast"] for r in forecast.next_step(g, p).collect()}
    assert one == nxt
    assert h.filter("horizon = 3").count() == len(one)


def test_fitted_forecast_only_after_cut(spark):
    out = c.QUERIES["forecast_fitted"](spark, D)
    rows = out.collect()
    assert rows and all(str(r["interval_start"]) >= c.FIT_CUT for r in rows)
    assert all(r["forecast"] is not None for r in rows)


def test_anomaly_threshold_is_strict(spark):
    res = spark.createDataFrame([("a", 0, 10, 0), ("a", 1, 11, 0)], "flow_type string, zone_id long, actual long, forecast long")
    res = anomaly.residuals(res.withColumn("interval_start", F.lit("2024-01-01").cast("timestamp_ntz")))
    z = spark.createDataFrame([(0, 0, "z0"), (1, 1, "z1")], "zone_id long, graph_id long, zone_name string")
    assert [r["zone_id"] for r in anomaly.anomalies(res, z, 10).collect()] == [1]


def test_split_is_a_partition(spark):
    s = events.trips_to_events(c.clean(spark, D))
    tagged = c.trips.split_history_live(s, c.SPLIT_CUT)
    assert tagged.filter(F.col("part").isNull()).count() == 0
    assert tagged.count() == s.count()


def test_raw_string_trips_are_cast_with_rejects(spark):
    raw = spark.createDataFrame(
        [("2019-02-01 00:10:00", "2019-02-01 00:20:00", "4", "12"), ("2019-02-31 23:59:59", "x", "4", "oops")],
        "pickup string, dropoff string, pu_zone string, do_zone string")
    t = c.trips.typed_trips(raw).collect()
    assert t[0]["pu_zone"] == 4 and t[1]["pickup"] is None and t[1]["do_zone"] is None
    assert c.trips.trip_rejects(raw).count() == 1


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"flow_type", "zone_id", "interval_start", "actual", "forecast", "residual"}
