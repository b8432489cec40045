"""The live detector is idempotent per batch id and agrees with the batch backtest."""

from pyspark.sql import functions as F

from zoneflow.operators import anomaly, flows, forecast, history
from zoneflow.plans import catalog as c
from zoneflow.session import shared_path
from zoneflow.sources import sinks
from zoneflow.sources import testdata as td
from zoneflow.streaming import live

from conftest import SF_CHECK as D


def test_replayed_batches_do_not_duplicate(spark):
    zones = td.zone_dim(spark, D)
    p = c.p_edges(spark, D)
    w = flows.tumbling_flow(td.events_total(spark, D), "1 day")
    days = sorted(r[0] for r in w.select("interval_start").distinct().collect())
    first, second = days[:15], days[15:25]
    det = live.LiveDetector(shared_path(spark, "live_test"), zones, p, c.DAY)
    b0 = w.filter(F.col("interval_start").isin(first))
    b1 = w.filter(F.col("interval_start").isin(second))
    det(b0, 0)
    det(b1, 1)
    det(b1, 1)          # replay after a failure
    det(b0.limit(0), 2)  # empty trigger
    stored = spark.read.parquet(det.windows_path)
    assert stored.count() == b0.count() + b1.count()
    got = sorted(tuple(r) for r in live.read_anomalies(spark, det)
                 .select("interval_start", "zone_id", "residual").collect())
    # batch reference over the same 25 closed days
    grid = history.dense_grid(w.filter(F.col("interval_start") <= days[24]), zones, c.DAY)
    want_df = anomaly.anomalies(anomaly.residuals(forecast.next_step(grid, p)), zones)
    want = sorted(tuple(r) for r in want_df.select("interval_start", "zone_id", "residual").collect())
    assert got == want
    snap = sinks.read_snapshot(spark, det.snapshot_path).collect()
    newest = [r for r in want if r[0] == days[24]]
    assert len(snap) == len(newest) and sorted(r["doc_id"] for r in snap) == list(range(len(snap)))


def test_compacted_windows_and_a_new_detector_give_the_same_anomalies(spark):
    """Batches of six days; the window table is compacted every two batches, and every batch is run by
    a detector that has just started (as after a restart), each twice."""
    zones = td.zone_dim(spark, D)
    p = c.p_edges(spark, D)
    w = flows.tumbling_flow(td.events_total(spark, D), "1 day").persist()
    days = sorted(r[0] for r in w.select("interval_start").distinct().collect())[:30]
    base = shared_path(spark, "live_test")
    for k in range(5):
        b = w.filter(F.col("interval_start").isin(days[6 * k:6 * k + 6]))
        for _ in range(2):
            det = live.LiveDetector(base, zones, p, c.DAY, compact_every=2)
            det(b, k)
    runs = det.windows.manifest(spark)
    assert runs and runs[-1]["last"] == 3 and det.windows.open_batches(spark) == [4]
    kept = w.filter(F.col("interval_start") <= days[-1])
    assert det.windows.read(spark).count() == kept.count()
    got = sorted(tuple(r) for r in live.read_anomalies(spark, det).select("interval_start", "zone_id", "residual").collect())
    want = anomaly.anomalies(anomaly.residuals(forecast.next_step(history.dense_grid(kept, zones, c.DAY), p)), zones)
    assert got == sorted(tuple(r) for r in want.select("interval_start", "zone_id", "residual").collect())
    w.unpersist()
