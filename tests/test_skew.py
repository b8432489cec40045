"""A third of all rows on one key: results stay whole and exact, and the heavy steps
pre-aggregate before they shuffle."""

from pyspark.sql import functions as F

from zoneflow.operators import flows, forecast, history
from zoneflow.plans import catalog as c
from zoneflow.sources import testdata as td

from conftest import SF_CHECK as D


def hot_events(spark):
    ev = td.events(spark, D)
    return ev.withColumn("region_id", F.when(F.hash("time") % 3 == 0, F.lit(7).cast("long"))
                         .otherwise(F.col("region_id")))


def test_hot_zone_windows_are_exact_and_partially_aggregated(spark):
    ev = hot_events(spark)
    w = flows.tumbling_flow(ev, "1 day")
    assert w.agg(F.sum("flow")).first()[0] == ev.count()
    share = ev.filter("region_id = 7").count() / ev.count()
    assert share > 0.3
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 or "partial_count" in plan


def test_hot_zone_forecast_covers_every_series(spark):
    ev = hot_events(spark)
    w = flows.tumbling_flow(ev, "1 day")
    g = history.dense_grid(w, td.zone_dim(spark, D), c.DAY)
    pred = forecast.next_step(g, c.p_edges(spark, D))
    n_types = w.select("flow_type").distinct().count()
    steps = g.select("interval_start").distinct().count()
    assert pred.count() == n_types * 25 * (steps - 12)
    hot = pred.filter("zone_id = 7").agg(F.sum("actual")).first()[0]
    assert hot == g.filter("zone_id = 7").join(pred.select("interval_start").distinct(), "interval_start") \
        .agg(F.sum("flow")).first()[0]
