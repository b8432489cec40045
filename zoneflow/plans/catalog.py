"""Named queries over the test tables: each binds the driver tables to the package's
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.numeric import quantize
from ..operators import anomaly, flows, forecast, graph, history, spatial, trips
from ..operators import events as ev
from ..session import checkpoint_table, shared_path
from ..sources import files
from ..sources import testdata as td
from ..sources.window_table import WindowTable

DAY = 86_400
HISTORY_STEPS = 12
SPLIT_CUT = "1996-07-01"
TAIL_ROWS = 10
FETCH_ROWS = 1000
SOURCE = "trip"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---- shared bindings -------------------------------------------------------------------

def clean(spark, d) -> DataFrame:
    return trips.clean_trips(td.trips(spark, d), td.area(spark, d), td.CLEAN_FROM, td.CLEAN_TO)


def flow_events(spark, d) -> DataFrame:
    return ev.trips_to_events(clean(spark, d))


def day_windows(spark, d) -> DataFrame:
    return flows.tumbling_flow(td.events(spark, d), "1 day")


def day_grid(spark, d) -> DataFrame:
    """The window table is written once; the grid reads it for its range, types and counts."""
    return history.dense_grid(checkpoint_table(day_windows(spark, d), "day_windows"), td.zone_dim(spark, d), DAY)


# ---- sources, projections, filters -----------------------------------------------------

@query("trips")
def q_trips(spark, d):
    return trips.typed_trips(td.trips(spark, d))


@query("zones")
def q_zones(spark, d):
    return td.zone_dim(spark, d)


@query("trips_in_area")
def q_trips_in_area(spark, d):
    return trips.trips_in_area(trips.typed_trips(td.trips(spark, d)), td.area(spark, d))


@query("clean_trips")
def q_clean_trips(spark, d):
    return clean(spark, d)


@query("flow_events")
def q_flow_events(spark, d):
    return flow_events(spark, d)


@query("event_counts")
def q_event_counts(spark, d):
    return ev.event_counts(flow_events(spark, d))


@query("publish_events")
def q_publish_events(spark, d):
    return ev.publish_payload(flow_events(spark, d), SOURCE)


@query("flow_type_parts")
def q_flow_type_parts(spark, d):
    return ev.parse_payload(ev.publish_payload(flow_events(spark, d), SOURCE))


@query("split_history_live")
def q_split(spark, d):
    return trips.split_history_live(flow_events(spark, d), SPLIT_CUT)


@query("events_sorted")
def q_events_sorted(spark, d):
    return ev.sort_events(flow_events(spark, d))


@query("first_live_events")
def q_first_live(spark, d):
    s = trips.split_history_live(flow_events(spark, d), SPLIT_CUT)
    return ev.first_events(s.filter(F.col("part") == "live").drop("part"), TAIL_ROWS)


@query("history_with_tail")
def q_history_with_tail(spark, d):
    s = trips.split_history_live(flow_events(spark, d), SPLIT_CUT).filter(F.col("flow_type") == ev.OUTFLOW)
    hist = s.filter(F.col("part") == "history").drop("part")
    live = s.filter(F.col("part") == "live").drop("part")
    return ev.with_tail(hist, live, TAIL_ROWS)


# ---- windows and joins -----------------------------------------------------------------

@query("tumbling_flow")
def q_tumbling(spark, d):
    return flows.tumbling_flow(flow_events(spark, d), "5 minutes")


@query("event_windows_5min")
def q_event_windows_5min(spark, d):
    return flows.tumbling_flow(td.events(spark, d), "5 minutes")


@query("flow_windows")
def q_flow_windows(spark, d):
    return day_windows(spark, d)


@query("flow_zone_join")
def q_flow_zone_join(spark, d):
    return flows.flow_zone_join(day_windows(spark, d), td.area(spark, d))


@query("unmatched_regions")
def q_unmatched(spark, d):
    return flows.unmatched_regions(day_windows(spark, d), td.area(spark, d))


# ---- history -------------------------------------------------------------------------

@query("time_steps")
def q_time_steps(spark, d):
    return history.time_steps(day_windows(spark, d), DAY, n_steps=HISTORY_STEPS)


@query("load_history")
def q_load_history(spark, d):
    w = checkpoint_table(day_windows(spark, d), "day_windows")
    return files.load_history(w, history.origin(w), DAY, HISTORY_STEPS)


@query("load_step")
def q_load_step(spark, d):
    w = checkpoint_table(day_windows(spark, d), "day_windows")
    return files.load_step(w, history.origin(w), DAY, HISTORY_STEPS)


def compacted_windows(spark: SparkSession, d: str) -> DataFrame:
    """The day windows as a live table: one batch every three days, all but the last two compacted
    in two steps, then a replay of a compacted batch."""
    table = WindowTable(shared_path(spark, "compacted"))
    days = F.datediff(F.to_date("interval_start"), F.lit("1990-01-01").cast("date"))
    w = day_windows(spark, d).filter(F.col("interval_start").isNotNull())
    first = w.agg(F.min(days)).scalar()
    table.write_batches(w.withColumn("batch_id", F.floor((days - first) / 3)))
    ids = table.batch_ids(spark)
    if not ids:  # no windows
        return table.read(spark).drop("batch_id")
    for upto in (ids[len(ids) // 2], ids[max(0, len(ids) - 3)]):
        table.compact(spark, upto)
    replay = table.read(spark).filter(F.col("batch_id") == ids[0]).select("interval_start", "flow_type", "zone_id", "flow")
    table.write_batch(checkpoint_table(replay, "replay"), ids[0])
    return table.read(spark).drop("batch_id")


@query("windows_compacted")
def q_windows_compacted(spark, d):
    return compacted_windows(spark, d).drop("interval_date")


@query("load_step_pruned")
def q_load_step_pruned(spark, d):
    """One step of the compacted table: only the folders of its day are read."""
    w = compacted_windows(spark, d)
    return files.load_step(w, history.origin(w), DAY, HISTORY_STEPS).drop("interval_date")


@query("bounded_fetch")
def q_bounded_fetch(spark, d):
    return day_windows(spark, d).orderBy("interval_start", "flow_type", "zone_id").limit(FETCH_ROWS)


@query("dense_grid")
def q_dense_grid(spark, d):
    return day_grid(spark, d)


@query("dense_grid_rebinned")
def q_dense_grid_rebinned(spark, d):
    """5-minute windows on a 1-hour raster: every window counts in the hour it starts in."""
    w = checkpoint_table(flows.tumbling_flow(td.events(spark, d), "5 minutes"), "windows_5min")
    return history.dense_grid(w, td.zone_dim(spark, d), 3600)


@query("flow_matrix")
def q_flow_matrix(spark, d):
    graph_ids = sorted(r["graph_id"] for r in td.zone_dim(spark, d).select("graph_id").collect())  # one column each
    return history.flow_matrix(day_grid(spark, d), graph_ids)


@query("flow_channels")
def q_flow_channels(spark, d):
    g = day_grid(spark, d)
    types = sorted(r["flow_type"] for r in history.channels(td.events(spark, d)).collect())  # one column each
    return history.flow_channels(g, types)


@query("sliding_history")
def q_sliding_history(spark, d):
    return history.sliding_history(day_grid(spark, d), HISTORY_STEPS)


@query("standardize")
def q_standardize(spark, d):
    return r6(history.standardize(day_grid(spark, d), HISTORY_STEPS), "mu", "sd", "z_last")




# ---- graph ---------------------------------------------------------------------------

def r6(df: DataFrame, *cols: str, bits: int = 24) -> DataFrame:
    """Snap double output columns to 2^-bits (comparison with the oracle only)."""
    return df.select(*[quantize(F.col(c), bits).alias(c) if c in cols else F.col(c) for c in df.columns])


def od_edges(spark, d) -> DataFrame:
    """OD graph of all trips, written once to the shared checkpoint folder: it is small
    (zones^2 rows) and read by many joins and bound checks of the same query."""
    return checkpoint_table(graph.od_graph(trips.typed_trips(td.trips(spark, d))), "od_graph")


def nodes(spark, d) -> DataFrame:
    return td.zone_dim(spark, d).select(F.col("zone_id").alias("node"))


CHEB_ORDER = 3
SPARSE_SHARE = 1.5
SUPPORT_KIND = "doubletransition"


def event_supports(spark, d, materialize: bool = False) -> DataFrame:
    """Chebyshev supports of the forward/backward transition of the OD graph (written once
    to the checkpoint folder when reused by later joins)."""
    n = nodes(spark, d)
    cheb = graph.chebyshev_supports(graph.supports(od_edges(spark, d), n, SUPPORT_KIND), n, CHEB_ORDER,
                                    graph.support_ids(SUPPORT_KIND))
    return checkpoint_table(cheb, "supports") if materialize else cheb


@query("adjacency_edges")
def q_adjacency_edges(spark, d):
    """OD graph written as a wide matrix (one column per destination), read back as edges."""
    zone_ids = sorted(r["zone_id"] for r in td.zone_dim(spark, d).select("zone_id").collect())  # one column each
    wide = (od_edges(spark, d).groupBy("src").pivot("dst", zone_ids).agg(F.sum("w")))
    wide = nodes(spark, d).join(wide, F.col("node") == F.col("src"), "left").drop("src")
    return files.wide_to_edges(wide, "node", [str(z) for z in zone_ids], zone_ids)


@query("degrees")
def q_degrees(spark, d):
    return r6(graph.degrees(od_edges(spark, d), nodes(spark, d)), "degree")


@query("gaussian_kernel")
def q_gaussian_kernel(spark, d):
    return r6(graph.gaussian_kernel(od_edges(spark, d), nodes(spark, d)), "w", "sigma")


@query("transition")
def q_transition(spark, d):
    return r6(graph.transition(od_edges(spark, d)), "w")


@query("double_transition")
def q_double_transition(spark, d):
    return r6(graph.supports(od_edges(spark, d), nodes(spark, d), "doubletransition"), "w")


@query("sym_normalize")
def q_sym_normalize(spark, d):
    return r6(graph.sym_normalize(od_edges(spark, d)), "w")


@query("normalized_laplacian")
def q_normalized_laplacian(spark, d):
    return r6(graph.normalized_laplacian(od_edges(spark, d), nodes(spark, d)), "w")


@query("symmetrize_max")
def q_symmetrize_max(spark, d):
    return graph.symmetrize_max(od_edges(spark, d))


@query("scaled_laplacian")
def q_scaled_laplacian(spark, d):
    return r6(graph.scaled_laplacian(od_edges(spark, d), nodes(spark, d), 2.0), "w")


@query("lambda_max")
def q_lambda_max(spark, d):
    """The measured largest eigenvalue of the normalised Laplacian of the sparse graph, one row."""
    value, _ = graph.lambda_max(sparse_edges(spark, d), nodes(spark, d))
    return r6(spark.range(1).select(F.lit(value).alias("lambda_max")), "lambda_max", bits=20)


@query("scaled_laplacian_measured")
def q_scaled_laplacian_measured(spark, d):
    return r6(graph.scaled_laplacian(sparse_edges(spark, d), nodes(spark, d), None), "w", bits=20)


HUB_CELL = 4  # of the product's blocks: low enough to cut the hub of this small graph


@query("matmul_blocked")
def q_matmul_blocked(spark, d):
    """Two-step transition weights of the sparse graph with one hub that every node reaches and leaves."""
    n = nodes(spark, d)
    hub = n.agg(F.min("node")).scalar()
    spokes = n.filter(F.col("node") != hub).select(F.col("node").alias("src"), hub.alias("dst"), F.lit(1.0).alias("w"))
    hubbed = checkpoint_table(sparse_edges(spark, d).unionByName(spokes).unionByName(graph.transpose(spokes))
                              .groupBy("src", "dst").agg(F.sum("w").alias("w")), "od_hub")
    return graph.matmul_blocked(hubbed, hubbed, HUB_CELL)


@query("identity_edges")
def q_identity_edges(spark, d):
    n = nodes(spark, d)  # the identity has no use for edge weights
    return graph.supports(n.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("w")), n, "identity")


@query("chebyshev_supports")
def q_chebyshev(spark, d):
    return r6(event_supports(spark, d), "w")


def sparse_edges(spark, d) -> DataFrame:
    """The OD graph without its lighter edges: rows and columns become empty, nodes isolated."""
    e = od_edges(spark, d)
    return checkpoint_table(e.filter(F.col("w") > e.agg(F.avg("w")).scalar() * SPARSE_SHARE), "od_sparse")


@query("transition_sparse")
def q_transition_sparse(spark, d):
    return r6(graph.transition(sparse_edges(spark, d)), "w")


@query("double_transition_sparse")
def q_double_transition_sparse(spark, d):
    return r6(graph.supports(sparse_edges(spark, d), nodes(spark, d), "doubletransition"), "w")


@query("sym_normalize_sparse")
def q_sym_normalize_sparse(spark, d):
    return r6(graph.sym_normalize(sparse_edges(spark, d)), "w")


@query("normalized_laplacian_sparse")
def q_normalized_laplacian_sparse(spark, d):
    return r6(graph.normalized_laplacian(sparse_edges(spark, d), nodes(spark, d)), "w")


@query("scaled_laplacian_sparse")
def q_scaled_laplacian_sparse(spark, d):
    return r6(graph.scaled_laplacian(sparse_edges(spark, d), nodes(spark, d), 2.0), "w")


@query("kernel_row_sums")
def q_kernel_row_sums(spark, d):
    n = nodes(spark, d)
    return r6(graph.kernel_row_sums(graph.kernel_correction(sparse_edges(spark, d), n), n), "d")


@query("kernel_diffusion")
def q_kernel_diffusion(spark, d):
    """Dense kernel of the sparse graph -> double transition -> Chebyshev terms of the daily flows."""
    g = checkpoint_table(day_grid(spark, d), "day_grid")
    return r6(graph.kernel_diffusion(g, sparse_edges(spark, d), nodes(spark, d), ["flow_type", "interval_start"]), "value", bits=20)


@query("diffusion_features")
def q_diffusion(spark, d):
    """Every Chebyshev support applied to the daily flow of every (flow type, day)."""
    g = day_grid(spark, d)
    ks = list(range(len(graph.support_ids(SUPPORT_KIND)) * CHEB_ORDER))
    return r6(graph.diffusion(g, event_supports(spark, d, materialize=True), ["flow_type", "interval_start"],
                              "zone_id", "flow", ks), "value")


# ---- forecast and anomalies --------------------------------------------------------------

FIT_CUT = "2024-01-20"
REPORT_THRESHOLD = 2  # of the per-type reports: low enough for rows of several flow types


def p_edges(spark, d) -> DataFrame:
    """Transition matrix of the OD graph, written once (read by every diffusion step)."""
    return checkpoint_table(graph.transition(od_edges(spark, d)), "transition")


def predictions(spark, d) -> DataFrame:
    return forecast.next_step(day_grid(spark, d), p_edges(spark, d))


def residual_table(spark, d) -> DataFrame:
    return anomaly.residuals(predictions(spark, d))


@query("forecast_next")
def q_forecast_next(spark, d):
    return predictions(spark, d)


@query("forecast_horizon")
def q_forecast_horizon(spark, d):
    return forecast.diffusion_forecast(day_grid(spark, d), p_edges(spark, d), DAY, horizon=3)


@query("backtest")
def q_backtest(spark, d):
    return r6(forecast.backtest(predictions(spark, d)), "mae", "mean_actual")


@query("residuals")
def q_residuals(spark, d):
    return residual_table(spark, d)


@query("anomalies")
def q_anomalies(spark, d):
    return anomaly.anomalies(residual_table(spark, d), td.zone_dim(spark, d), REPORT_THRESHOLD)


@query("anomaly_snapshot")
def q_anomaly_snapshot(spark, d):
    return anomaly.snapshot(anomaly.anomalies(residual_table(spark, d), td.zone_dim(spark, d), REPORT_THRESHOLD))


@query("forecast_fitted")
def q_forecast_fitted(spark, d):
    return forecast.fitted_forecast(day_grid(spark, d), p_edges(spark, d), FIT_CUT)


@query("fitted_check")
def q_fitted_check(spark, d):
    """Training rows, feature x target and feature x residual sums of the fitted model."""
    return r6(forecast.fit_check(day_grid(spark, d), p_edges(spark, d), FIT_CUT), "sum_xy", "residual_x", bits=10)


def walk_features(spark, d) -> DataFrame:
    return checkpoint_table(forecast.design(day_grid(spark, d), p_edges(spark, d), HISTORY_STEPS), "features")


@query("backtest_fitted")
def q_backtest_fitted(spark, d):
    """The model of every step: rows and sums it is fitted on, and how far its normal equations are off."""
    models, _ = forecast.walk_forward(walk_features(spark, d), HISTORY_STEPS + 2)
    return r6(models.drop("coef"), "sum_xx", "sum_xy", "residual", bits=10)


@query("backtest_models")
def q_backtest_models(spark, d):
    return r6(forecast.backtest_models(day_grid(spark, d), p_edges(spark, d)), "mae", "mean_actual")


@query("aligned_horizon")
def q_aligned_horizon(spark, d):
    """Every horizon's forecast next to the actual flow of the step it forecasts."""
    g = checkpoint_table(day_grid(spark, d), "day_grid")
    third = forecast.diffusion_forecast(g, p_edges(spark, d), DAY, horizon=3).filter(F.col("horizon") == 3)
    return anomaly.align(g, third)


@query("score_windows")
def q_score_windows(spark, d):
    return forecast.score_windows(day_grid(spark, d), p_edges(spark, d), forecast.diffusion_scorer())


def total_grid(spark, d) -> DataFrame:
    w = checkpoint_table(flows.tumbling_flow(td.events_total(spark, d), "1 day"), "day_windows_total")
    return history.dense_grid(w, td.zone_dim(spark, d), DAY)


def total_residuals(spark, d) -> DataFrame:
    return anomaly.residuals(forecast.next_step(total_grid(spark, d), p_edges(spark, d)))


@query("residuals_total")
def q_residuals_total(spark, d):
    return total_residuals(spark, d)


@query("anomalies_total")
def q_anomalies_total(spark, d):
    return anomaly.anomalies(total_residuals(spark, d), td.zone_dim(spark, d))


@query("anomaly_snapshot_total")
def q_anomaly_snapshot_total(spark, d):
    return anomaly.snapshot(anomaly.anomalies(total_residuals(spark, d), td.zone_dim(spark, d)))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The smoke query of ``__spark_entry__.entry``: actual, forecast and residual of every
    (flow type, zone, day) with 12 days of history."""
    return residual_table(spark, d)


# ---- spatial ---------------------------------------------------------------------------


def area_shapes(spark, d) -> DataFrame:
    return spatial.restrict_shapes(td.zone_shapes(spark, d), td.area(spark, d))


def assigned_bike(spark, d) -> DataFrame:
    return spatial.assign_trip_zones(td.bike_trips(spark, d), area_shapes(spark, d))


@query("project_points")
def q_project_points(spark, d):
    b = td.bike_trips(spark, d)
    x, y = geo.project(F.col("start station latitude"), F.col("start station longitude"))
    return b.select("starttime", quantize(F.col("start station latitude")).alias("lat"),
                    quantize(F.col("start station longitude")).alias("lon"),
                    quantize(x, 10).alias("x"), quantize(y, 10).alias("y"))


@query("zone_shapes")
def q_zone_shapes(spark, d):
    return spatial.shape_summary(area_shapes(spark, d))


@query("zone_assign")
def q_zone_assign(spark, d):
    return assigned_bike(spark, d).select("starttime", "stoptime", "pu_zone", "do_zone")


@query("bike_flow_events")
def q_bike_flow_events(spark, d):
    """Assigned bike trips -> canonical trips -> inflow and outflow events."""
    return ev.trips_to_events(trips.bike_trips(assigned_bike(spark, d)))


@query("bike_windows")
def q_bike_windows(spark, d):
    """5-minute windows of taxi and bike events in one long table."""
    both = ev.with_source(flow_events(spark, d), "taxi").unionByName(
        ev.with_source(ev.trips_to_events(trips.bike_trips(assigned_bike(spark, d))), "bike"))
    return flows.tumbling_flow(both, "5 minutes")


@query("trip_anomalies")
def q_trip_anomalies(spark, d):
    """Trips -> events -> daily windows -> grid -> forecast -> report, all of one chain."""
    w = checkpoint_table(flows.tumbling_flow(ev.trips_to_events(trips.typed_trips(td.trips(spark, d)).dropna()), "7 days"), "trip_windows")
    g = history.dense_grid(w, td.zone_dim(spark, d), 7 * DAY)
    return anomaly.anomalies(anomaly.residuals(forecast.next_step(g, p_edges(spark, d))), td.zone_dim(spark, d), REPORT_THRESHOLD * 4)


@query("zone_assign_multi")
def q_zone_assign_multi(spark, d):
    """Starts of bike trips in zones with holes, islands and parts; null where in none."""
    bike = td.bike_trips(spark, d)
    x, y = geo.project(F.col("start station latitude"), F.col("start station longitude"))
    pts = bike.select("starttime", "stoptime", x.alias("x"), y.alias("y"))
    shapes = spatial.restrict_shapes(td.zone_shapes_multi(spark, d), td.area(spark, d))
    return spatial.assign_zone_multi(pts, "x", "y", spatial.quad_index(shapes), "zone").select("starttime", "stoptime", "zone")


@query("geo_points")
def q_geo_points(spark, d):
    b = assigned_bike(spark, d)
    return spatial.geo_points(b, "start station latitude", "start station longitude", as_text=True).select(
        "starttime", "pu_zone", "location")


@query("flow_map")
def q_flow_map(spark, d):
    return spatial.flow_map(day_windows(spark, d), area_shapes(spark, d))


@query("alias_union")
def q_alias_union(spark, d):
    return spatial.alias_union(day_windows(spark, d), area_shapes(spark, d))
