"""Every catalog query against its DuckDB SQL on the sf0.001 tables (the driver does the
same at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

from conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


PLANNED = """trips zones zone_shapes adjacency_edges stream_source stream_passthrough load_history load_step
publish_events stream_tumbling anomaly_snapshot clean_trips flow_events anomalies flow_type_parts geo_points
split_history_live zone_assign gaussian_kernel time_steps flow_zone_join trips_in_area unmatched_regions
residuals flow_map alias_union chebyshev_supports tumbling_flow degrees standardize event_counts
symmetrize_max dense_grid flow_matrix flow_channels sliding_history forecast_next events_sorted
first_live_events bounded_fetch history_with_tail project_points live_anomalies transition double_transition
sym_normalize normalized_laplacian scaled_laplacian identity_edges diffusion_features forecast_horizon
forecast_fitted score_windows backtest""".split()


def test_every_query_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(PLANNED) <= set(E.queries()), sorted(set(PLANNED) - set(E.queries()))


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    r = compare(spark, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL, con)
    assert r["values_ok"], r
