"""DuckDB SQL equivalents of the catalog queries (views: the driver's test tables).

Every computed column carries the same alias as on the Spark side; doubles are rounded to
6 places on both sides.
"""

from __future__ import annotations

from ..functions import geo as _geo
from ..functions.numeric import quantize_sql

ORACLE: dict[str, str] = {}

TRIPS = """
SELECT o.o_orderdate AS pickup, l.l_shipdate AS dropoff,
       CAST(c.c_nationkey AS BIGINT) AS pu_zone, CAST(s.s_nationkey AS BIGINT) AS do_zone
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey"""

ZONES_ALL = """
SELECT CAST(n_nationkey AS BIGINT) AS zone_id,
       CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS graph_id,
       n_name AS zone_name, n_regionkey AS region
FROM nation"""

BASE = f"""
WITH trips AS ({TRIPS}),
zones_all AS ({ZONES_ALL}),
zones AS (SELECT zone_id, graph_id, zone_name FROM zones_all),
area AS (SELECT zone_id, graph_id, zone_name FROM zones_all WHERE region <= 1),
clean AS (
  SELECT * FROM trips
  WHERE pickup >= TIMESTAMP '1996-01-01' AND pickup < TIMESTAMP '1997-01-01'
    AND dropoff >= TIMESTAMP '1996-01-01' AND dropoff < TIMESTAMP '1997-01-01'
    AND pu_zone IN (SELECT zone_id FROM area) AND do_zone IN (SELECT zone_id FROM area)),
fe AS (
  SELECT 'inflow' AS flow_type, dropoff AS time, do_zone AS region_id FROM clean
  UNION ALL
  SELECT 'outflow' AS flow_type, pickup AS time, pu_zone AS region_id FROM clean),
split AS (
  SELECT *, CASE WHEN time < TIMESTAMP '1996-07-01' THEN 'history' ELSE 'live' END AS part FROM fe),
ev AS (SELECT event_type AS flow_type, ts AS time, CAST(user_id % 25 AS BIGINT) AS region_id FROM events),
w AS (
  SELECT time_bucket(INTERVAL 1 DAY, time) AS interval_start, flow_type, region_id AS zone_id,
         count(*) AS flow
  FROM ev WHERE time IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL),
rng AS (SELECT min(interval_start) AS t0, max(interval_start) AS t1 FROM w),
types AS (SELECT DISTINCT flow_type FROM w),
steps AS (SELECT unnest(generate_series(t0, t1, INTERVAL 1 DAY)) AS interval_start FROM rng),
grid AS (
  SELECT g.flow_type, g.interval_start, g.zone_id, g.graph_id, coalesce(w.flow, 0) AS flow
  FROM (SELECT t.flow_type, s.interval_start, z.zone_id, z.graph_id
        FROM types t CROSS JOIN steps s CROSS JOIN zones z) g
  LEFT JOIN w USING (flow_type, interval_start, zone_id)),
hist AS (
  SELECT *,
    count(*) OVER hw AS n_hist,
    avg(flow) OVER hw AS mu,
    CASE WHEN stddev_pop(flow) OVER hw > 0 THEN stddev_pop(flow) OVER hw ELSE 1.0 END AS sd,
    lag(flow, 1) OVER sw AS last
  FROM grid
  WINDOW hw AS (PARTITION BY flow_type, zone_id ORDER BY interval_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
         sw AS (PARTITION BY flow_type, zone_id ORDER BY interval_start))
"""


def q(name: str, body: str) -> None:
    ORACLE[name] = BASE + body


def snap_rounding(sql: str) -> str:
    """Rewrite every ``round(expr, k)`` into binary snapping (see ``functions.numeric``):
    k = 6 -> 2^-24, k = 4 -> 2^-10, k = 9 -> 2^-20."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        out.append(sql[i:j])
        k, depth, comma = j + 6, 1, None
        while depth:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if ch == "," and depth == 1:
                comma = k
            k += 1
        bits = {"6": 24, "4": 10, "9": 20}[sql[comma + 1:k - 1].strip()]
        out.append(quantize_sql(snap_rounding(sql[j + 6:comma]), bits))
        i = k


q("trips", "SELECT * FROM trips")
q("zones", "SELECT * FROM zones")
q("trips_in_area", """SELECT * FROM trips
  WHERE pu_zone IN (SELECT zone_id FROM area) AND do_zone IN (SELECT zone_id FROM area)""")
q("clean_trips", "SELECT * FROM clean")
q("flow_events", "SELECT * FROM fe")
q("event_counts", "SELECT flow_type, count(*) AS n_events FROM fe GROUP BY flow_type")
q("publish_events", """SELECT 'trip_' || flow_type AS topic,
  '{"region_id":' || CAST(region_id AS VARCHAR) || ',"time":"' || strftime(time, '%Y-%m-%d %H:%M:%S.%f') || '"}' AS value
  FROM fe""")
q("flow_type_parts", """SELECT split_part(topic, '_', 2) AS flow_type,
  CAST(json_extract_string(value, '$.time') AS TIMESTAMP) AS time,
  CAST(json_extract(value, '$.region_id') AS BIGINT) AS region_id
  FROM (SELECT 'trip_' || flow_type AS topic,
    '{"region_id":' || CAST(region_id AS VARCHAR) || ',"time":"' || strftime(time, '%Y-%m-%d %H:%M:%S.%f') || '"}' AS value
    FROM fe) m""")
q("split_history_live", "SELECT * FROM split")
q("events_sorted", "SELECT * FROM fe ORDER BY time, flow_type, region_id")
q("first_live_events", """SELECT flow_type, time, region_id FROM split WHERE part = 'live'
  ORDER BY time, flow_type, region_id LIMIT 10""")
q("history_with_tail", """SELECT flow_type, time, region_id FROM split WHERE part = 'history' AND flow_type = 'outflow'
  UNION ALL
  (SELECT flow_type, time, region_id FROM split WHERE part = 'live' AND flow_type = 'outflow'
   ORDER BY time, flow_type, region_id LIMIT 10)""")
q("tumbling_flow", """SELECT time_bucket(INTERVAL 5 MINUTE, time) AS interval_start, flow_type, region_id AS zone_id,
  count(*) AS flow FROM fe WHERE time IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL""")
q("event_windows_5min", """SELECT time_bucket(INTERVAL 5 MINUTE, time) AS interval_start, flow_type,
  region_id AS zone_id, count(*) AS flow FROM ev WHERE time IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL""")
q("flow_windows", "SELECT * FROM w")
q("flow_zone_join", """SELECT w.zone_id, w.interval_start, w.flow_type, w.flow, a.graph_id, a.zone_name
  FROM w LEFT JOIN area a ON w.zone_id = a.zone_id""")
q("unmatched_regions", "SELECT * FROM w WHERE zone_id NOT IN (SELECT zone_id FROM area)")
q("time_steps", """SELECT * FROM (
  SELECT w.*, CAST(floor(date_diff('second', rng.t0, w.interval_start) / 86400.0) AS BIGINT) AS step
  FROM w, rng) WHERE step BETWEEN 0 AND 11""")
q("load_history", """SELECT w.* FROM w, rng
  WHERE w.interval_start >= rng.t0 AND w.interval_start < rng.t0 + INTERVAL 12 DAY""")
q("load_step", "SELECT w.* FROM w, rng WHERE w.interval_start = rng.t0 + INTERVAL 12 DAY")
q("windows_compacted", "SELECT * FROM w WHERE interval_start IS NOT NULL")
q("load_step_pruned", "SELECT w.* FROM w, rng WHERE w.interval_start = rng.t0 + INTERVAL 12 DAY")
q("bounded_fetch", "SELECT * FROM w ORDER BY interval_start, flow_type, zone_id LIMIT 1000")
q("dense_grid", "SELECT * FROM grid")
q("dense_grid_rebinned", """, w5 AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, time) AS s, flow_type, region_id AS zone_id, count(*) AS flow
  FROM ev WHERE time IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL),
  r5 AS (SELECT min(s) AS t0, max(s) AS t1 FROM w5),
  steps5 AS (SELECT unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS interval_start FROM r5),
  o5 AS (SELECT flow_type, zone_id, t0 + to_hours(CAST(floor(date_diff('second', t0, s) / 3600) AS BIGINT)) AS interval_start, sum(flow) AS flow
         FROM w5, r5 GROUP BY ALL)
  SELECT t.flow_type, s.interval_start, z.zone_id, z.graph_id, CAST(coalesce(o.flow, 0) AS BIGINT) AS flow
  FROM types t CROSS JOIN steps5 s CROSS JOIN zones z
  LEFT JOIN o5 o ON o.flow_type = t.flow_type AND o.interval_start = s.interval_start AND o.zone_id = z.zone_id""")
q("flow_matrix", "SELECT flow_type, interval_start, "
  + ", ".join(f"CAST(coalesce(sum(CASE WHEN graph_id = {g} THEN flow END), 0) AS BIGINT) AS g{g}" for g in range(25))
  + " FROM grid GROUP BY flow_type, interval_start")
q("flow_channels", "SELECT interval_start, zone_id, "
  + ", ".join(f"CAST(coalesce(sum(CASE WHEN flow_type = '{t}' THEN flow END), 0) AS BIGINT) AS \"{t}\""
              for t in ["click", "error", "purchase", "signup", "view"])
  + " FROM grid GROUP BY interval_start, zone_id")
q("sliding_history", """SELECT flow_type, zone_id, interval_start, flow,
  concat_ws(',', """ + ", ".join(f"CAST(lag(flow, {k}) OVER sw AS VARCHAR)" for k in range(12, 0, -1)) + """) AS history
  FROM grid
  WINDOW hw AS (PARTITION BY flow_type, zone_id ORDER BY interval_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
         sw AS (PARTITION BY flow_type, zone_id ORDER BY interval_start)
  QUALIFY count(*) OVER hw = 12""")
q("standardize", """SELECT flow_type, zone_id, interval_start, round(mu, 6) AS mu, round(sd, 6) AS sd,
  round((last - mu) / sd, 6) AS z_last FROM hist WHERE n_hist = 12""")

# ---- graph ---------------------------------------------------------------------------
GRAPH = """,
nodes AS (SELECT zone_id AS node FROM zones),
g AS (SELECT pu_zone AS src, do_zone AS dst, CAST(count(*) AS DOUBLE) AS w FROM trips
      WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL GROUP BY ALL),
deg AS (SELECT src, sum(w) AS d FROM g GROUP BY src),
degt AS (SELECT dst AS src, sum(w) AS d FROM g GROUP BY dst),
tr0 AS (SELECT g.src, g.dst, g.w / deg.d AS w FROM g JOIN deg USING (src)),
tr1 AS (SELECT g.dst AS src, g.src AS dst, g.w / degt.d AS w FROM g JOIN degt ON g.dst = degt.src),
sup AS (SELECT CAST(0 AS BIGINT) AS support, * FROM tr0 UNION ALL SELECT CAST(1 AS BIGINT), * FROM tr1),
p AS (SELECT support, dst AS src, src AS dst, w FROM sup),
eye AS (SELECT s.support, n.node AS src, n.node AS dst, 1.0::DOUBLE AS w
        FROM (SELECT DISTINCT support FROM sup) s CROSS JOIN nodes n),
p2 AS (SELECT a.support, a.src, b.dst, sum(a.w * b.w) AS w FROM p a JOIN p b
       ON a.support = b.support AND a.dst = b.src GROUP BY ALL),
t2 AS (SELECT support, src, dst, sum(w) AS w FROM
         (SELECT support, src, dst, 2 * w AS w FROM p2 UNION ALL SELECT support, src, dst, -w FROM eye)
       GROUP BY ALL HAVING sum(w) <> 0),
cheb AS (SELECT support * 3 AS k, src, dst, w FROM eye
         UNION ALL SELECT support * 3 + 1, src, dst, w FROM p
         UNION ALL SELECT support * 3 + 2, src, dst, w FROM t2),
isq AS (SELECT src AS node, CASE WHEN d > 0 THEN 1.0 / sqrt(d) ELSE 0.0 END AS inv FROM deg),
sym AS (SELECT g.dst AS src, g.src AS dst, g.w * a.inv * b.inv AS w
        FROM g JOIN isq a ON g.src = a.node JOIN isq b ON g.dst = b.node),
nlap AS (SELECT src, dst, sum(w) AS w FROM
           (SELECT node AS src, node AS dst, 1.0::DOUBLE AS w FROM nodes UNION ALL SELECT src, dst, -w FROM sym WHERE w <> 0)
         GROUP BY ALL HAVING sum(w) <> 0),
smax AS (SELECT src, dst, greatest(max(w), 0.0) AS w FROM
           (SELECT src, dst, w FROM g UNION ALL SELECT dst, src, w FROM g) GROUP BY ALL HAVING greatest(max(w), 0.0) <> 0),
sdeg AS (SELECT src, sum(w) AS d FROM smax GROUP BY src),
sisq AS (SELECT src AS node, CASE WHEN d > 0 THEN 1.0 / sqrt(d) ELSE 0.0 END AS inv FROM sdeg),
ssym AS (SELECT s.dst AS src, s.src AS dst, s.w * a.inv * b.inv AS w
         FROM smax s JOIN sisq a ON s.src = a.node JOIN sisq b ON s.dst = b.node),
snlap AS (SELECT src, dst, sum(w) AS w FROM
            (SELECT node AS src, node AS dst, 1.0::DOUBLE AS w FROM nodes UNION ALL SELECT src, dst, -w FROM ssym WHERE w <> 0)
          GROUP BY ALL HAVING sum(w) <> 0),
scal AS (SELECT src, dst, sum(w) AS w FROM
           (SELECT src, dst, w * (2.0 / 2.0) AS w FROM snlap UNION ALL SELECT node, node, -1.0 FROM nodes)
         GROUP BY ALL HAVING sum(w) <> 0),
kst AS (SELECT count(*) FILTER (WHERE NOT isfinite(w)) AS n_inf,
               sum(w) FILTER (WHERE isfinite(w)) AS s1 FROM g),
kmean AS (SELECT (SELECT count(*) FROM nodes) ^ 2 - n_inf AS m, s1 / ((SELECT count(*) FROM nodes) ^ 2 - n_inf) AS mean
          FROM kst),
ksig AS (SELECT sqrt((coalesce(sum((g.w - kmean.mean) ^ 2), 0) + (kmean.m - count(*)) * kmean.mean * kmean.mean) / kmean.m)
                AS sigma
         FROM g, kmean WHERE isfinite(g.w) GROUP BY kmean.m, kmean.mean)
"""


def qg(name: str, body: str) -> None:
    ORACLE[name] = BASE + GRAPH + body


qg("adjacency_edges", """SELECT n1.node AS src, n2.node AS dst, coalesce(g.w, 0.0) AS w
  FROM nodes n1 CROSS JOIN nodes n2 LEFT JOIN g ON g.src = n1.node AND g.dst = n2.node""")
qg("degrees", "SELECT node, round(coalesce(d, 0.0), 6) AS degree FROM nodes LEFT JOIN deg ON node = src")
qg("gaussian_kernel", """SELECT src, dst, w AS w_in,
  round(CASE WHEN isfinite(w) THEN exp(-((w / sigma) ^ 2)) ELSE 0.0 END, 6) AS w, round(sigma, 6) AS sigma
  FROM g, ksig""")
qg("transition", "SELECT src, dst, round(w, 6) AS w FROM tr0 WHERE w <> 0")
qg("double_transition", "SELECT support, src, dst, round(w, 6) AS w FROM sup WHERE w <> 0")
qg("sym_normalize", "SELECT src, dst, round(w, 6) AS w FROM sym WHERE w <> 0")
qg("normalized_laplacian", "SELECT src, dst, round(w, 6) AS w FROM nlap")
qg("symmetrize_max", "SELECT src, dst, w FROM smax")
qg("scaled_laplacian", "SELECT src, dst, round(w, 6) AS w FROM scal")
qg("identity_edges", "SELECT CAST(0 AS BIGINT) AS support, node AS src, node AS dst, 1.0::DOUBLE AS w FROM nodes")
qg("chebyshev_supports", "SELECT CAST(k AS BIGINT) AS k, src, dst, round(w, 6) AS w FROM cheb")
qg("diffusion_features", """SELECT flow_type, interval_start, k, zone_id, round(sum(v), 6) AS value FROM (
    SELECT g.flow_type, g.interval_start, CAST(c.k AS BIGINT) AS k, c.src AS zone_id, c.w * g.flow AS v
    FROM grid g JOIN cheb c ON c.dst = g.zone_id
    UNION ALL
    SELECT g.flow_type, g.interval_start, ks.k, g.zone_id, 0.0 AS v
    FROM grid g CROSS JOIN (SELECT DISTINCT CAST(k AS BIGINT) AS k FROM cheb) ks)
  GROUP BY ALL""")

# ---- forecast and anomalies ---------------------------------------------------------
REPORT_THRESHOLD = 2  # of the per-type reports, as in catalog.py: low enough for rows of several flow types
FORECAST = """,
fz AS (SELECT flow_type, interval_start, zone_id, flow AS actual, mu, sd, (last - mu) / sd AS z
       FROM hist WHERE n_hist = 12),
f1 AS (SELECT flow_type, interval_start, zone_id, sum(v) AS z FROM (
         SELECT flow_type, interval_start, zone_id, 0.5 * z AS v FROM fz
         UNION ALL
         SELECT f.flow_type, f.interval_start, p.src AS zone_id, p.w * f.z * 0.5 AS v
         FROM fz f JOIN tr0 p ON p.dst = f.zone_id) GROUP BY ALL),
f2 AS (SELECT flow_type, interval_start, zone_id, sum(v) AS z FROM (
         SELECT flow_type, interval_start, zone_id, 0.5 * z AS v FROM f1
         UNION ALL
         SELECT f.flow_type, f.interval_start, p.src AS zone_id, p.w * f.z * 0.5 AS v
         FROM f1 f JOIN tr0 p ON p.dst = f.zone_id) GROUP BY ALL),
f3 AS (SELECT flow_type, interval_start, zone_id, sum(v) AS z FROM (
         SELECT flow_type, interval_start, zone_id, 0.5 * z AS v FROM f2
         UNION ALL
         SELECT f.flow_type, f.interval_start, p.src AS zone_id, p.w * f.z * 0.5 AS v
         FROM f2 f JOIN tr0 p ON p.dst = f.zone_id) GROUP BY ALL),
pred AS (SELECT fz.flow_type, fz.zone_id, fz.interval_start, fz.actual,
                CAST(trunc(round(f1.z * fz.sd + fz.mu, 9)) AS BIGINT) AS forecast
         FROM fz JOIN f1 USING (flow_type, interval_start, zone_id)),
res AS (SELECT *, abs(actual - forecast) AS residual FROM pred),
anom AS (SELECT r.interval_start, r.flow_type, r.zone_id, z.graph_id, z.zone_name, r.actual, r.forecast, r.residual
         FROM res r JOIN zones z ON r.zone_id = z.zone_id WHERE r.residual > THRESHOLD)
"""


def qf(name: str, body: str) -> None:
    ORACLE[name] = BASE + GRAPH + FORECAST.replace("THRESHOLD", str(REPORT_THRESHOLD)) + body


qf("forecast_next", "SELECT * FROM pred")
qf("forecast_horizon", """
  SELECT fz.flow_type, fz.zone_id, fz.interval_start + (h.horizon - 1) * INTERVAL 1 DAY AS interval_start,
         CAST(h.horizon AS INTEGER) AS horizon, CAST(trunc(round(h.z * fz.sd + fz.mu, 9)) AS BIGINT) AS forecast
  FROM fz JOIN (SELECT 1 AS horizon, * FROM f1 UNION ALL SELECT 2, * FROM f2 UNION ALL SELECT 3, * FROM f3) h
  USING (flow_type, interval_start, zone_id)""")
qf("backtest", """SELECT flow_type, count(*) AS n_steps, round(avg(abs(actual - forecast)), 6) AS mae,
  max(abs(actual - forecast)) AS max_abs_error, round(avg(actual), 6) AS mean_actual FROM pred GROUP BY flow_type""")
qf("residuals", "SELECT * FROM res")
qf("anomalies", "SELECT * FROM anom")
qf("anomaly_snapshot", """SELECT *, CAST(row_number() OVER (ORDER BY flow_type, graph_id) - 1 AS BIGINT) AS doc_id
  FROM anom WHERE interval_start = (SELECT max(interval_start) FROM anom)""")

# Single-channel binding: every event type counted as flow type 'all'.
BASE_TOTAL = BASE.replace("ev AS (SELECT event_type AS flow_type,", "ev AS (SELECT 'all' AS flow_type,")
assert BASE_TOTAL != BASE


def qt(name: str, body: str) -> None:
    ORACLE[name] = BASE_TOTAL + GRAPH + FORECAST.replace("THRESHOLD", "10") + body


qt("residuals_total", "SELECT * FROM res")
qt("anomalies_total", "SELECT * FROM anom")
qt("anomaly_snapshot_total", """SELECT *, CAST(row_number() OVER (ORDER BY flow_type, graph_id) - 1 AS BIGINT) AS doc_id
  FROM anom WHERE interval_start = (SELECT max(interval_start) FROM anom)""")
# Live loop: the same anomalies for every step closed by the watermark (all days but the last).
qt("live_anomalies", "SELECT * FROM anom WHERE interval_start < (SELECT max(interval_start) FROM w)")
# Streaming 5-minute counts: windows whose end is at or before the watermark (max event time).
q("stream_tumbling", """SELECT * FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, time) AS interval_start, flow_type, region_id AS zone_id, count(*) AS flow
  FROM ev WHERE time IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL) x
  WHERE interval_start + INTERVAL 5 MINUTE <= (SELECT max(time) FROM ev)""")

_ARRIVING = """, ar AS (
  SELECT event_type AS flow_type, ts AS time, CAST(user_id % 25 AS BIGINT) AS region_id,
         epoch_us(ts) + 1000000 * ({wait}) AS off FROM events),
cl AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, time) AS interval_start,
         max(time) OVER (PARTITION BY flow_type ORDER BY off, time, region_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock,
         max(time) OVER (PARTITION BY flow_type) AS last
  FROM ar WHERE time IS NOT NULL AND region_id IS NOT NULL AND flow_type IS NOT NULL)
"""

q("stream_topics", _ARRIVING.format(wait="CASE WHEN length(event_type) % 2 = 1 THEN 36000 ELSE 0 END") + """
  SELECT interval_start, flow_type, region_id AS zone_id, count(*) AS flow FROM cl
  WHERE interval_start + INTERVAL 5 MINUTE <= last GROUP BY ALL""")
q("stream_late", _ARRIVING.format(wait="(event_id * 7919) % 1800") + """,
  jd AS (SELECT *, coalesce(interval_start + INTERVAL 5 MINUTE <= clock - INTERVAL 5 SECOND, false) AS is_late,
                interval_start + INTERVAL 5 MINUTE <= last - INTERVAL 5 SECOND AS is_closed FROM cl)
  SELECT interval_start, flow_type, region_id AS zone_id, count(*) AS flow, CASE WHEN is_late THEN 'late' ELSE 'closed' END AS kind
  FROM jd WHERE is_late OR is_closed GROUP BY ALL""")

# ---- spatial ---------------------------------------------------------------------------


def _frac(e: str) -> str:
    return f"(abs(({e}) * 7.31::DOUBLE) - floor(abs(({e}) * 7.31::DOUBLE)))"


def _proj(lat: str, lon: str, axis: str) -> str:
    es = f"(sin(radians({lat})) * {_geo._E!r})"
    t = f"(tan({3.141592653589793 / 4!r} - radians({lat}) / 2) / pow((1.0 - {es}) / (1.0 + {es}), {_geo._E / 2!r}))"
    rho = f"(pow({t}, {_geo._N!r}) * {_geo.GRS80_A * _geo._F!r})"
    theta = f"(radians({lon} - ({_geo.CENTRAL_MERIDIAN!r})) * {_geo._N!r})"
    if axis == "x":
        return f"(({rho} * sin({theta})) / {_geo.US_FOOT_M!r} + {_geo.FALSE_EASTING_FT!r})"
    return f"(({_geo._RHO0!r} - {rho} * cos({theta})) / {_geo.US_FOOT_M!r} + {_geo.FALSE_NORTHING_FT!r})"


SPATIAL = f""",
bike AS (
  SELECT o.o_orderdate AS starttime,
         o.o_orderdate + to_minutes(CAST(o.o_orderkey % 97 AS INTEGER)) AS stoptime,
         40.70::DOUBLE + 0.1::DOUBLE * {_frac("c.c_acctbal")} AS slat,
         -74.02::DOUBLE + 0.1::DOUBLE * {_frac("o.o_totalprice")} AS slon,
         40.70::DOUBLE + 0.1::DOUBLE * {_frac("o.o_totalprice * 3.0::DOUBLE")} AS elat,
         -74.02::DOUBLE + 0.1::DOUBLE * {_frac("c.c_acctbal * 3.0::DOUBLE")} AS elon
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
bxy AS (SELECT *, {_proj("slat", "slon", "x")} AS sx, {_proj("slat", "slon", "y")} AS sy,
               {_proj("elat", "elon", "x")} AS ex, {_proj("elat", "elon", "y")} AS ey FROM bike),
shapes AS (SELECT zone_id, 975000.0::DOUBLE + (graph_id % 5) * 6000.0::DOUBLE AS x0,
                  190000.0::DOUBLE + floor(graph_id / 5) * 9000.0::DOUBLE AS y0 FROM area),
assigned AS (
  SELECT b.*,
    (SELECT min(zone_id) FROM shapes s WHERE b.sx > s.x0 AND b.sx < s.x0 + 6000.0 AND b.sy > s.y0 AND b.sy < s.y0 + 9000.0)
      AS pu_zone,
    (SELECT min(zone_id) FROM shapes s WHERE b.ex > s.x0 AND b.ex < s.x0 + 6000.0 AND b.ey > s.y0 AND b.ey < s.y0 + 9000.0)
      AS do_zone
  FROM bxy b),
summary AS (SELECT zone_id, CAST(4 AS BIGINT) AS n_vertices, x0 AS xmin, x0 + 6000.0 AS xmax, y0 AS ymin,
                   y0 + 9000.0 AS ymax FROM shapes)
"""


def qs(name: str, body: str) -> None:
    ORACLE[name] = BASE + SPATIAL + body


qs("project_points", """SELECT starttime, round(slat, 6) AS lat, round(slon, 6) AS lon, round(sx, 4) AS x,
  round(sy, 4) AS y FROM bxy""")
qs("zone_shapes", "SELECT * FROM summary")
qs("zone_assign", """SELECT starttime, stoptime, pu_zone, do_zone FROM assigned
  WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL""")
qs("zone_assign_multi", """SELECT starttime, stoptime,
  (SELECT min(zone_id) FROM shapes s WHERE
     (b.sx > s.x0 AND b.sx < s.x0 + 4000.0 AND b.sy > s.y0 AND b.sy < s.y0 + 9000.0
      AND NOT (b.sx >= s.x0 + 1000.0 AND b.sx <= s.x0 + 3000.0 AND b.sy >= s.y0 + 2000.0 AND b.sy <= s.y0 + 7000.0))
     OR (b.sx > s.x0 + 1500.0 AND b.sx < s.x0 + 2500.0 AND b.sy > s.y0 + 3000.0 AND b.sy < s.y0 + 6000.0)
     OR (b.sx > s.x0 + 4500.0 AND b.sx < s.x0 + 6000.0 AND b.sy > s.y0 + 1000.0 AND b.sy < s.y0 + 8000.0)) AS zone
  FROM bxy b""")
qs("geo_points", """SELECT starttime, pu_zone, printf('%.6f,%.6f', slat, slon) AS location FROM assigned
  WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL""")
qs("flow_map", "SELECT w.*, s.n_vertices, s.xmin, s.xmax, s.ymin, s.ymax FROM w JOIN summary s USING (zone_id)")
qs("alias_union", "SELECT * FROM w UNION ALL BY NAME SELECT * FROM summary")
qs("stream_passthrough", """SELECT starttime, stoptime, round(slat, 6) AS "start station latitude",
  round(slon, 6) AS "start station longitude", round(elat, 6) AS "end station latitude",
  round(elon, 6) AS "end station longitude", pu_zone AS "PULocationID", do_zone AS "DOLocationID"
  FROM assigned WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL""")
q("stream_source", "SELECT * FROM fe")


qs("bike_flow_events", """SELECT 'inflow' AS flow_type, stoptime AS time, do_zone AS region_id FROM assigned
  WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL UNION ALL
  SELECT 'outflow', starttime, pu_zone FROM assigned WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL""")
qs("bike_windows", """SELECT time_bucket(INTERVAL 5 MINUTE, time) AS interval_start, flow_type, region_id AS zone_id, count(*) AS flow FROM (
  SELECT 'taxi_' || flow_type AS flow_type, time, region_id FROM fe UNION ALL
  SELECT 'bike_inflow', stoptime, do_zone FROM assigned WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL UNION ALL
  SELECT 'bike_outflow', starttime, pu_zone FROM assigned WHERE pu_zone IS NOT NULL AND do_zone IS NOT NULL) GROUP BY ALL""")

# The OD graph without its lighter edges (isolated nodes), and its dense kernel.
GRAPH_SPARSE = GRAPH.replace("g AS (SELECT pu_zone", "gall AS (SELECT pu_zone").replace("deg AS (SELECT src, sum(w) AS d FROM g",
                             "g AS (SELECT * FROM gall WHERE w > (SELECT avg(w) FROM gall) * 1.5),\ndeg AS (SELECT src, sum(w) AS d FROM g", 1)
# The trace of high powers of L (symmetric, positive semidefinite): tr(L^(2^k + 1)) / tr(L^(2^k)) is its largest eigenvalue.
POWERS = """,
l0 AS MATERIALIZED (SELECT src, dst, w FROM snlap)""" + "".join(f""",
m{i} AS MATERIALIZED (SELECT a.src, b.dst, sum(a.w * b.w) AS w FROM l{i} a JOIN l{i} b ON a.dst = b.src GROUP BY ALL),
l{i + 1} AS MATERIALIZED (SELECT src, dst, w / (SELECT sum(w) FROM m{i} WHERE src = dst) AS w FROM m{i})""" for i in range(18)) + """,
top AS (SELECT sum(a.w * b.w) AS lam FROM l18 a JOIN l0 b ON a.dst = b.src AND a.src = b.dst)
"""
HUB = """,
h AS (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM g UNION ALL
        SELECT node, (SELECT min(node) FROM nodes), 1.0 FROM nodes WHERE node <> (SELECT min(node) FROM nodes) UNION ALL
        SELECT (SELECT min(node) FROM nodes), node, 1.0 FROM nodes WHERE node <> (SELECT min(node) FROM nodes)) GROUP BY ALL)
"""
KERNEL = """,
kd AS (SELECT a.node AS i, b.node AS j, CASE WHEN g.w IS NULL THEN 1.0::DOUBLE WHEN isfinite(g.w) THEN exp(-((g.w / sigma) ^ 2)) ELSE 0.0 END AS w
       FROM nodes a CROSS JOIN nodes b CROSS JOIN ksig LEFT JOIN g ON g.src = a.node AND g.dst = b.node),
ks AS (SELECT 0 AS support, i, j, w FROM kd UNION ALL SELECT 1, j, i, w FROM kd),
kr AS (SELECT support, i, sum(w) AS d FROM ks GROUP BY ALL),
kp AS (SELECT ks.support, ks.j AS i, ks.i AS j, ks.w / kr.d AS w FROM ks JOIN kr USING (support, i)),
x0 AS (SELECT s.support, flow_type, interval_start, zone_id, CAST(flow AS DOUBLE) AS x FROM grid CROSS JOIN (SELECT unnest([0, 1]) AS support) s),
x1 AS (SELECT support, flow_type, interval_start, kp.i AS zone_id, sum(kp.w * x) AS x FROM x0 JOIN kp USING (support) WHERE kp.j = x0.zone_id GROUP BY ALL),
y2 AS (SELECT support, flow_type, interval_start, kp.i AS zone_id, sum(kp.w * x) AS x FROM x1 JOIN kp USING (support) WHERE kp.j = x1.zone_id GROUP BY ALL),
x2 AS (SELECT support, flow_type, interval_start, zone_id, 2 * y2.x - x0.x AS x FROM y2 JOIN x0 USING (support, flow_type, interval_start, zone_id))
"""


def qsparse(name: str, body: str, more: str = "") -> None:
    ORACLE[name] = BASE + GRAPH_SPARSE + more + body


qsparse("transition_sparse", "SELECT src, dst, round(w, 6) AS w FROM tr0 WHERE w <> 0")
qsparse("double_transition_sparse", "SELECT support, src, dst, round(w, 6) AS w FROM sup WHERE w <> 0")
qsparse("sym_normalize_sparse", "SELECT src, dst, round(w, 6) AS w FROM sym WHERE w <> 0")
qsparse("normalized_laplacian_sparse", "SELECT src, dst, round(w, 6) AS w FROM nlap")
qsparse("scaled_laplacian_sparse", "SELECT src, dst, round(w, 6) AS w FROM scal")
qsparse("lambda_max", "SELECT round(lam, 9) AS lambda_max FROM top", POWERS)
qsparse("scaled_laplacian_measured", """SELECT src, dst, round(sum(w), 9) AS w FROM (
  SELECT src, dst, w * 2 / (SELECT lam FROM top) AS w FROM snlap UNION ALL SELECT node, node, -1.0 FROM nodes)
  GROUP BY ALL HAVING sum(w) <> 0""", POWERS)
qsparse("matmul_blocked", "SELECT a.src, b.dst, sum(a.w * b.w) AS w FROM h a JOIN h b ON a.dst = b.src GROUP BY ALL HAVING sum(a.w * b.w) <> 0", HUB)
qsparse("kernel_row_sums", "SELECT i AS node, round(d, 6) AS d FROM kr WHERE support = 0", KERNEL)
qsparse("kernel_diffusion", """SELECT flow_type, interval_start, CAST(support * 3 + degree AS BIGINT) AS k, zone_id, round(x, 9) AS value FROM (
  SELECT 0 AS degree, * FROM x0 UNION ALL SELECT 1, support, flow_type, interval_start, zone_id, x FROM x1
  UNION ALL SELECT 2, support, flow_type, interval_start, zone_id, x FROM x2)""", KERNEL)

DESIGN = """,
lg AS (SELECT flow_type, interval_start, zone_id, flow AS y, n_hist, last, """ + ", ".join(f"lag(flow, {12 - i}) OVER s AS x{i}" for i in range(12)) + """
       FROM hist WINDOW s AS (PARTITION BY flow_type, zone_id ORDER BY interval_start)),
nb AS (SELECT f.flow_type, f.interval_start, p.src AS zone_id, sum(p.w * f.last) AS x12 FROM lg f JOIN tr0 p ON p.dst = f.zone_id WHERE n_hist = 12 GROUP BY ALL),
u AS (SELECT lg.*, coalesce(nb.x12, 0.0) AS x12, 1.0::DOUBLE AS x13 FROM lg LEFT JOIN nb USING (flow_type, interval_start, zone_id)
      WHERE n_hist = 12 AND interval_start < TIMESTAMP '2024-01-20'),
xs AS (SELECT flow_type, y, unnest(range(14)) AS feature, unnest([""" + ", ".join(f"x{i}::DOUBLE" for i in range(14)) + """]) AS x FROM u)
"""
# A least-squares fit leaves residuals that are orthogonal to every feature.
ORACLE["fitted_check"] = BASE + GRAPH + DESIGN + """SELECT flow_type, CAST(feature AS INTEGER) AS feature, count(*) AS n_rows, round(sum(x * y), 4) AS sum_xy,
  0.0::DOUBLE AS residual_x FROM xs GROUP BY ALL"""
# Every step's model is fitted on the rows of all earlier steps; least squares solves its normal equations exactly.
ORACLE["backtest_fitted"] = BASE + GRAPH + DESIGN.replace("AND interval_start < TIMESTAMP '2024-01-20'", "").replace(
    "xs AS (SELECT flow_type,", "xs AS (SELECT flow_type, interval_start,") + """,
  st AS (SELECT flow_type, interval_start, count(*) // 14 AS n, sum(x * x) AS xx, sum(x * y) AS xy FROM xs GROUP BY ALL),
  rs AS (SELECT flow_type, interval_start, sum(n) OVER b AS n, sum(xx) OVER b AS xx, sum(xy) OVER b AS xy FROM st
         WINDOW b AS (PARTITION BY flow_type ORDER BY interval_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT flow_type, interval_start, CAST(n AS BIGINT) AS n_train, round(xx, 4) AS sum_xx, round(xy, 4) AS sum_xy, 0.0::DOUBLE AS residual
  FROM rs WHERE n > 0"""
qf("aligned_horizon", """SELECT flow_type, interval_start, zone_id, g.flow AS actual, h.forecast FROM grid g JOIN (
  SELECT fz.flow_type, fz.zone_id, fz.interval_start + INTERVAL 2 DAY AS interval_start, CAST(trunc(round(f3.z * fz.sd + fz.mu, 9)) AS BIGINT) AS forecast
  FROM fz JOIN f3 USING (flow_type, interval_start, zone_id)) h USING (flow_type, interval_start, zone_id)""")
BASE_TRIPS = BASE.replace("ev AS (SELECT event_type AS flow_type, ts AS time, CAST(user_id % 25 AS BIGINT) AS region_id FROM events)", """ev AS (
  SELECT 'inflow' AS flow_type, dropoff AS time, do_zone AS region_id FROM trips WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu_zone IS NOT NULL AND do_zone IS NOT NULL
  UNION ALL SELECT 'outflow', pickup, pu_zone FROM trips WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu_zone IS NOT NULL AND do_zone IS NOT NULL)""")
BASE_TRIPS = BASE_TRIPS.replace("time_bucket(INTERVAL 1 DAY, time)", "time_bucket(INTERVAL 7 DAY, time, TIMESTAMP '1970-01-01')").replace(
    "generate_series(t0, t1, INTERVAL 1 DAY)", "generate_series(t0, t1, INTERVAL 7 DAY)")
assert "INTERVAL 7 DAY" in BASE_TRIPS and "UNION ALL SELECT 'outflow', pickup" in BASE_TRIPS
ORACLE["trip_anomalies"] = BASE_TRIPS + GRAPH + FORECAST.replace("THRESHOLD", str(4 * REPORT_THRESHOLD)) + "SELECT * FROM anom"


for _k in list(ORACLE):
    ORACLE[_k] = snap_rounding(ORACLE[_k])

# The per-block pandas scorer runs the same horizon-1 diffusion forecast.
qf("score_windows", "SELECT flow_type, interval_start, zone_id, actual, forecast FROM pred")
for _k in ("score_windows",):
    ORACLE[_k] = snap_rounding(ORACLE[_k])
