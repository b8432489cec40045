"""File sources and sinks: all-string CSV trips, zone CSV, polygon table, window table
partition pruning, idempotent batch partitions."""

from pyspark.sql import functions as F

from zoneflow.operators import trips
from zoneflow.sources import files, sinks

TAXI_HEADER = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,"
               "store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,"
               "tolls_amount,improvement_surcharge,total_amount,congestion_surcharge")


def test_taxi_csv_to_clean_trips(spark, scratch):
    rows = [
        "1,2019-02-01 00:10:00,2019-02-01 00:20:00,1,1.0,1,N,4,12,1,5,0,0.5,0,0,0.3,6,0",
        "1,2019-02-01 00:00:00,2019-02-01 00:20:00,1,1.0,1,N,4,12,1,5,0,0.5,0,0,0.3,6,0",   # lower bound kept
        "1,2019-02-01 00:10:00,2019-02-01 00:20:00,1,1.0,1,N,4,999,1,5,0,0.5,0,0,0.3,6,0",  # leaves the area
        "1,2019-03-01 00:10:00,2019-03-01 00:20:00,1,1.0,1,N,4,12,1,5,0,0.5,0,0,0.3,6,0",   # outside the month
        "1,not a time,2019-02-01 00:20:00,1,1.0,1,N,4,12,1,5,0,0.5,0,0,0.3,6,0",           # bad value
    ]
    with open(f"{scratch}/taxi.csv", "w") as f:
        f.write(TAXI_HEADER + "\n" + "\n".join(rows) + "\n")
    with open(f"{scratch}/zones.csv", "w") as f:
        f.write("zone_id,graph_id,zone_name\n4,0,Alphabet City\n12,1,Battery Park\n")
    raw = files.read_taxi_trips(spark, f"{scratch}/taxi.csv")
    assert all(t.simpleString() == "string" for t in [f.dataType for f in raw.schema.fields])
    zones = files.read_zones(spark, f"{scratch}/zones.csv")
    t = trips.taxi_trips(raw)
    out = trips.clean_trips(t, zones, "2019-02-01", "2019-03-01").collect()
    assert len(out) == 2
    strict = trips.clean_trips(t, zones, "2019-02-01", "2019-03-01", strict=True).collect()
    assert len(strict) == 1
    assert trips.trip_rejects(t).count() == 1


def test_zone_shape_table_roundtrip(spark, scratch):
    ring = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]
    spark.createDataFrame([(7, ring)], "zone_id long, ring array<struct<x:double,y:double>>") \
        .write.parquet(f"{scratch}/shapes")
    r = files.read_zone_shapes(spark, f"{scratch}/shapes").first()
    assert r["zone_id"] == 7 and len(r["ring"]) == 3


def test_window_table_step_read_prunes_partitions(spark, scratch):
    w = spark.createDataFrame(
        [("2024-01-0%d 00:00:00" % d, "a", 1, d) for d in range(1, 6)],
        "interval_start string, flow_type string, zone_id long, flow long",
    ).withColumn("interval_start", F.col("interval_start").cast("timestamp_ntz"))
    sinks.write_windows(w, f"{scratch}/w")
    table = spark.read.parquet(f"{scratch}/w")
    t0 = F.lit("2024-01-01").cast("timestamp_ntz")
    step = files.load_step(table, t0, 86400, 2)
    assert [r["flow"] for r in step.collect()] == [3]
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(interval_date" in plan
    hist = files.load_history(table, t0, 86400, 3)
    assert sorted(r["flow"] for r in hist.collect()) == [1, 2, 3]


def test_batch_partitions_are_idempotent(spark, scratch):
    df = spark.createDataFrame([(1,), (2,)], "v long")
    for _ in range(2):
        sinks.write_batch_partition(df, f"{scratch}/t", 0)
    sinks.write_batch_partition(df.limit(1), f"{scratch}/t", 1)
    t = spark.read.parquet(f"{scratch}/t")
    assert t.filter("batch_id = 0").count() == 2 and t.count() == 3


def test_readme_batch_chain_runs(spark, scratch):
    from zoneflow.operators import anomaly, events, flows, forecast, graph, history

    rows = []
    for k in range(40):   # 40 five-minute steps of trips between two zones
        m = 5 * k
        rows.append(f"1,2019-02-01 {m // 60:02d}:{m % 60:02d}:00,2019-02-01 {m // 60:02d}:{m % 60:02d}:30,"
                    f"1,1.0,1,N,{4 if k % 2 else 12},{12 if k % 2 else 4},1,5,0,0.5,0,0,0.3,6,0")
    with open(f"{scratch}/taxi.csv", "w") as f:
        f.write(TAXI_HEADER + "\n" + "\n".join(rows) + "\n")
    with open(f"{scratch}/zones.csv", "w") as f:
        f.write("zone_id,graph_id,zone_name\n4,0,Alphabet City\n12,1,Battery Park\n")
    raw = files.read_taxi_trips(spark, f"{scratch}/taxi.csv")
    zones = files.read_zones(spark, f"{scratch}/zones.csv")
    clean = trips.clean_trips(trips.taxi_trips(raw), zones, "2019-02-01", "2019-03-01")
    windows = flows.tumbling_flow(events.trips_to_events(clean), "5 minutes")
    grid = history.dense_grid(windows, zones, 300)
    p = graph.transition(graph.od_graph(clean))
    pred = forecast.next_step(grid, p)
    report = anomaly.anomalies(anomaly.residuals(pred), zones, threshold=10)
    assert grid.count() == 40 * 2 * 2          # steps x zones x flow types
    assert pred.count() == (40 - 12) * 2 * 2
    assert report.count() == 0                 # flows of 0/1 never differ by more than 10
