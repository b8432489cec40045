"""Watermarked tumbling counts over files, one file per trigger (FIXTURES §3)."""

import json
import os
import time

import pytest

from zoneflow.streaming import source, tumbling

FILES = [
    [("00:01:00", 4), ("00:06:00", 4), ("00:02:00", 4)],
    [("00:03:00", 4), ("00:10:00", 12), ("00:10:01", 12)],
    [("00:04:59", 4), ("00:15:00", 12)],
]


def write_files(d, rows_per_file, extra_lines=()):
    os.makedirs(d, exist_ok=True)
    now = time.time() - 100
    for i, rows in enumerate(rows_per_file):
        p = f"{d}/a{i + 1}.json"
        with open(p, "w") as f:
            for t, r in rows:
                f.write(json.dumps({"time": f"2019-02-01 {t}", "region_id": r}) + "\n")
            if i == 0:
                for line in extra_lines:
                    f.write(line + "\n")
        os.utime(p, (now + 2 * i, now + 2 * i))


def run(spark, d, delay, per_trigger):
    src = source.event_files(spark, f"{d}/in", "inflow", max_files_per_trigger=per_trigger)
    valid, rejects = source.split_rejects(src)
    q = tumbling.start_append(tumbling.stream_tumbling(valid, "5 minutes", delay), f"{d}/out", f"{d}/ckpt")
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    rows = sorted((str(r["interval_start"])[11:16], r["zone_id"], r["flow"])
                  for r in spark.read.parquet(f"{d}/out").collect())
    return rows, dropped


@pytest.mark.parametrize("delay,per_trigger,expected,dropped", [
    ("0 seconds", 1, [("00:00", 4, 3), ("00:05", 4, 1), ("00:10", 12, 2)], 1),
    ("5 seconds", 1, [("00:00", 4, 3), ("00:05", 4, 1)], 1),
    ("5 minutes", 1, [("00:00", 4, 4), ("00:05", 4, 1)], 0),
    ("0 seconds", None, [("00:00", 4, 4), ("00:05", 4, 1), ("00:10", 12, 2)], 0),
])
def test_watermark_cases(spark, scratch, delay, per_trigger, expected, dropped):
    write_files(f"{scratch}/in", FILES)
    rows, n_dropped = run(spark, scratch, delay, per_trigger)
    assert rows == expected
    assert n_dropped == dropped


def test_malformed_rows_go_to_rejects(spark, scratch):
    bad = ['{"time":"nope","region_id":"x"}', "not json", '{"region_id":5}']
    write_files(f"{scratch}/in", FILES[:1], extra_lines=bad)
    df = spark.read.schema("time timestamp_ntz, region_id bigint").option("mode", "PERMISSIVE").json(f"{scratch}/in")
    df = df.selectExpr("'inflow' AS flow_type", "time", "region_id")
    valid, rejects = source.split_rejects(df)
    assert valid.count() == 3
    assert rejects.count() == 3


def test_tail_rows_close_the_last_history_window(spark, scratch):
    """Without a closing row the last history window stays open; with_tail adds the first
    live rows, which move the watermark past it."""
    from pyspark.sql import functions as F

    from zoneflow.operators import events as ev

    hist = spark.createDataFrame([("inflow", "2019-02-01 00:01:00", 4), ("inflow", "2019-02-01 00:06:00", 4)],
                                 "flow_type string, time string, region_id long") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    live_rows = spark.createDataFrame([("inflow", "2019-02-01 00:11:00", 12), ("inflow", "2019-02-01 00:10:00", 12)],
                                      "flow_type string, time string, region_id long") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))

    def run(df, d):
        df.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "region_id") \
            .coalesce(1).write.json(f"{d}/in")
        src = source.event_files(spark, f"{d}/in", "inflow")
        q = tumbling.start_append(tumbling.stream_tumbling(src, "5 minutes", "0 seconds"), f"{d}/out", f"{d}/ckpt")
        q.awaitTermination()
        return sorted((str(r["interval_start"])[11:16], r["zone_id"], r["flow"])
                      for r in spark.read.parquet(f"{d}/out").collect())

    assert run(hist, f"{scratch}/a") == [("00:00", 4, 1)]
    assert run(ev.with_tail(hist, live_rows, 1), f"{scratch}/b") == [("00:00", 4, 1), ("00:05", 4, 1)]
