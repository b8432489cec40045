"""Counts by a clock for each flow type: plain replay of the log, any trigger size, replayed batches."""

import collections
import datetime as dt
import glob
import os
import random

import pytest

from zoneflow.sources import sinks
from zoneflow.streaming import clocks, source, tumbling

START = dt.datetime(2024, 1, 1, 8)
EVENTS = "flow_type string, time timestamp_ntz, region_id bigint, offset bigint"


def log(seed=0, n=400):
    """Two topics whose clocks differ by hours, in disorder, one with a long gap, and ties."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        topic = rng.choice(["a", "b"])
        t = START + dt.timedelta(seconds=30 * k + rng.randrange(-900, 900) - (7200 if topic == "b" else 0) + (5000 if k > 300 else 0))
        rows.append((topic, t, rng.randrange(3), k // 2))
    return sorted(rows, key=lambda r: (r[3], r[1], r[2]))


def replay(rows, delay):
    """What a reader of one record at a time counts."""
    clock, counts, late = {}, collections.Counter(), []
    for topic, t, zone, offset in rows:
        start = t - dt.timedelta(seconds=(t - START.replace(hour=0)).total_seconds() % 300)
        if topic in clock and start + dt.timedelta(seconds=300) <= clock[topic] - dt.timedelta(seconds=delay):
            late.append((topic, t, zone, offset))
        else:
            counts[(start, topic, zone)] += 1
        clock[topic] = max(t, clock.get(topic, t))
    closed = {k: n for k, n in counts.items() if k[0] + dt.timedelta(seconds=300) <= clock[k[1]] - dt.timedelta(seconds=delay)}
    return closed, sorted(late)


def read(spark, counts):
    closed = [((r["interval_start"], r["flow_type"], r["zone_id"]), r["flow"]) for r in counts.closed(spark).collect()]
    assert len(dict(closed)) == len(closed)  # each window once
    return dict(closed), sorted((r["flow_type"], r["time"], r["region_id"], r["offset"]) for r in counts.late(spark).collect())


@pytest.mark.parametrize("cuts, delay, ranges", [([], 0, 1), ([], 5, 4), (range(33, 400, 33), 5, 3), ([1, 2, 390], 600, 8)])
def test_batches_match_a_replay_of_the_log(spark, scratch, cuts, delay, ranges):
    rows = log()
    counts = clocks.TopicCounts(f"{scratch}/counts", 300, delay, ranges)
    edges = [0, *(c - (c % 2) for c in cuts), len(rows)]  # equal offsets stay in one batch
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = rows[a:b]
        random.Random(i).shuffle(part)
        counts.process(spark.createDataFrame(part, EVENTS), i)
        if i == 1:
            counts.process(spark.createDataFrame(part, EVENTS), i)  # a replayed batch replaces its output
    assert read(spark, counts) == replay(rows, delay)
    late = counts.late(spark).collect()
    assert all(r["behind_seconds"] >= 0 for r in late)


@pytest.mark.parametrize("per_trigger", [1, 3, 12])
def test_stream_does_not_depend_on_the_trigger(spark, scratch, per_trigger):
    rows = log(1)
    df = spark.createDataFrame(rows, EVENTS)
    sinks.write_offset_log(df, f"{scratch}/log", 12, "event")
    valid, _ = source.split_rejects(source.placed_events(source.offset_messages(spark, f"{scratch}/log", per_trigger)))
    counts = clocks.TopicCounts(f"{scratch}/counts", 300, 5)
    tumbling.finish(clocks.start_counts(valid, counts, f"{scratch}/ckpt"))
    assert read(spark, counts) == replay(rows, 5)


def test_no_topic_makes_another_late(spark, scratch):
    """Topic A at 10:00 to 10:18, topic B two hours behind, in turn: nothing is late."""
    rows = [(topic, START + dt.timedelta(hours=lag, minutes=m), 1, 4 * m + lag) for m in range(0, 19, 3) for topic, lag in (("a", 2), ("b", 0))]
    rows = sorted(rows, key=lambda r: r[3])
    counts = clocks.TopicCounts(f"{scratch}/counts", 300)
    for i, r in enumerate(rows):
        if i % 4 == 0:
            counts.process(spark.createDataFrame(rows[i:i + 4], EVENTS), i // 4)
    closed, late = read(spark, counts)
    assert late == [] and (closed, late) == replay(rows, 0) and {k[1] for k in closed} == {"a", "b"}


def test_drops_are_counted_over_all_reports(spark, scratch):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        for i, hour in enumerate([8, 12, 13, 9, 14, 15]):  # the fourth file is late
            spark.createDataFrame([("a", START.replace(hour=hour), 1, i)], EVENTS).coalesce(1).write.mode("append").parquet(f"{scratch}/in/{i}")
        for i in range(6):
            for f in glob.glob(f"{scratch}/in/{i}/part-*"):
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{scratch}/in")
        query = tumbling.start_append(tumbling.stream_tumbling(stream), f"{scratch}/out", f"{scratch}/ckpt")
        with pytest.raises(RuntimeError, match="1 rows"):
            tumbling.finish(query)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_empty_batch(spark, scratch):
    counts = clocks.TopicCounts(f"{scratch}/counts", 300)
    counts.process(spark.createDataFrame(log(2)[:50], EVENTS), 0)
    counts.process(spark.createDataFrame([], EVENTS), 1)
    counts.process(spark.createDataFrame(log(2)[50:], EVENTS), 2)
    assert read(spark, counts) == replay(log(2), 0)
