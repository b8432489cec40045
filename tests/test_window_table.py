"""Compaction of the window table: same rows, few files, replays and open readers safe."""

import datetime as dt
import os

from pyspark.sql import functions as F

from zoneflow.sources import files
from zoneflow.sources.window_table import WindowTable


def rows(n, batch):
    return [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=8 * (batch * n + i)), "in", i, 10 * batch + i) for i in range(n)]


def content(df):
    return sorted(tuple(r) for r in df.select("interval_start", "flow_type", "zone_id", "flow", "batch_id").collect())


def data_files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_compaction_keeps_rows_and_bounds_files(spark, scratch):
    t = WindowTable(f"{scratch}/t")
    assert t.read(spark).count() == 0 and t.compact(spark, 5) is None
    want = []
    for k in range(8):
        t.write_batch(spark.createDataFrame(rows(3, 0 if k < 6 else k), t.rows), k)  # six batches add to one day
        want += [(*r, k) for r in rows(3, 0 if k < 6 else k)]
        if k in (3, 6):
            begun = t.read(spark)
            t.compact(spark, k - 1)
            assert content(begun) == sorted(want)  # a reader that had begun
        assert content(t.read(spark)) == sorted(want)
    assert content(t.read(spark, upto=1)) == sorted(r for r in want if r[4] <= 1)
    assert content(t.read(spark, since=dt.date(2024, 1, 7))) == sorted(r for r in want if r[0] >= dt.datetime(2024, 1, 7))
    runs = t.manifest(spark)
    assert [r["last"] for r in runs][-1] == 5 and [r["first"] for r in runs][0] == 0
    assert all(a["last"] < b["first"] and a["bytes"] > b["bytes"] for a, b in zip(runs, runs[1:]))
    t.write_batch(spark.createDataFrame(rows(3, 0), t.rows), 2)  # replay of a compacted batch
    assert content(t.read(spark)) == sorted(want)
    assert t.expire(spark, 3600) == 0
    assert t.expire(spark, -60) >= 6
    assert content(t.read(spark)) == sorted(want) and t.batch_ids(spark) == [6, 7]
    t.compact(spark, 7)
    t.expire(spark, -60)
    assert content(t.read(spark)) == sorted(want)
    assert data_files(t.path) <= len({r[0].date() for r in want}) * len(t.manifest(spark))


def test_failed_compaction_changes_nothing(spark, scratch, monkeypatch):
    t = WindowTable(f"{scratch}/t")
    t.write_batch(spark.createDataFrame(rows(3, 0), t.rows), 0)
    before = content(t.read(spark))
    with monkeypatch.context() as m:
        m.setattr("zoneflow.sources.window_table.swap_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        try:
            t.compact(spark, 0)
        except OSError:
            pass
    assert t.manifest(spark) == [] and content(t.read(spark)) == before
    assert t.compact(spark, 0)["last"] == 0 and content(t.read(spark)) == before


def test_one_step_reads_one_day(spark, scratch):
    t = WindowTable(f"{scratch}/t")
    for k in range(4):
        t.write_batch(spark.createDataFrame(rows(9, k), t.rows), k)
    t.compact(spark, 2)
    step = files.load_step(t.read(spark), F.lit("2024-01-01").cast("timestamp_ntz"), 86400, 4)
    assert [r["flow"] for r in step.collect()] == [13]
    assert len({os.path.dirname(f) for f in step.inputFiles()}) > 1
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(interval_date") == 2  # the run and the open batch
