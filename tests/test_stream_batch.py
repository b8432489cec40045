"""Streaming tumbling counts equal the batch counts of every window the watermark closed."""

import datetime as dt
import json
import os
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from zoneflow.operators import flows
from zoneflow.streaming import source, tumbling

T0 = dt.datetime(2019, 2, 1)
events = st.lists(st.tuples(st.sampled_from(["inflow", "outflow"]), st.integers(0, 3600), st.integers(0, 4)),
                  min_size=1, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_stream_equals_batch_on_closed_windows(spark, tmp_path_factory, evs):
    d = str(tmp_path_factory.mktemp("sb")) + "/" + uuid.uuid4().hex
    os.makedirs(f"{d}/log")
    rows = [(ft, T0 + dt.timedelta(seconds=s), z) for ft, s, z in evs]
    with open(f"{d}/log/part-0.json", "w") as f:
        for ft, t, z in rows:
            f.write(json.dumps({"topic": f"trip_{ft}",
                                "value": json.dumps({"region_id": z, "time": t.strftime("%Y-%m-%d %H:%M:%S")})}) + "\n")
    valid, _ = source.split_rejects(source.flow_events(source.file_messages(spark, f"{d}/log")))
    q = tumbling.start_append(tumbling.stream_tumbling(valid, "5 minutes", "0 seconds"), f"{d}/out", f"{d}/ckpt")
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out")
                 .select("interval_start", "flow_type", "zone_id", "flow").collect())
    batch = spark.createDataFrame(rows, "flow_type string, time timestamp_ntz, region_id long")
    watermark = max(t for _, t, _ in rows)
    want = sorted(tuple(r) for r in flows.tumbling_flow(batch, "5 minutes")
                  .select("interval_start", "flow_type", "zone_id", "flow").collect()
                  if r["interval_start"] + dt.timedelta(minutes=5) <= watermark)
    assert got == want
