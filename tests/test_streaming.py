"""The stream's table stands beside the batch job's, whichever runs first."""
import json

import pytest

from perfwatch.plans import jobs
from perfwatch.plans.jobs import Layout, processed_page_loads
from perfwatch.sources import write_table
from perfwatch.streaming import GATE_METRICS, start_page_load_ingest

DEVICES = "device_id string, device_class string, network_profile string"


def records(first, count):
    """Every fifth record fails the gate."""
    return "\n".join(json.dumps({
        "event_id": f"e{i}", "timestamp": f"2031-07-{i % 28 + 1:02d}T08:00:00Z", "route": "/Docs/", "device_type": "iPad",
        "device_id": f"m{i % 2}", "lcp_ms": -4.0 if i % 5 == 0 else 900.0 + i, "cls": 0.02, "inp_ms": 70.0,
        "ttfb_ms": 210.0, "release_version": "n1"}) for i in range(first, first + count))


@pytest.fixture
def place(spark, tmp_path):
    layout = Layout(str(tmp_path / "site"))
    for folder in ("page_loads", "page_loads_stream"):
        (tmp_path / "site" / "raw" / folder).mkdir(parents=True)
    devices = spark.createDataFrame([("m0", "low-end", "3G"), ("m1", "high-end", "5G")], DEVICES)

    def drop(folder, name, text):
        (tmp_path / "site" / "raw" / folder / name).write_text(text)

    def batch():
        jobs.ingest_page_loads(spark, layout, raw_devices=devices)

    def stream(checkpoint="one"):
        query = start_page_load_ingest(spark, layout, checkpoint=str(tmp_path / checkpoint))
        query.awaitTermination(120)
        return query

    return layout, drop, batch, stream


def ids(spark, layout):
    return sorted(r.event_id for r in processed_page_loads(spark, layout).select("event_id").collect())


def passing(first, count):
    return [f"e{i}" for i in range(first, first + count) if i % 5]


def test_batch_then_stream_then_batch(spark, place):
    layout, drop, batch, stream = place
    drop("page_loads", "a.jsonl", records(0, 80))
    batch()
    drop("page_loads_stream", "b.jsonl", records(80, 6))
    gate = stream().lastProgress["observedMetrics"][GATE_METRICS]
    assert (gate["rows_in"], gate["rows_out"]) == (6, 4)
    everything = sorted(passing(0, 86))
    assert ids(spark, layout) == everything
    batch()                                   # replaces its own table only
    stream()                                  # nothing new
    assert ids(spark, layout) == everything
    drop("page_loads_stream", "c.jsonl", records(90, 7))
    stream()
    assert ids(spark, layout) == sorted(passing(0, 86) + passing(90, 7))


def test_stream_first_and_a_stream_begun_anew(spark, place):
    layout, drop, batch, stream = place
    write_table(spark.createDataFrame([("m0", "low-end", "3G")], DEVICES), layout.processed("devices"))
    drop("page_loads_stream", "a.jsonl", records(0, 10))
    stream()
    drop("page_loads", "b.jsonl", records(20, 10))
    batch()
    assert ids(spark, layout) == sorted(passing(0, 10) + passing(20, 10))
    (old,) = [f for f in ("a.jsonl",)]
    drop("page_loads_stream", old, "")        # the landing folder was emptied before a new checkpoint
    drop("page_loads_stream", "c.jsonl", records(40, 10))
    stream("another")
    assert ids(spark, layout) == sorted(passing(0, 10) + passing(20, 10) + passing(40, 10))


def test_devices_are_read_again_for_every_batch(spark, place):
    layout, drop, batch, stream = place
    drop("page_loads", "z.jsonl", records(1, 1))
    write_table(spark.createDataFrame([("m0", "low-end", "3G")], DEVICES), layout.processed("devices"))
    drop("page_loads_stream", "a.jsonl", records(1, 1))
    stream()
    write_table(spark.createDataFrame([("m0", "low-end", "3G"), ("m1", "mid-range", "4G")], DEVICES),
                layout.processed("devices"))
    drop("page_loads_stream", "b.jsonl", records(3, 1))
    stream()
    got = {r.event_id: r.device_class for r in spark.read.parquet(layout.processed("page_loads_stream")).collect()}
    assert got == {"e1": None, "e3": "mid-range"}
