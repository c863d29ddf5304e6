"""Broken input goes to the quarantine with its reasons, in the pass that writes the clean table."""
import json

import pytest

from perfwatch.plans import jobs
from perfwatch.sources import read_layer
from perfwatch.sources.schemas import FIELD_METRICS_SCHEMA


def load(n, **changed):
    return {"event_id": f"e{n}", "timestamp": "2031-08-01T10:00:00Z", "route": "/docs", "device_type": "phone", "device_id": "m1",
            "lcp_ms": 900.0 + n, "cls": 0.01, "inp_ms": 90.0, "ttfb_ms": 300.0, "js_error_count": 0, "release_version": "r1"} | changed


@pytest.fixture
def layout(tmp_path):
    for name in ("lab_reports", "field_metrics", "page_loads", "devices"):
        (tmp_path / "raw" / name).mkdir(parents=True)
    raw = tmp_path / "raw"
    (raw / "devices" / "d.json").write_text(json.dumps([{"device_id": "m1", "device_class": "low-end"}]))
    (raw / "devices" / "broken.json").write_text('[{"device_id": "m2", ')
    return jobs.Layout(str(tmp_path)), raw


def quarantined(spark, layout, name):
    return sorted((r.reasons, r.record) for r in read_layer(spark, layout.quarantine(name)).collect())


def test_page_loads(spark, layout):
    layout, raw = layout
    lines = [json.dumps(load(1)), '{"event_id": "e2", "route": "/cut', "not json at all", json.dumps(load(3, lcp_ms="fast")),
             json.dumps(load(4, lcp_ms=-1.0, device_type="fridge")), json.dumps(load(5, route=None)), json.dumps(load(6, timestamp="?"))]
    (raw / "page_loads" / "a.jsonl").write_text("\n".join(lines) + "\n\n")
    out = jobs.ingest_page_loads(spark, layout)
    assert out["gate"] == {"rows_in": 7, "failed_malformed": 3, "failed_negative": 1, "failed_null_route": 1,
                           "failed_bad_device_type": 1, "rows_out": 2}
    assert (out["rows"], out["quarantined"], out["devices"]) == (2, 5, 1)
    clean = read_layer(spark, layout.processed("page_loads"))
    assert {(r.event_id, r.device_class) for r in clean.collect()} == {("e1", "low-end"), ("e6", "low-end")}
    assert not {"record", "reasons", "_record", "_corrupt_record", "outcome"} & set(clean.columns) and clean.columns[-1] == "event_date"
    found = quarantined(spark, layout, "page_loads")
    assert [r for r in found if r[0] == ["malformed"]] == sorted((["malformed"], lines[i]) for i in (1, 2, 3))
    others = {tuple(r): json.loads(text) for r, text in found if r != ["malformed"]}
    assert set(others) == {("negative", "bad_device_type"), ("null_route",)}
    assert others["negative", "bad_device_type"]["device_type"] == "fridge"      # as it came, not as it was normalised
    assert quarantined(spark, layout, "devices") == [(["malformed"], '[{"device_id": "m2", ')]


def test_exchanged_days_take_their_quarantine_along(spark, layout):
    layout, raw = layout
    for day, name in ((1, "a"), (2, "b")):
        (raw / "page_loads" / f"{name}.jsonl").write_text("\n".join(
            json.dumps(load(n, timestamp=f"2031-08-0{day}T10:00:00Z", cls=-1.0 if n == 0 else 0.1)) for n in range(3)))
    assert jobs.ingest_page_loads(spark, layout)["quarantined"] == 2
    (raw / "page_loads" / "a.jsonl").write_text("\n".join(
        json.dumps(load(n, timestamp="2031-08-02T10:00:00Z", inp_ms=-1.0)) for n in range(4)))
    (raw / "page_loads" / "b.jsonl").unlink()
    out = jobs.ingest_page_loads(spark, layout, replace_dates=True)
    assert (out["rows"], out["quarantined"]) == (0, 4)
    days = read_layer(spark, layout.quarantine("page_loads")).groupBy("event_date").count().collect()
    assert sorted((str(r.event_date), r["count"]) for r in days) == [("2031-08-01", 1), ("2031-08-02", 4)]
    assert read_layer(spark, layout.processed("page_loads")).count() == 2        # the second day has no clean rows now


def test_lab_reports_and_field_metrics(spark, layout):
    layout, raw = layout
    run = {"report_id": "a", "run_timestamp": "2031-08-01T06:00:00Z", "route": "/", "device_type": "pc", "environment": "production",
           "release_version": "r1", "lcp_ms": 900, "cls": 0.1, "inp_ms": 80, "ttfb_ms": 300, "performance_score": 90}
    (raw / "lab_reports" / "a.json").write_text(json.dumps([run, run | {"environment": "staging"}, run | {"inp_ms": -2}]))
    (raw / "lab_reports" / "b.json").write_text("[" + json.dumps(run)[:40])
    out = jobs.ingest_lab(spark, layout)
    assert (out["rows"], out["quarantined"]) == (1, 2) and out["gate"]["failed_malformed"] == 1 and out["gate"]["rows_in"] == 3
    assert [r[0] for r in quarantined(spark, layout, "lab_reports")] == [["malformed"], ["negative"]]

    good = ["2031-08-01", "https://o", "/a", "phone", "4g", "2000", "0.05", "180"] + ["0.5"] * 9 + ["42"]
    rows = [good, good[:5], good[:5] + ["two seconds"] + good[6:], good[:-1] + ["0"]]
    (raw / "field_metrics" / "f.csv").write_text("\n".join([",".join(FIELD_METRICS_SCHEMA.fieldNames()), *map(",".join, rows)]) + "\n")
    out = jobs.ingest_field_metrics(spark, layout)
    assert (out["rows"], out["quarantined"]) == (1, 3)
    assert out["gate"]["failed_malformed"] == 2 and out["gate"]["failed_bad_sample_count"] == 1
    assert sorted(r[0] for r in quarantined(spark, layout, "field_metrics")) == [["bad_sample_count"], ["malformed"], ["malformed"]]


def test_one_pass_over_the_raw_files(spark, layout):
    layout, raw = layout
    (raw / "page_loads" / "a.jsonl").write_text("\n".join(json.dumps(load(n, lcp_ms=-1.0 if n % 4 == 0 else 1.0)) for n in range(40)))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    frame = jobs.readers.read_page_loads(spark, layout.raw("page_loads"))
    jobs.ingest_page_loads(spark, layout, frame.mapInArrow(counted, frame.schema))
    assert reads.value == 40
