import os

import pytest
from pyspark.sql import functions as F

from perfwatch.plans import cli, jobs
from perfwatch.plans.queries import DriverTables, queries
from perfwatch.sources import adapters, read_layer, sinks

SF = "/root/testdata/sf0.001"


def test_run_all_end_to_end(spark, tmp_path):
    t = DriverTables(spark, SF)
    events = t.table("events")
    layout = jobs.Layout(str(tmp_path / "wv"))
    out = jobs.run_all(spark, layout, lab=adapters.lab_reports_from_events(events),
                       field=adapters.field_metrics_from_events(events),
                       page_loads=adapters.page_loads_from_events(events),
                       devices=adapters.devices_from_nation(t.table("nation")),
                       generated_at=F.lit("test"))
    q = queries()
    assert out["page_loads"]["rows"] == q["quality_clean"](spark, SF).count()
    gate = out["page_loads"]["gate"]
    assert gate["rows_in"] == events.count() and gate["rows_out"] == out["page_loads"]["rows"]
    assert out["curated"]["daily"] == q["daily_vitals"](spark, SF).count()
    assert out["curated"]["before_after"] == q["before_after"](spark, SF).count()
    assert out["regressions"]["rows"] == q["regression_events"](spark, SF).count()
    for name in ("route_rankings", "regression_events", "before_after_comparison", "device_breakdown", "summary"):
        assert any(p.startswith("part-") for p in os.listdir(layout.report(name)))
    # curated daily read back from disk equals the query result
    daily = read_layer(spark, layout.curated("core_web_vitals_daily"))
    expect = q["daily_vitals"](spark, SF)
    assert daily.select(*expect.columns).exceptAll(expect).count() == 0
    # P5 on its own (recomputing aggregates from processed page loads) agrees
    alone = jobs.build_regressions(spark, layout)
    assert alone["rows"] == out["regressions"]["rows"]


@pytest.fixture
def site(spark, tmp_path):
    """Two releases of one page, and a third that arrives later."""
    layout = jobs.Layout(str(tmp_path / "site"))
    devices = spark.createDataFrame([("d", "low-end", "3G")], "device_id string, device_class string, network_profile string")

    def ingest(*releases):
        rows = [(f"e{i}{j}", f"2031-04-{2 + 5 * i:02d}T10:00:00Z", "/docs", "tablet", "d", lcp, 0.01, 90.0, 300.0, name, None,
                 None, None, "4G") for i, (name, lcp) in enumerate(releases) for j in range(3)]
        raw = spark.createDataFrame(rows, "event_id string, timestamp string, route string, device_type string, "
                                          "device_id string, lcp_ms double, cls double, inp_ms double, ttfb_ms double, "
                                          "release_version string, fcp_ms double, page_weight_kb double, js_error_count int, "
                                          "connection_type string")
        jobs.ingest_page_loads(spark, layout, raw, devices)

    ingest(("one", 1000.0), ("two", 1100.0))
    spark.createDataFrame([], "report_date date, route string, device_type string, performance_score double").write.parquet(
        layout.processed("lab_reports"))
    return layout, ingest


def test_regressions_are_never_stale(spark, site):
    layout, ingest = site
    jobs.build_curated(spark, layout)
    ingest(("one", 1000.0), ("two", 1100.0), ("three", 2400.0))
    assert jobs.build_regressions(spark, layout)["by_severity"] == {"critical": 1}
    assert jobs.build_regressions(spark, layout, reuse_aggregates=True)["rows"] == 0


def test_thresholds_reach_tables_and_command_line(spark, site):
    layout, _ = site
    status = lambda: [r.improvement_status for r in read_layer(spark, layout.curated("before_after_comparisons")).collect()]
    assert cli.main(["curated", "--root", layout.root])["before_after"] == 1 and status() == ["stable"]
    assert cli.main(["regressions", "--root", layout.root])["rows"] == 0
    strict = ["--lcp-regression-pct", "0.05"]
    cli.main(["curated", "--root", layout.root, *strict])
    assert status() == ["regressed"]
    assert cli.main(["regressions", "--root", layout.root, *strict])["rows"] == 1


def test_jobs_need_utc(spark, site):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            jobs.build_regressions(spark, site[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
