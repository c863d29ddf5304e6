"""P1-P6 from raw files on disk (the readers inside the jobs), using the
sf0.001 driver rows written out in the raw layouts, against the query
catalogue computed from the same rows."""
import json

from pyspark.sql import functions as F

from perfwatch.plans import cli, jobs
from perfwatch.plans.queries import DriverTables, queries
from perfwatch.sources import adapters, read_layer

SF = "/root/testdata/sf0.001"


def _json_array_files(df, out_dir, by):
    """One JSON array file per value of ``by`` (small test data only)."""
    out_dir.mkdir(parents=True)
    pdf = df.toPandas()
    for key, part in pdf.groupby(by, dropna=False):
        records = json.loads(part.drop(columns=[by]).to_json(orient="records"))
        (out_dir / f"part_{key}.json").write_text(json.dumps(records, indent=1))


def test_pipeline_from_raw_files(spark, tmp_path):
    t = DriverTables(spark, SF)
    events = t.table("events")
    root = tmp_path / "wv"
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

    lab = adapters.lab_reports_from_events(events).withColumn(
        "run_timestamp", F.date_format("run_timestamp", iso)).withColumn("_day", F.substring("run_timestamp", 1, 10))
    _json_array_files(lab, root / "raw" / "lab_reports", "_day")
    adapters.field_metrics_from_events(events).write.option("header", True).csv(str(root / "raw" / "field_metrics"))
    adapters.page_loads_from_events(events).withColumn("timestamp", F.date_format("timestamp", iso)) \
        .write.json(str(root / "raw" / "page_loads"))
    devices = adapters.devices_from_nation(t.table("nation")).withColumn("_one", F.lit(1))
    _json_array_files(devices, root / "raw" / "devices", "_one")

    out = cli.main(["all", "--root", str(root)])

    q = queries()
    assert out["page_loads"]["rows"] == q["quality_clean"](spark, SF).count()
    assert out["lab"]["rows"] == q["lab_clean"](spark, SF).count()
    assert out["field"]["rows"] == q["field_metrics_clean"](spark, SF).count()
    layout = jobs.Layout(str(root))
    for name, table in [("daily_vitals", "core_web_vitals_daily"), ("route_rankings", "route_performance_rankings"),
                        ("device_breakdown", "device_breakdowns"), ("before_after", "before_after_comparisons"),
                        ("regression_events", "regression_events")]:
        expect = q[name](spark, SF)
        got = read_layer(spark, layout.curated(table)).select(*expect.columns)
        assert got.count() == expect.count(), name
        assert got.exceptAll(expect).count() == 0, name
