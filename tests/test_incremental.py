"""P4 day by day equals P4 over everything, and touches nothing else."""
import json
import random
import time

import pytest

from perfwatch.operators import releases
from perfwatch.plans import jobs
from perfwatch.sources import read_layer, sinks
from perfwatch.streaming import start_page_load_ingest

TABLES = {"core_web_vitals_daily": "date", "route_performance_rankings": "date", "device_breakdowns": "date",
          "release_aggregates": None, "before_after_comparisons": None}


def page_loads(days, release, count=25, routes=("/", "/docs", "/pay"), shift=0.0):
    """Raw page loads; every release is seen on the days it is asked for only."""
    rng = random.Random(f"{days}{release}{shift}")
    return [{"event_id": f"{release}-{day}-{n}", "timestamp": None if day is None else f"2031-05-{day:02d}T09:{n:02d}:00Z",
             "route": rng.choice(routes), "device_type": rng.choice(["phone", "desktop"]), "device_id": f"m{rng.randrange(3)}",
             "connection_type": "4g", "lcp_ms": 900 + shift + 2000 * rng.random(), "cls": rng.random() / 5, "inp_ms": 300 * rng.random(),
             "ttfb_ms": 400.0 + 300 * rng.random(), "release_version": release} for day in days for n in range(count)]


@pytest.fixture
def site(spark, tmp_path):
    devices = spark.createDataFrame([("m0", "low-end", "3G"), ("m1", "high-end", "5G")],
                                    "device_id string, device_class string, network_profile string")
    lab_schema = "report_date date, route string, device_type string, performance_score double"

    def make(name):
        layout = jobs.Layout(str(tmp_path / name))

        def ingest(rows, replace=True):
            raw = spark.read.schema(jobs.readers.PAGE_LOAD_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 3))
            return jobs.ingest_page_loads(spark, layout, raw, devices, replace_dates=replace)

        def lab(*rows):
            df = spark.createDataFrame([(d, "/docs", "mobile", s) for d, s in rows], lab_schema.replace("date date", "date string"))
            sinks.write_partitioned(df.withColumn("report_date", df.report_date.cast("date")), layout.processed("lab_reports"),
                                    "report_date")

        lab(("2031-05-01", 80.0))
        return layout, ingest, lab

    return make


def tables(spark, layout):
    return {name: sorted(map(repr, read_layer(spark, layout.curated(name)).collect())) for name in TABLES}


def test_days_added_exchanged_and_removed(spark, site):
    layout, ingest, lab = site("a")
    full, ingest_full, lab_full = site("b")
    state = {}

    def both(days_rows, build=True):
        """Exchange these days here; write everything anew there."""
        state.update(days_rows)
        ingest([r for rows in days_rows.values() for r in rows])
        ingest_full([r for rows in state.values() for r in rows], replace=False)
        done = jobs.build_curated(spark, layout)
        jobs.build_curated(spark, full, full=True)
        assert tables(spark, layout) == tables(spark, full)
        return done

    both({1: page_loads([1], "r1"), 2: page_loads([2], "r1") + page_loads([2], "r2"), None: page_loads([None], "r0", 5)})
    before = {name: sinks.partitions(spark, layout.curated(name)) for name, column in TABLES.items() if column}
    aggregates = {tuple(r) for r in read_layer(spark, layout.curated("release_aggregates")).collect()}

    # one day more, of a new release and an old one
    done = both({3: page_loads([3], "r3", shift=1500.0) + page_loads([3], "r2", 4)})
    for name, parts in before.items():
        after = sinks.partitions(spark, layout.curated(name))
        assert {k for k in after if after[k] != parts.get(k)} == {"date=2031-05-03"}
    assert done["daily"] == read_layer(spark, layout.curated("core_web_vitals_daily")).where("date = '2031-05-03'").count()
    changed = {tuple(r) for r in read_layer(spark, layout.curated("release_aggregates")).collect()} ^ aggregates
    assert {r[2] for r in changed} <= {"r2", "r3"}

    # a day exchanged: r1 loses its rows there, r2 gets others; then nothing at all
    both({2: page_loads([2], "r2", shift=300.0)})
    again = jobs.build_curated(spark, layout)
    assert (again["daily"], again["rankings"], again["breakdown"], again["release_aggregates"]) == (0, 0, 0, 0)

    # new lab reports rank their days anew, and only the rankings
    for write in (lab, lab_full):
        write(("2031-05-01", 80.0), ("2031-05-03", 55.0))
    done = jobs.build_curated(spark, layout)
    jobs.build_curated(spark, full)
    assert done["daily"] == 0 and done["rankings"] > 0 and tables(spark, layout) == tables(spark, full)

    # everything but two days goes
    state.clear()
    rows = page_loads([2, 9], "r4")
    ingest(rows, replace=False)
    ingest_full(rows, replace=False)
    jobs.build_curated(spark, layout)
    jobs.build_curated(spark, full, full=True)
    assert tables(spark, layout) == tables(spark, full)
    assert sorted(sinks.partitions(spark, layout.curated("core_web_vitals_daily"))) == ["date=2031-05-02", "date=2031-05-09"]


def test_a_run_that_died_is_completed_by_the_next(spark, site, monkeypatch):
    layout, ingest, _ = site("a")
    full, ingest_full, _ = site("b")
    ingest(page_loads([1, 2], "r1"))
    jobs.build_curated(spark, layout)
    ingest(page_loads([2], "r2", shift=800.0))
    ingest_full(page_loads([1, 2], "r1")[:25] + page_loads([2], "r2", shift=800.0), replace=False)
    before = tables(spark, layout)
    with monkeypatch.context() as dies:     # after the partials have been published
        dies.setattr(releases, "release_aggregates_from_partials", lambda *a: 1 / 0)
        dies.setattr(jobs.rollups, "daily_from_partials", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.build_curated(spark, layout)
    after = tables(spark, layout)
    assert after["core_web_vitals_daily"] == before["core_web_vitals_daily"]
    assert after["release_aggregates"] == before["release_aggregates"]
    jobs.build_curated(spark, layout)
    jobs.build_curated(spark, full)
    assert tables(spark, layout) == tables(spark, full)


def test_days_of_new_stream_batches_are_built(spark, site, tmp_path):
    layout, ingest, _ = site("a")
    ingest(page_loads([1, 2], "r1"))
    first = jobs.build_curated(spark, layout)
    raw = tmp_path / "a" / "raw" / "page_loads_stream"
    raw.mkdir(parents=True)
    (raw / "late.jsonl").write_text("\n".join(map(json.dumps, page_loads([2], "r9"))))
    start_page_load_ingest(spark, layout, checkpoint=str(tmp_path / "stream")).awaitTermination(120)
    days = sinks.partitions(spark, layout.curated("core_web_vitals_daily"))
    done = jobs.build_curated(spark, layout)
    now = sinks.partitions(spark, layout.curated("core_web_vitals_daily"))
    assert 0 < done["daily"] <= first["daily"] * 2 and now["date=2031-05-01"] == days["date=2031-05-01"]
    built = tables(spark, layout)
    jobs.build_curated(spark, layout, full=True)
    assert tables(spark, layout) == built and any("r9" in r for r in built["release_aggregates"])


def test_one_failure_cancels_the_other_jobs(spark):
    def sleepy(batches):
        time.sleep(0.5)
        yield from batches

    began = time.time()
    with pytest.raises(ZeroDivisionError):
        jobs.concurrently(spark, slow=lambda: spark.range(0, 640, 1, 640).mapInArrow(sleepy, "id long").count(),
                          bad=lambda: time.sleep(1) or 1 / 0)
    assert time.time() - began < 20        # 40 seconds of tasks were left
    assert jobs.concurrently(spark, a=lambda: spark.range(3).count(), b=lambda: 2) == {"a": 3, "b": 2}
