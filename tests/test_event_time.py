"""Regression events of the stream: those of the batch over closed days, in whatever order files arrive."""
import json
import random

import pytest
from pyspark.sql import functions as F

from perfwatch.config import PAGE_LOAD_QUALITY
from perfwatch.operators.normalize import normalize_page_loads
from perfwatch.operators.quality import apply_quality
from perfwatch.operators.regressions import detect_regressions
from perfwatch.operators.releases import release_aggregates, release_aggregates_from_counts, release_pairs
from perfwatch.plans.jobs import Layout
from perfwatch.sources import read_layer
from perfwatch.sources.readers import read_page_loads
from perfwatch.streaming.regressions import COUNTS, EVENTS, closed_counts, start_regression_stream, value_counts


def page_loads(days, seed):
    """By day: page loads of a route whose third and sixth day bring a worse release; some fail the gate or hold NULLs."""
    rng = random.Random(seed)
    found = {}
    for day in days:
        rows = []
        for i in range(60):
            release = f"r{day // 3}"
            slow = 1.0 + (day // 3) * 0.4
            rows.append({
                "event_id": f"{day}-{i}", "timestamp": f"2031-04-{day:02d}T{i % 24:02d}:10:00Z", "route": f"/shop/{i % 2}",
                "device_type": "mobile" if i % 3 else "desktop", "lcp_ms": round(1800 * slow + rng.random() * 400, 3),
                "cls": None if i % 11 == 0 else round(rng.random() * 0.2, 5), "inp_ms": -5.0 if i == 7 else 150 * slow + i,
                "ttfb_ms": 300.0 + rng.random(), "release_version": None if i % 29 == 0 else release})
        found[day] = rows
    return found


def lines(rows):
    return "\n".join(json.dumps(r) for r in rows)


def normalised(spark, path):
    return apply_quality(normalize_page_loads(read_page_loads(spark, path)), PAGE_LOAD_QUALITY)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def site(tmp_path):
    folder = tmp_path / "site" / "raw" / "page_loads_stream"
    folder.mkdir(parents=True)
    return Layout(str(tmp_path / "site")), folder, str(tmp_path / "checkpoint")


def run(spark, layout, checkpoint, **options):
    query = start_regression_stream(spark, layout, checkpoint=checkpoint, **options)
    query.awaitTermination(150)
    return query


def test_shuffled_arrival_gives_the_batch_events(spark, site):
    layout, folder, checkpoint = site
    days = page_loads(range(1, 9), 5)
    # a file mixes rows of neighbouring days, and the files of a window of days come in any order
    pool = [r for day in days.values() for r in day]
    random.Random(3).shuffle(pool)
    parts = {}
    for r in pool:
        parts.setdefault((int(r["timestamp"][8:10]) - 1) // 2, []).append(r)
    for n, part in sorted(parts.items()):
        (folder / f"{n}-a.jsonl").write_text(lines(part[::2]))
        run(spark, layout, checkpoint, open_days=3)
        (folder / f"{n}-b.jsonl").write_text(lines(part[1::2]) + '\n{"event_id": "undated", "route": "/shop/1", "device_type": "mobile"}')
    (folder / "z.jsonl").write_text(lines([{**pool[0], "timestamp": "2031-05-30T00:00:00Z"}]))   # closes all days of April
    run(spark, layout, checkpoint, open_days=3)

    loads = normalised(spark, str(folder)).where("event_date < '2031-05-01'")
    batch = release_aggregates(loads)
    assert rows_of(release_aggregates_from_counts(closed_counts(spark, layout))) == rows_of(batch)
    wanted = detect_regressions(release_pairs(batch))
    assert wanted.count() > 3
    assert rows_of(read_layer(spark, layout.curated(EVENTS))) == rows_of(wanted)


def test_open_days_wait_and_late_rows_are_not_counted(spark, site):
    layout, folder, checkpoint = site
    days = page_loads(range(1, 7), 9)
    (folder / "a.jsonl").write_text(lines(days[1] + days[2] + days[3] + days[4]))
    run(spark, layout, checkpoint, open_days=2)

    def closed():
        return {str(r[0]): r[1] for r in closed_counts(spark, layout).where("metric = 'lcp'").groupBy("event_day").agg(F.sum("rows")).collect()}

    assert closed() == {"2031-04-01": 59, "2031-04-02": 59}
    (folder / "b.jsonl").write_text(lines(days[1][:20] + days[3][:10] + days[6]))       # day 1 is closed, day 3 is not
    query = run(spark, layout, checkpoint, open_days=2)
    assert closed() == {"2031-04-01": 59, "2031-04-02": 59, "2031-04-03": 68, "2031-04-04": 59}
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) > 0
    before = rows_of(closed_counts(spark, layout))
    run(spark, layout, checkpoint, open_days=2)                                          # nothing new
    assert rows_of(closed_counts(spark, layout)) == before


def test_counts_give_the_aggregates_of_page_loads(spark, site):
    layout, folder, checkpoint = site
    (folder / "a.jsonl").write_text(lines([r for day in page_loads(range(1, 6), 1).values() for r in day]))
    loads = normalised(spark, str(folder))
    assert rows_of(release_aggregates_from_counts(value_counts(loads, 1).withColumn("event_day", F.to_date("event_day")))
                   ) == rows_of(release_aggregates(loads))
    none = loads.limit(0)
    assert release_aggregates_from_counts(value_counts(none, 1)).count() == 0
    with pytest.raises(ValueError, match="open"):
        start_regression_stream(spark, layout, checkpoint, open_days=0)
    assert COUNTS != EVENTS
