from datetime import date

import pytest
from pyspark.sql import functions as F

from perfwatch.functions.stats import mean_of_rounded
from perfwatch.operators import reports
from perfwatch.operators.enrich import enrich_with_devices, hot_devices
from perfwatch.operators.rankings import route_rankings
from perfwatch.operators.regressions import detect_regressions
from perfwatch.operators.releases import before_after, release_aggregates, release_pairs
from perfwatch.operators.rollups import (
    daily_vitals,
    device_breakdown,
    device_summary,
    health_trend_pivot,
    overall_health,
    route_summary,
)


def test_daily_vitals_known_answers(page_logs, load):
    rows = [load(7, "n", lcp=v, cls=0.03 * i, inp=90.0 + 60 * i, ttfb=250.0 + 50 * i)
            for i, v in enumerate([800.0, 1700.0, 2600.0, 3500.0])]
    r = daily_vitals(page_logs(rows)).first()
    assert (r.date, r.sample_count, r.avg_lcp_ms, r.p75_lcp_ms) == (date(2031, 3, 7), 4, 2150.0, 2600.0)
    assert (r.p75_cls, r.p75_inp_ms, r.avg_ttfb_ms) == (0.06, 210.0, 325.0)
    # good: LCP up to 2500 in 2 of 4, INP up to 200 in 90 and 150, CLS up to 0.1 in all
    assert (r.good_lcp_rate, r.good_inp_rate, r.good_cls_rate) == (0.5, 0.5, 1.0)
    assert 0 < r.overall_health_score < 100 * 4 / 30


def test_device_breakdown_keeps_unmatched_devices(spark):
    loads = spark.createDataFrame(
        [("2026-05-01", "/", "mobile", "d1", "4G", 1000.0, 0.01, 90.0),
         ("2026-05-01", "/", "mobile", "zz", "4G", 5000.0, 0.3, 900.0),
         ("2026-05-01", "/", "mobile", None, "4G", 1200.0, 0.01, 90.0)],
        "d string, route string, device_type string, device_id string, connection_type string, "
        "lcp_ms double, cls double, inp_ms double").withColumn("event_date", F.to_date("d"))
    devices = spark.createDataFrame([("d1", "low-end", "3G", "Phone A")],
                                    "device_id string, device_class string, network_profile string, device_name string")
    enriched = enrich_with_devices(loads, devices)
    assert enriched.count() == 3 and "device_name" not in enriched.columns
    got = {r.device_class: (r.sample_count, r.risk_level) for r in device_breakdown(enriched).collect()}
    assert got == {"low-end": (1, "low"), None: (2, "critical")}


def test_rankings_dense_ranks_and_null_lab_score(spark, page_logs, load):
    rows = [load(9, "n", "/a", lcp=1000.0), load(9, "n", "/b", lcp=3000.0), load(9, "n", "/c", lcp=3000.0, cls=0.2)]
    daily = daily_vitals(page_logs(rows))
    lab = spark.createDataFrame([("2031-03-09", "/a", "tablet", 60.0), ("2031-03-09", "/a", "tablet", 80.0),
                                 ("2031-03-09", "/b", "tablet", 90.0)],
                                "d string, route string, device_type string, performance_score double"
                                ).withColumn("report_date", F.to_date("d"))
    got = {r.route: r for r in route_rankings(daily, lab).collect()}
    assert got["/a"].performance_score == 70.0 and got["/c"].performance_score is None
    assert [got[k].rank_overall for k in "/a /b /c".split()] == [2, 1, 3]
    assert [got[k].rank_lcp for k in "/a /b /c".split()] == [1, 2, 2]
    assert [got[k].risk_level for k in "/a /b /c".split()] == ["low", "medium", "high"]
    assert list(got["/a"].asDict()) == ["date", "route", "device_type", "p75_lcp_ms", "p75_cls", "p75_inp_ms",
                                         "performance_score", "rank_overall", "rank_lcp", "rank_cls",
                                         "rank_inp", "risk_level"]


@pytest.fixture
def curated(page_logs, load):
    rows = [load(day, release, route, device, lcp=lcp)
            for day, release, lcp in ((11, "n", 1500.0), (12, "n", 1600.0), (13, "o", 2600.0), (14, "o", 2700.0))
            for route, device in (("/a", "mobile"), ("/b", "desktop"), ("/c", "tablet"))]
    loads = page_logs(rows)
    pairs = release_pairs(release_aggregates(loads))
    return daily_vitals(loads), before_after(pairs), detect_regressions(pairs)


def test_report_aggregates_and_top_lists(curated):
    daily, comparisons, events = curated
    o = overall_health(daily).first()
    assert (o.total_samples, o.routes, str(o.start_date), str(o.end_date)) == (12, 3, "2031-03-11", "2031-03-14")
    assert route_summary(daily).count() == 3
    assert [r.device_type for r in device_summary(daily).collect()] == ["desktop", "mobile", "tablet"]
    assert health_trend_pivot(daily).columns == ["date", "mobile", "desktop", "tablet"]
    assert reports.top_regressions(events).count() == 3
    assert reports.top_improvements(comparisons).count() == 0
    assert [r.metric for r in reports.recommended_actions(events).collect()] == ["LCP"]


def digest(*frames):
    lines = reports.summary_lines(*frames, generated_at=F.lit("now")).orderBy("section", "line_no").collect()
    sections: dict = {}
    for r in lines:
        sections.setdefault(r.section, []).append(r.line)
    assert all(list(range(len(v))) == [r.line_no for r in lines if r.section == k] for k, v in sections.items())
    return sections


def test_digest(curated):
    found = digest(*curated)
    assert found[0] == ["PERFWATCH DIGEST, now"] and [found[i][0] for i in range(1, 8)] == list(reports.SECTIONS)
    assert found[1][1].startswith("2031-03-11 to 2031-03-14: 12 page loads on 3 routes, mean health ")
    assert [line.split(":")[0] for line in found[1][2:]] == [f"2031-03-14 {d}" for d in ("desktop", "mobile", "tablet")]
    assert found[4][1:] == [reports.NOTHING] and len(found[5]) == 4 and len(found[7]) == 2
    assert found[5][1] == "critical: LCP of /a on mobile since o, 1600.0 to 2700.0 (68.75 %)"


def test_digest_of_nothing(curated):
    found = digest(*(frame.limit(0) for frame in curated))
    assert found[1][1] == "- to -: - page loads on 0 routes, mean health - of 100"
    assert all(lines[-1] == reports.NOTHING for section, lines in found.items() if section > 0)


def test_means_keep_every_value(spark):
    df = spark.createDataFrame([("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 2.0), ("big", 1e18),
                                ("big", 0.0), ("tie", 0.1), ("tie", 0.2), ("tie", None)], "k string, v double")
    got = {r.k: r.m for r in df.groupBy("k").agg(mean_of_rounded("v", 1, 1).alias("m")).collect()}
    assert str(got["nan"]) == "nan" and got["inf"] == float("inf") and got["big"] == 5e17 and got["tie"] == 0.2


def test_exports_are_ordered(curated, spark):
    daily, comparisons, events = curated
    lab = spark.createDataFrame([], "report_date date, route string, device_type string, performance_score double")
    for frame, keys in ((reports.export_rankings(route_rankings(daily, lab)), ("date", "device_type", "rank_overall", "route")),
                        (reports.export_before_after(comparisons), ("route", "device_type", "before_release"))):
        rows = [tuple(r[k] for k in keys) for r in frame.collect()]
        assert rows == sorted(rows) and rows
    dates = [e.detected_at for e in reports.export_regressions(events).collect()]
    assert dates == sorted(dates, reverse=True)


def test_worst_route_breakdown_uses_top_route(spark, page_logs, load):
    loads = page_logs([load(9, "n", "/slow", lcp=4000.0), load(9, "n", "/fast", lcp=1000.0), load(8, "n", "/old", lcp=9000.0)])
    loads = loads.withColumn("device_class", F.lit("low-end")).withColumn("connection_type", F.lit("4G"))
    lab = spark.createDataFrame([("2031-03-09", "/slow", "tablet", 20.0), ("2031-03-09", "/fast", "tablet", 90.0),
                                 ("2031-03-08", "/old", "tablet", 1.0)],
                                "d string, route string, device_type string, performance_score double"
                                ).withColumn("report_date", F.to_date("d"))
    ranked = route_rankings(daily_vitals(loads), lab)
    assert [r.route for r in reports.worst_now(ranked).collect()] == ["/slow", "/fast"]
    whole = reports.worst_route_breakdown(ranked, device_breakdown(loads)).collect()
    day = ranked.where("date = '2031-03-09'")
    first = reports.breakdown_head(device_breakdown(reports.of_worst_route(day, loads))).collect()
    assert [r.asDict() for r in whole] == [r.asDict() for r in first]
    assert {r.route for r in whole} == {"/slow"}


def test_enrichment_keeps_rows_without_an_id(spark):
    loads = spark.createDataFrame([("d1", 1.0), (None, 2.0), ("", 3.0), (None, 4.0), ("zz", 5.0)], "device_id string, lcp_ms double")
    devices = spark.createDataFrame([("d1", "low-end", "3G"), ("", "odd", "4G"), (None, "none", "5G")],
                                    "device_id string, device_class string, network_profile string")
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = sorted((r.lcp_ms, r.device_class) for r in enrich_with_devices(loads, devices).collect())
        assert got == [(1.0, "low-end"), (2.0, None), (3.0, "odd"), (4.0, None), (5.0, None)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_device_is_cut_into_parts(spark):
    """Half of the rows on one device, AQE off, shuffled join: no task gets more than its share."""
    loads = spark.range(40_000).selectExpr(
        "concat('e', id) AS event_id", "CAST(id AS DOUBLE) AS lcp_ms",
        "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL WHEN id % 10 = 3 THEN '' ELSE concat('d', id % 3000) END AS device_id")
    devices = spark.range(3000).selectExpr("concat('d', id) AS device_id", "'mid' AS device_class", "'4G' AS network_profile").union(
        spark.createDataFrame([("hot", "low", "3G"), ("", "none", "5G"), (None, "x", "x")], "device_id string, device_class string, network_profile string"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = hot_devices(loads, 64)
        assert {r["device_id"]: r["copies"] for r in hot.collect()} == {"hot": 36, "": 8}
        columns = ["event_id", "lcp_ms", "device_id", "device_class", "network_profile"]

        def largest_task(joined):
            assert joined.columns == columns
            return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain, cut_up = enrich_with_devices(loads, devices), enrich_with_devices(loads, devices, hot)
        assert largest_task(plain) > 20_000 and largest_task(cut_up) < 10_000
        assert cut_up.exceptAll(plain).isEmpty() and plain.exceptAll(cut_up).isEmpty()
        assert cut_up.where("device_id IS NULL AND device_class IS NOT NULL").isEmpty()
        plan = cut_up._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
