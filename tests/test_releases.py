"""Release pairing, status and regression events on rows of our own."""
import itertools
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from perfwatch.config import DEFAULT_THRESHOLDS, RegressionThresholds
from perfwatch.operators import aggregate as agg
from perfwatch.operators.rankings import route_rankings
from perfwatch.operators.regressions import detect_regressions, events_by_severity, metric_events, union_events
from perfwatch.operators.releases import before_after, consecutive_pairs, release_aggregates, release_pairs
from perfwatch.operators.rollups import daily_vitals


@pytest.fixture
def pairs(page_logs):
    return lambda rows: release_pairs(release_aggregates(page_logs(rows)))


def neighbours(frame):
    return {(r.before_release, r.after_release) for r in frame.collect()}


def test_order_is_time_not_name(pairs, load):
    names = ["9.9", "spring", "0.1", "b", "a"]
    rows = [load(2 + 4 * i, name) for i, name in enumerate(names)] + [load(28, "9.9")]     # seen again later
    assert neighbours(pairs(rows)) == set(itertools.pairwise(names))


def test_releases_of_one_day_pair_with_all_of_the_next(pairs, load):
    days = {3: ["x1", "x2", "x3"], 9: ["y1"], 17: ["z1", "z2"]}
    rows = [load(day, name) for day, names in days.items() for name in names]
    want = {p for a, b in itertools.pairwise(days.values()) for p in itertools.product(a, b)}
    assert neighbours(pairs(rows)) == want


def test_undated_and_unnamed_releases(pairs, load):
    rows = [load(None, "undated"), load(None, "too"), load(5, None), load(6, None), load(7, "named")]
    assert neighbours(pairs(rows)) == {("undated", None), ("too", None), (None, "named")}


def test_releases_of_one_day_meet_in_bounded_groups(spark):
    """Seven undated releases and five of the first day, in blocks of two: all 35 pairs, none twice."""
    from perfwatch.config import METRICS

    values = [F.lit(1.0).alias(f"p75_{m.stem}") for m in METRICS]
    ranked = spark.range(13).selectExpr(
        "'/a' AS route", "CAST(NULL AS STRING) AS device_type", "CAST(id AS STRING) AS release_version",
        "CASE WHEN id = 12 THEN DATE'2031-03-09' WHEN id >= 7 THEN DATE'2031-03-04' END AS release_start_date",
        "CASE WHEN id = 12 THEN 3 WHEN id >= 7 THEN 2 ELSE 1 END AS release_rank").select("*", *values)
    wanted = [(str(x), str(y)) for x in range(7) for y in range(7, 12)] + [(str(x), "12") for x in range(7, 12)]
    for block in (1, 2, 5, 256):
        found = consecutive_pairs(ranked, block).select("before_release", "after_release").collect()
        assert sorted(map(tuple, found)) == sorted(wanted)
    groups = consecutive_pairs(ranked, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in groups and "RepartitionByExpression" in groups


def test_many_undated_releases_of_one_route(spark):
    from perfwatch.config import METRICS

    values = [F.lit(1.0).alias(f"p75_{m.stem}") for m in METRICS]
    undated = spark.range(100_000).select(F.lit("/a").alias("route"), F.lit(None).cast("string").alias("device_type"),
                                          F.col("id").cast("string").alias("release_version"),
                                          F.lit(None).cast("date").alias("release_start_date"), *values)
    dated = undated.where("release_version = '7'").withColumn("release_start_date", F.lit("2031-03-04").cast("date"))
    found = release_pairs(undated.unionByName(dated))
    assert found.agg(F.count("*"), F.countDistinct("before_release"), F.max("after_release")).first() == (100_000, 100_000, "7")


def test_other_routes_and_devices_never_pair(pairs, load):
    rows = [load(1, "a"), load(2, "b", route="/faq"), load(3, "c", device="mobile")]
    assert pairs(rows).count() == 0


def test_events_carry_the_arithmetic(pairs, load):
    rows = [load(1, "one", lcp=1600.0, cls=0.05, inp=80.0, ttfb=410.0),
            load(8, "two", lcp=2240.0, cls=0.18, inp=90.0, ttfb=430.0)]
    found = {e.metric: e for e in detect_regressions(pairs(rows)).collect()}
    assert set(found) == {"LCP", "CLS"}
    slow, shift = found["LCP"], found["CLS"]
    # 640 / 1600 = 40 %: twice the 20 % allowed, 2240 / 2500 is less
    assert (slow.baseline_value, slow.current_value, slow.delta, slow.delta_percent, slow.severity) == (
        1600.0, 2240.0, 640.0, 40.0, "critical")
    # 0.13 / 0.05 = 2.6 times the shift allowed
    assert (shift.delta, shift.delta_percent, shift.severity) == (0.13, 260.0, "critical")
    assert {(e.release_version, str(e.detected_at)) for e in found.values()} == {("two", "2031-03-08")}


@pytest.mark.parametrize("change,severity", [
    (dict(ttfb=(400.0, 504.0)), "low"),          # 26 %: 1.04 times the limit
    (dict(inp=(100.0, 125.0)), "medium"),        # 25 %: 1.25 times
    (dict(cls=(0.01, 0.09)), "high"),            # 0.08: 1.6 times
    (dict(lcp=(1000.0, 1400.0)), "critical"),    # 40 %: 2 times
    (dict(lcp=(2490.0, 2510.0)), "low"),         # under 1 %, but from good to above it
    (dict(cls=(0.0, 0.051)), "low"),             # no base to divide by
])
def test_severity_of_one_change(pairs, load, change, severity):
    (name, (old, new)), = change.items()
    events = detect_regressions(pairs([load(4, "old", **{name: old}), load(11, "new", **{name: new})])).collect()
    assert [(e.metric, e.severity) for e in events] == [(name.upper(), severity)]
    assert (events[0].delta_percent is None) == (old == 0.0)


@pytest.mark.parametrize("change", [
    dict(lcp=(2000.0, 2400.0)), dict(inp=(150.0, 180.0)), dict(ttfb=(600.0, 750.0)),    # at the limit, not past it
    dict(cls=(0.05, 0.1)), dict(lcp=(2083.3, 2500.0)), dict(lcp=(2600.0, 2700.0)),      # poor before as well
])
def test_limits_are_strict(pairs, load, change):
    (name, (old, new)), = change.items()
    assert detect_regressions(pairs([load(4, "old", **{name: old}), load(11, "new", **{name: new})])).count() == 0


@pytest.mark.parametrize("change,status", [
    (dict(lcp=(2000.0, 1800.0)), "improved"), (dict(inp=(150.0, 135.0)), "improved"), (dict(cls=(0.06, 0.04)), "improved"),
    (dict(lcp=(2000.0, 1801.0)), "stable"), (dict(ttfb=(700.0, 200.0)), "stable"),
    (dict(lcp=(2000.0, 1500.0), ttfb=(500.0, 640.0)), "regressed"),
])
def test_status(pairs, load, change, status):
    old, new = ({k: v[i] for k, v in change.items()} for i in (0, 1))
    assert [r.improvement_status for r in before_after(pairs([load(1, "p", **old), load(2, "q", **new)])).collect()] == [status]


def test_thresholds_are_parameters(pairs, load):
    frame = pairs([load(1, "p", inp=100.0), load(2, "q", inp=112.0)])
    strict = RegressionThresholds(inp_regression_pct=0.1)
    assert detect_regressions(frame).count() == 0
    assert [e.metric for e in detect_regressions(frame, strict).collect()] == ["INP"]
    assert [r.improvement_status for r in before_after(frame, strict).collect()] == ["regressed"]


def test_stacked_metric_events_equal_the_single_pass(pairs, load):
    rows = [load(1, "p"), load(2, "q", lcp=4000.0, cls=0.5, inp=900.0, ttfb=2000.0), load(3, "r", cls=0.6)]
    frame = pairs(rows)
    stacked = union_events([metric_events(frame, rule) for rule in DEFAULT_THRESHOLDS.rules()])
    single = detect_regressions(frame)
    assert sorted(map(tuple, stacked.collect())) == sorted(map(tuple, single.collect())) and single.count() == 5
    assert sum(r["count"] for r in events_by_severity(single).collect()) == 5


def test_one_group_gives_one_answer_however_it_is_split(spark):
    """200,000 rows of one group: exact, and the same over 1, 7 and 64 partitions and over runs."""
    values = spark.range(200_000).selectExpr("'g' AS g", "CAST(id * 7919 % 199999 AS DOUBLE) / 3 AS v")
    measures = [agg.p75("p75_v", "v", 1), agg.count("n"), agg.rate("good", "v", 30_000.0)]
    exact = sorted(round(i * 7919 % 199999 / 3, 1) for i in range(200_000))[150_000 - 1]
    answers = {tuple(agg.rollup(values.repartition(n), ["g"], measures).first()) for n in (1, 7, 64) for _ in range(3)}
    assert len(answers) == 1 and next(iter(answers))[1:3] == (exact, 200_000)


def test_partials_merge_to_any_subset_of_the_keys(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("xyz"), rng.choice([None, 1.04, 1.05, 2.0, float("nan"), rng.random()]))
            for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, j string, v double")
    measures = [agg.p75("p75_v", "v", 1), agg.count("n"), agg.rate("good", "v", 1.0), agg.minimum("least", "j")]
    partials = agg.partial_rollup(df, ["k", "j"], measures)
    for keys in (["k"], ["j"], ["k", "j"]):
        merged = sorted(map(repr, agg.merge_rollup(partials, keys, measures, df).collect()))
        assert merged == sorted(map(repr, agg.rollup(df, keys, measures).collect()))


@pytest.mark.parametrize("selected", [100_000, 3, 0.5])
def test_selection_is_exact_for_any_number_of_groups(spark, monkeypatch, selected):
    """Large and small groups, NULL keys, wide ranges, negative and extreme values; few groups selected at once."""
    monkeypatch.setattr(agg, "SELECTED", selected)
    rng = random.Random(5)
    odd = [0.0, -0.0, 1e-9, 1e300, float("inf"), float("-inf"), None, float("nan"), 5e-324]
    rows = []
    for g in [None, *range(12)]:
        for n in range(3000 if g in (None, 3, 4) else rng.randrange(1, 40)):
            wide = rng.lognormvariate(7, 2) * rng.choice([1, 1, -1])
            rows.append((g, wide if g != 4 else 17.25, rng.choice(odd) if n % 7 == 0 else rng.random() * 1e6))
    df = spark.createDataFrame(rows, "g int, v double, w double").repartition(5)
    got = agg.rollup(df, ["g"], [agg.p75("p", "v", 1), agg.p75("q", "w", 3), agg.count("n"), agg.avg("a", "v", 2)])

    def exact(values, scale):
        values = sorted((x for x in values if x is not None), key=lambda x: (x != x, x))
        if not values:
            return None
        v = values[-(-3 * len(values) // 4) - 1]
        return v if v != v or abs(v) > 1e15 else float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)) + 0.0

    want = {}
    for g in [None, *range(12)]:
        mine = [r for r in rows if r[0] == g]
        want[g] = (exact([r[1] for r in mine], 1), exact([r[2] for r in mine], 3), len(mine))
    assert {r.g: repr((r.p, r.q, r.n)) for r in got.collect()} == {g: repr(w) for g, w in want.items()}


def test_quantile_ignores_null_and_keeps_nan(spark):
    df = spark.createDataFrame([("a", None), ("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", None), ("c", float("nan"))],
                               "k string, v double")
    got = {r.k: (r.p, r.n) for r in agg.rollup(df, ["k"], [agg.p75("p", "v", 0), agg.count("n")]).collect()}
    assert got["a"] == (3.0, 4) and got["b"] == (None, 1) and str(got["c"][0]) == "nan"


def test_two_releases_on_one_day_rank_apart(spark, page_logs, load):
    rows = [load(6, "p", route="/a", lcp=900.0), load(6, "q", route="/a", lcp=2900.0), load(6, "p", route="/b", lcp=1700.0)]
    lab = spark.createDataFrame([], "report_date date, route string, device_type string, performance_score double")
    ranked = route_rankings(daily_vitals(page_logs(rows)), lab).collect()
    assert sorted((r.route, r.p75_lcp_ms, r.rank_lcp) for r in ranked) == [
        ("/a", 900.0, 1), ("/a", 2900.0, 3), ("/b", 1700.0, 2)]
