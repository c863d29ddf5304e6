"""Plan shape guards: the scale properties the design relies on."""
import re

from perfwatch import lineage
from perfwatch.operators import aggregate as agg
from perfwatch.operators import releases, reports, rollups
from perfwatch.plans.queries import DriverTables, queries

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_rollup_prunes_columns_and_drops_unused_join(spark):
    loads = DriverTables(spark, SF).page_loads()
    partials = agg.partial_rollup(loads, rollups.DAILY_KEYS, rollups.daily_measures())
    plan = partials._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan                         # device columns unused -> join removed
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all(len(cols.split(",")) == 4 for cols in scans)   # event_id, ts, user_id, value
    assert "percentile" not in plan and "kll" not in plan
    # combined by key and bin in every task before anything is shuffled
    first = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)[-1]
    assert "_number" in first and "_bin" in first and "_raw" not in first and plan.index("Exchange") < plan.rindex("partial_")


def test_rollup_shuffles_bins_not_rows(spark, monkeypatch):
    """40,000 different values in two groups: a round shuffles at most groups x bins rows from a task."""
    df = spark.range(0, 40_000, 1, 4).selectExpr("id % 2 AS g", "CAST(id * 7919 % 39989 AS DOUBLE) * 1.37 AS v")
    shuffled = []

    def counting(frame, condition):
        done, n = lineage.cut_counting(frame, condition)
        shuffled.append(n)
        return done, n

    monkeypatch.setattr(agg, "cut_counting", counting)
    measures = [agg.p75("p", "v", 2), agg.count("n")]
    bins = agg.partial_rollup(df, ["g"], measures).count()
    assert bins < 2 * 17 * agg.BINS        # values below 2**17 (hundredths: five octaves more)
    got = sorted(map(tuple, agg.rollup(df, ["g"], measures).collect()))
    exact = [sorted(round(i * 7919 % 39989 * 1.37, 2) for i in range(g, 40_000, 2))[15_000 - 1] for g in (0, 1)]
    assert got == [(0, exact[0], 20_000), (1, exact[1], 20_000)]
    assert shuffled[0] == 2 and shuffled[-1] == 0 and len(shuffled) <= 4     # open after the bins, closed in the end


def test_regression_events_single_pass(spark):
    plan = _plan(spark, "regression_events")
    assert "Generate inline" in plan and "Union" not in plan


def test_ranks_never_window_over_routes(spark):
    plan = _plan(spark, "route_rankings")
    ranks = [line for line in plan.splitlines() if "Window [dense_rank" in line]
    assert ranks and all("route" not in line.split("windowspecdefinition")[1] for line in ranks)
    assert all("_rank" in line for line in ranks)


def test_pairs_need_no_self_join(spark, page_logs, load):
    aggregates = releases.release_aggregates(page_logs([load(1, "p"), load(2, "q")])).checkpoint()
    plan = releases.release_pairs(aggregates)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ExistingRDD") == 1


def test_gate_comes_before_the_device_join(spark):
    plan = _plan(spark, "quality_clean")
    join = plan.index("Join")
    assert re.search(r"Filter .*lcp_ms|Filter .*>= 0", plan[join:])


def test_nothing_stays_cached(spark):
    queries()["summary_lines"](spark, SF).collect()
    assert "InMemoryTableScan" not in _plan(spark, "daily_vitals")


def test_worst_route_is_found_before_the_rollup(spark):
    t = DriverTables(spark, SF)
    loads = reports.of_worst_route(t.latest_rankings(), t.page_loads())
    plan = loads._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=1" in plan and "BroadcastExchange" in plan and "LeftSemi" in plan
