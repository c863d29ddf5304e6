"""Query catalogue over the driver tables.

Every query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables
(``events``, ``nation``, ``pages``, ``lineitem``) through the adapters in
``perfwatch.sources.adapters``; nothing is sampled or capped except the
top-k reports whose limit is the feature.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.config import (
    DEFAULT_THRESHOLDS,
    DEVICE_QUALITY,
    FIELD_QUALITY,
    LAB_QUALITY,
    PAGE_LOAD_QUALITY,
    MetricSpec,
)
from perfwatch.functions.routes import canonical_route, url_path
from perfwatch.operators import enrich, normalize, quality, rankings, regressions, releases, reports, rollups
from perfwatch.lineage import cut
from perfwatch.sources import adapters

QueryFn = Callable[[SparkSession, str], DataFrame]


class DriverTables:
    """Lazily built frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # raw layouts
    def page_loads_raw(self) -> DataFrame:
        return adapters.page_loads_from_events(self.table("events"))

    def lab_raw(self) -> DataFrame:
        return adapters.lab_reports_from_events(self.table("events"))

    def field_raw(self) -> DataFrame:
        return adapters.field_metrics_from_events(self.table("events"))

    # processed layer
    def devices(self) -> DataFrame:
        return quality.apply_quality(
            normalize.normalize_devices(adapters.devices_from_nation(self.table("nation"))), DEVICE_QUALITY)

    def page_loads(self) -> DataFrame:
        """P3 without the write: normalise, gate, enrich with devices."""
        normalized = normalize.normalize_page_loads(self.page_loads_raw())
        return enrich.enrich_with_devices(quality.apply_quality(normalized, PAGE_LOAD_QUALITY), self.devices())

    def lab(self) -> DataFrame:
        return quality.apply_quality(normalize.normalize_lab(self.lab_raw()), LAB_QUALITY)

    # curated layer
    def daily(self) -> DataFrame:
        return rollups.daily_vitals(self.page_loads())

    def latest_rankings(self) -> DataFrame:
        """Rankings of the latest day: ranks never reach across days, so only
        that day's page loads are rolled up."""
        loads = quality.latest_date_slice(self.page_loads(), "event_date")
        return rankings.route_rankings(rollups.daily_vitals(loads), self.lab())

    def curated_partials(self) -> DataFrame:
        return rollups.curated_partials(self.page_loads())

    def rankings(self) -> DataFrame:
        return rankings.route_rankings(self.daily(), self.lab())

    def breakdown(self) -> DataFrame:
        return rollups.device_breakdown(self.page_loads())

    def pairs(self) -> DataFrame:
        return releases.release_pairs(releases.release_aggregates(self.page_loads()))

    def before_after(self) -> DataFrame:
        return releases.before_after(self.pairs())

    def events(self) -> DataFrame:
        return regressions.detect_regressions(self.pairs())


PAGE_LOAD_OUTPUT = ("event_id", "event_date", "route", "device_type", "device_id", "connection_type",
                    "release_version", "lcp_ms", "cls", "inp_ms", "ttfb_ms", "device_class",
                    "network_profile")


def _q(build: Callable[[DriverTables], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: build(DriverTables(spark, sf_dir))


# lineitem measures for the scale rollup (same rollup operator, generic data)
ORDER_METRICS = (
    MetricSpec("price", "l_extendedprice", "price", 50000.0, 2),
    MetricSpec("qty", "l_quantity", "qty", 25.0, 1),
    MetricSpec("disc", "l_discount", "disc", 0.05, 4),
)


def order_vitals(t: DriverTables) -> DataFrame:
    """The rollup of A1/A4 applied to lineitem: per (return flag, line
    status, ship year) avg and p75 of price, quantity and discount, the row
    count and the share at or under each metric's limit."""
    li = t.table("lineitem")
    return rollups.metric_rollup(li, ["l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year")],
                                 ORDER_METRICS)


def route_normalization(t: DriverTables) -> DataFrame:
    raw = t.page_loads_raw().select("event_id", F.col("route").alias("raw_route"), "route")
    return normalize.standardize_route(raw)


def device_normalization(t: DriverTables) -> DataFrame:
    raw = t.page_loads_raw().select("event_id", F.col("device_type").alias("raw_device_type"),
                                    "device_type")
    return normalize.standardize_device_type(raw)


def page_url_routes(t: DriverTables) -> DataFrame:
    pages = adapters.routes_from_pages(t.table("pages"))
    return pages.select("page_id", "url", canonical_route(url_path("url")).alias("route"))


def quality_counts(t: DriverTables) -> DataFrame:
    normalized = normalize.normalize_page_loads(t.page_loads_raw())
    return quality.quality_metrics(normalized, PAGE_LOAD_QUALITY)


def field_metrics_clean(t: DriverTables) -> DataFrame:
    gated = quality.apply_quality(normalize.normalize_field_metrics(t.field_raw()), FIELD_QUALITY)
    return gated.select("date", "route", "device_type", "connection_type", "p75_lcp_ms", "p75_cls",
                        "p75_inp_ms", "sample_count")


def lab_clean(t: DriverTables) -> DataFrame:
    return t.lab().select("report_id", "report_date", "route", "device_type", "release_version",
                          "lcp_ms", "cls", "inp_ms", "ttfb_ms", "performance_score")


def summary_lines(t: DriverTables) -> DataFrame:
    """RP over the curated frames, each computed once."""
    daily, pairs = cut(t.daily()), cut(t.pairs())
    return reports.summary_lines(daily, releases.before_after(pairs), regressions.detect_regressions(pairs),
                                 generated_at=F.lit("(run time)"))


def worst_route_breakdown(t: DriverTables) -> DataFrame:
    """T11 with the route found first: page loads of other routes are never rolled up."""
    loads = reports.of_worst_route(t.latest_rankings(), t.page_loads())
    return reports.breakdown_head(rollups.device_breakdown(loads))


def metric_events(t: DriverTables) -> DataFrame:
    """U1 over D7: the events of each metric by itself, stacked."""
    pairs = cut(t.pairs())
    return regressions.union_events([regressions.metric_events(pairs, r) for r in DEFAULT_THRESHOLDS.rules()])


def device_dedupe(t: DriverTables) -> DataFrame:
    return normalize.normalize_devices(adapters.device_records_from_events(t.table("events")))


QUERIES: dict[str, Callable[[DriverTables], DataFrame]] = {
    "route_normalization": route_normalization,
    "device_normalization": device_normalization,
    "page_url_routes": page_url_routes,
    "quality_counts": quality_counts,
    "quality_clean": lambda t: t.page_loads().select(*PAGE_LOAD_OUTPUT),
    "field_metrics_clean": field_metrics_clean,
    "lab_clean": lab_clean,
    "device_dedupe": device_dedupe,
    "daily_vitals": lambda t: t.daily(),
    "device_breakdown": lambda t: t.breakdown(),
    "lab_daily_score": lambda t: rankings.lab_daily_score(t.lab()),
    "route_rankings": lambda t: t.rankings(),
    "release_aggregates": lambda t: releases.release_aggregates(t.page_loads()),
    "release_pairs": lambda t: t.pairs(),
    "before_after": lambda t: t.before_after(),
    "regression_events": lambda t: t.events(),
    "events_by_severity": lambda t: regressions.events_by_severity(t.events()),
    "overall_health": lambda t: rollups.overall_health(t.daily()),
    "health_by_device_latest": lambda t: rollups.health_by_device_latest(t.daily()),
    "health_trend": lambda t: rollups.health_trend(t.daily()),
    "health_trend_pivot": lambda t: rollups.health_trend_pivot(t.daily()),
    "route_summary": lambda t: rollups.route_summary(t.daily()),
    "best_routes": lambda t: reports.best_routes(t.daily()),
    "worst_routes": lambda t: reports.worst_routes(t.daily()),
    "device_summary": lambda t: rollups.device_summary(t.daily()),
    "top_improvements": lambda t: reports.top_improvements(t.before_after()),
    "top_regressions": lambda t: reports.top_regressions(t.events()),
    "recommended_actions": lambda t: reports.recommended_actions(t.events()),
    "worst_now": lambda t: reports.last_ranked(t.latest_rankings()),
    "active_regressions": lambda t: reports.active_regressions(t.events()),
    "worst_route_breakdown": worst_route_breakdown,
    "export_rankings": lambda t: reports.export_rankings(t.rankings()),
    "export_regressions": lambda t: reports.export_regressions(t.events()),
    "export_before_after": lambda t: reports.export_before_after(t.before_after()),
    "export_breakdown": lambda t: reports.export_breakdown(t.breakdown()),
    "summary_lines": summary_lines,
    "order_vitals": order_vitals,
    "metric_events": metric_events,
    "daily_from_partials": lambda t: rollups.daily_from_partials(t.curated_partials(), t.page_loads()),
    "breakdown_from_partials": lambda t: rollups.breakdown_from_partials(t.curated_partials(), t.page_loads()),
    "releases_from_partials": lambda t: releases.release_aggregates_from_partials(t.curated_partials(), t.page_loads()),
}


def queries() -> dict[str, QueryFn]:
    return {name: _q(build) for name, build in QUERIES.items()}
