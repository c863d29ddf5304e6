"""Adapters from the driver's generic tables to the raw layouts this library
ingests.  Each is one projection (no shuffle, no filter), written as SQL
expressions that both Spark and DuckDB accept, so the oracle sees exactly
the same input rows; a scan through an adapter keeps its column pruning and
scales with the table.

* ``page_loads_from_events``    -> page-load layout (S3)
* ``lab_reports_from_events``   -> lab-report layout (S1)
* ``field_metrics_from_events`` -> field-metric layout (S2)
* ``device_records_from_events``-> device layout with repeated ids (S4)
* ``devices_from_nation``       -> clean device dimension (S4)
* ``routes_from_pages``         -> raw routes taken from page URLs

The spellings are deliberately dirty (mixed case, query strings, aliases,
unknown device types, NULL routes, device ids and releases, negative values
in every gated column now and then, NULL INPs) so that normalisation and the
quality gate have work to do, and metric shifts are seeded per release so
that regressions exist, one of them over a CLS of 0.  Releases are named so
that their names do not sort in time order; two start on the same days on
one route.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values of the adapter -------------------------------------------
RAW_ROUTE = """CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING)
  WHEN event_id % 6 = 0 THEN '/Home?ref=nav' WHEN event_id % 6 = 1 THEN '/products/'
  WHEN event_id % 6 = 2 THEN ' /search#top ' WHEN event_id % 6 = 3 THEN 'basket'
  WHEN event_id % 6 = 4 THEN '/BLOG' ELSE '/login' END"""
RAW_DEVICE = """CASE WHEN user_id % 7 IN (0, 1) THEN 'Phone' WHEN user_id % 7 IN (2, 3) THEN ' PC '
  WHEN user_id % 7 = 4 THEN 'iPad' WHEN user_id % 7 = 5 THEN 'desktop' ELSE 'smartwatch' END"""
CONNECTION = "CASE WHEN user_id % 3 = 0 THEN 'wifi' WHEN user_id % 3 = 1 THEN '4G' ELSE '3G' END"
RELEASE = """CASE WHEN event_id % 211 = 0 THEN CAST(NULL AS STRING)
  WHEN event_id % 6 = 4 AND day(ts) > 20 THEN (CASE WHEN user_id % 2 = 0 THEN 'r-d' ELSE 'r-e' END)
  WHEN day(ts) <= 10 THEN 'r-b' WHEN day(ts) <= 20 THEN 'r-a' ELSE 'r-c' END"""
LCP = """CASE WHEN event_id % 101 = 0 THEN CAST(-1.0 AS DOUBLE)
  ELSE (1000 + value * CAST(15.0371 AS DOUBLE))
     * (CASE WHEN event_id % 6 = 3 AND day(ts) BETWEEN 11 AND 20 THEN CAST(1.5 AS DOUBLE)
             ELSE CAST(1.0 AS DOUBLE) END) END"""
CLS = """CAST(event_id % 89 AS DOUBLE) / CAST(1013.7 AS DOUBLE)
  * CAST(CASE WHEN event_id % 6 = 3 AND day(ts) BETWEEN 11 AND 20 THEN 3
              WHEN event_id % 6 = 4 AND day(ts) <= 10 THEN 0 ELSE 1 END AS DOUBLE)"""
INP = """CASE WHEN event_id % 103 = 0 THEN CAST(NULL AS DOUBLE)
  ELSE (80 + value * CAST(1.0137 AS DOUBLE))
     * (CASE WHEN event_id % 6 = 2 AND user_id % 7 IN (0, 1) AND day(ts) > 20
             THEN CAST(1.6 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END) END"""
TTFB = """(300 + value * CAST(4.0193 AS DOUBLE))
  * (CASE WHEN event_id % 6 = 5 AND day(ts) BETWEEN 11 AND 20 THEN CAST(1.8 AS DOUBLE)
          ELSE CAST(1.0 AS DOUBLE) END)"""
FCP = """CASE WHEN event_id % 107 = 0 THEN CAST(-5.0 AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST(NULL AS DOUBLE)
  ELSE 500 + value * CAST(7.3 AS DOUBLE) END"""
PAGE_WEIGHT = "CASE WHEN event_id % 109 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE 100 + value * CAST(2.5 AS DOUBLE) END"
JS_ERRORS = "CAST(CASE WHEN event_id % 113 = 0 THEN -1 ELSE event_id % 3 END AS INT)"
REQUESTS = "CASE WHEN event_id % 127 = 0 THEN CAST(-2.0 AS DOUBLE) ELSE CAST(20 + event_id % 60 AS DOUBLE) END"
DEVICE_ID = "CASE WHEN user_id % 41 = 0 THEN CAST(NULL AS STRING) ELSE CAST(user_id % 30 AS STRING) END"
LAB_ENVIRONMENT = "CASE WHEN event_type = 'error' THEN 'staging' ELSE 'production' END"
LAB_SCORE = "CAST(100.0 AS DOUBLE) - value * CAST(0.1973 AS DOUBLE)"
SHOP_ORIGIN = "'https://shop.example.com'"
DEVICE_CLASS_OF = "CASE {k} % 3 WHEN 0 THEN 'low-end' WHEN 1 THEN 'mid-range' ELSE 'high-end' END"
NETWORK_PROFILE = ("CASE n_regionkey WHEN 0 THEN '3G' WHEN 1 THEN '4G' WHEN 2 THEN '5G' "
                   "WHEN 3 THEN 'wifi' ELSE '4G' END")
# ---------------------------------------------------------------------------

NULL_S, NULL_D, NULL_I = "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS INT)"

# (expression, output name) in output order
PAGE_LOAD_EXPRS = (
    ("CAST(event_id AS STRING)", "event_id"),
    ("CAST(user_id AS STRING)", "session_id"),
    ("CAST(ts AS TIMESTAMP)", "timestamp"),
    (RAW_ROUTE, "route"),
    (RAW_DEVICE, "device_type"),
    (DEVICE_ID, "device_id"),
    (NULL_S, "browser"), (NULL_S, "os"), (NULL_S, "country"),
    (CONNECTION, "connection_type"),
    (LCP, "lcp_ms"), (CLS, "cls"), (INP, "inp_ms"), (TTFB, "ttfb_ms"),
    (FCP, "fcp_ms"), (PAGE_WEIGHT, "page_weight_kb"), (JS_ERRORS, "js_error_count"),
    (NULL_D, "api_latency_ms"), (NULL_S, "cache_status"),
    (RELEASE, "release_version"),
)

LAB_REPORT_EXPRS = (
    ("concat('lab-', CAST(event_id AS STRING))", "report_id"),
    ("CAST(ts AS TIMESTAMP)", "run_timestamp"),
    (f"concat({SHOP_ORIGIN}, {RAW_ROUTE})", "url"),
    (RAW_ROUTE, "route"),
    (RAW_DEVICE, "device_type"),
    (LAB_ENVIRONMENT, "environment"),
    (NULL_S, "git_commit"),
    (RELEASE, "release_version"),
    (LCP, "lcp_ms"), (CLS, "cls"), (INP, "inp_ms"), (FCP, "fcp_ms"), (TTFB, "ttfb_ms"),
    (NULL_D, "speed_index_ms"), (NULL_D, "total_blocking_time_ms"),
    (LAB_SCORE, "performance_score"),
    (NULL_D, "accessibility_score"), (NULL_D, "best_practices_score"), (NULL_D, "seo_score"),
    (REQUESTS, "request_count"), (NULL_D, "js_transfer_kb"), (NULL_D, "css_transfer_kb"),
    (NULL_D, "image_transfer_kb"), (NULL_D, "total_transfer_kb"),
)

FIELD_METRIC_EXPRS = (
    ("CAST(CAST(ts AS DATE) AS STRING)", "date"),
    (SHOP_ORIGIN, "origin"),
    (RAW_ROUTE, "route"),
    (RAW_DEVICE, "device_type"),
    (CONNECTION, "connection_type"),
    (LCP, "p75_lcp_ms"), (CLS, "p75_cls"), (INP, "p75_inp_ms"),
    *[(NULL_D, f"{lvl}_{k}_rate") for k in ("lcp", "cls", "inp")
      for lvl in ("good", "needs_improvement", "poor")],
    ("CAST(floor(value) AS INT) - 1", "sample_count"),
)

DEVICE_RECORD_EXPRS = (
    (DEVICE_ID, "device_id"),
    (DEVICE_CLASS_OF.format(k="user_id"), "device_class"),
    ("event_type", "device_name"),
    ("CAST(floor(value) AS INT)", "viewport_width"),
    ("CAST(event_id % 1000 AS INT)", "viewport_height"),
    ("CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'mid' ELSE 'high' END", "cpu_tier"),
    ("CAST(event_id % 16 AS INT)", "memory_gb"),
    ("CASE event_id % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN '4G' ELSE '3G' END", "network_profile"),
)

NATION_DEVICE_EXPRS = (
    ("CAST(n_nationkey AS STRING)", "device_id"),
    (DEVICE_CLASS_OF.format(k="n_nationkey"), "device_class"),
    ("n_name", "device_name"),
    (NULL_I, "viewport_width"), (NULL_I, "viewport_height"),
    (NULL_S, "cpu_tier"), (NULL_I, "memory_gb"),
    (NETWORK_PROFILE, "network_profile"),
)


def select_list(exprs) -> list[str]:
    """``expr AS name`` strings of an adapter (for selectExpr or SQL)."""
    return [f"{e} AS {n}" for e, n in exprs]


def _project(df: DataFrame, exprs) -> DataFrame:
    return df.selectExpr(*select_list(exprs))


def page_loads_from_events(events: DataFrame) -> DataFrame:
    """Page-load events in the raw S3 layout (``timestamp`` already typed)."""
    return _project(events, PAGE_LOAD_EXPRS)


def lab_reports_from_events(events: DataFrame) -> DataFrame:
    """Lab runs in the raw S1 layout: every event doubles as a lab run;
    ``error`` events are staging runs, the rest production;
    performance_score = 100 - value * 0.1973."""
    return _project(events, LAB_REPORT_EXPRS)


def field_metrics_from_events(events: DataFrame) -> DataFrame:
    """Field-metric rows in the raw S2 layout (date as text, as read from
    CSV); sample_count = floor(value) - 1, so some rows fail the gate."""
    return _project(events, FIELD_METRIC_EXPRS)


def device_records_from_events(events: DataFrame) -> DataFrame:
    """Device records in the raw S4 layout, each id repeated many times with
    differing attributes (input of the deterministic dedupe)."""
    return _project(events, DEVICE_RECORD_EXPRS)


def devices_from_nation(nation: DataFrame) -> DataFrame:
    """Device dimension: one device per nation key."""
    return _project(nation, NATION_DEVICE_EXPRS)


def routes_from_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url) of crawled pages: their URLs are raw routes."""
    return pages.select("page_id", "url")
