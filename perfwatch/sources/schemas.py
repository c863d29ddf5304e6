"""Declared schemas of the four raw inputs (never inferred)."""
from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, D, I = StringType(), DoubleType(), IntegerType()

# Lab reports: one JSON array per file, one element per run.  Integer
# counters in the files widen to double.
LAB_REPORT_SCHEMA = _schema(
    ("report_id", S), ("run_timestamp", S), ("url", S), ("route", S), ("device_type", S),
    ("environment", S), ("git_commit", S), ("release_version", S),
    ("lcp_ms", D), ("cls", D), ("inp_ms", D), ("fcp_ms", D), ("ttfb_ms", D),
    ("speed_index_ms", D), ("total_blocking_time_ms", D),
    ("performance_score", D), ("accessibility_score", D), ("best_practices_score", D), ("seo_score", D),
    ("request_count", D), ("js_transfer_kb", D), ("css_transfer_kb", D), ("image_transfer_kb", D),
    ("total_transfer_kb", D),
)

# Field metrics: CSV with a header; columns bind by position.
FIELD_METRICS_SCHEMA = _schema(
    ("date", S), ("origin", S), ("route", S), ("device_type", S), ("connection_type", S),
    ("p75_lcp_ms", D), ("p75_cls", D), ("p75_inp_ms", D),
    ("good_lcp_rate", D), ("needs_improvement_lcp_rate", D), ("poor_lcp_rate", D),
    ("good_cls_rate", D), ("needs_improvement_cls_rate", D), ("poor_cls_rate", D),
    ("good_inp_rate", D), ("needs_improvement_inp_rate", D), ("poor_inp_rate", D),
    ("sample_count", I),
)

# Page loads: JSON Lines, one event per line.
PAGE_LOAD_SCHEMA = _schema(
    ("event_id", S), ("session_id", S), ("timestamp", S), ("route", S), ("device_type", S),
    ("device_id", S), ("browser", S), ("os", S), ("country", S), ("connection_type", S),
    ("lcp_ms", D), ("cls", D), ("inp_ms", D), ("ttfb_ms", D), ("fcp_ms", D),
    ("page_weight_kb", D), ("js_error_count", I), ("api_latency_ms", D),
    ("cache_status", S), ("release_version", S),
)

# Devices: one JSON array.
DEVICE_SCHEMA = _schema(
    ("device_id", S), ("device_class", S), ("device_name", S), ("viewport_width", I),
    ("viewport_height", I), ("cpu_tier", S), ("memory_gb", I), ("network_profile", S),
)

# What the curated jobs need of the processed layers; other columns may be there.
PROCESSED_CONTRACTS = {
    "page_loads": _schema(
        ("event_date", DateType()), ("route", S), ("device_type", S), ("release_version", S), ("connection_type", S),
        ("device_class", S), ("lcp_ms", D), ("cls", D), ("inp_ms", D), ("ttfb_ms", D)),
    "lab_reports": _schema(("report_date", DateType()), ("route", S), ("device_type", S), ("performance_score", D)),
    "devices": _schema(("device_id", S), ("device_class", S), ("network_profile", S)),
}
