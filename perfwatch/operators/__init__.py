"""DataFrame -> DataFrame operators of the web-vitals pipeline."""
from perfwatch.operators.enrich import device_projection, enrich_with_devices, hot_devices
from perfwatch.operators.normalize import (
    normalize_devices,
    normalize_field_metrics,
    normalize_lab,
    normalize_page_loads,
    standardize_device_type,
    standardize_route,
)
from perfwatch.operators.quality import (
    apply_quality,
    count_negative,
    drop_negative,
    latest_date_slice,
    missing_columns,
    quality_gate,
    quality_metrics,
    require_device_type,
    require_positive_samples,
    require_route,
)
from perfwatch.operators.rankings import add_ranks, blend_lab_scores, lab_daily_score, route_rankings
from perfwatch.operators.regressions import (
    detect_regressions,
    events_by_severity,
    metric_events,
    union_events,
)
from perfwatch.operators.releases import before_after, release_aggregates, release_pairs
from perfwatch.operators.rollups import (
    add_health_score,
    add_risk_level,
    daily_vitals,
    device_breakdown,
    device_summary,
    health_by_device_latest,
    health_trend,
    health_trend_pivot,
    overall_health,
    route_summary,
)
from perfwatch.operators.reports import (
    active_regressions,
    best_routes,
    recommended_actions,
    summary_lines,
    top_improvements,
    top_regressions,
    worst_now,
    worst_route_breakdown,
    worst_routes,
)
