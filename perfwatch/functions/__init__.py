"""Column -> Column building blocks (all built-in Spark functions)."""
from perfwatch.functions.routes import canonical_device_type, canonical_route, clean_route, url_path
from perfwatch.functions.scoring import (
    good_flag,
    health_score,
    metric_score,
    newly_crosses,
    risk_level,
    severity,
    severity_rank,
)
from perfwatch.functions.stats import mean_of_rounded, pct_change
from perfwatch.functions.times import as_date, as_timestamp

__all__ = [
    "as_date", "as_timestamp", "canonical_device_type", "canonical_route", "clean_route",
    "good_flag", "health_score", "metric_score", "mean_of_rounded", "newly_crosses", "pct_change",
    "risk_level", "severity", "severity_rank", "url_path",
]
