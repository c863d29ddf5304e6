"""Regression events.

``detect_regressions`` turns every release pair into up to four candidate
events in one pass - ``inline`` over an array with one struct per metric
rule - and keeps the flagged ones.  The pairs are read once, not once per
metric.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.config import ADVICE, DEFAULT_THRESHOLDS, RegressionRule, RegressionThresholds
from perfwatch.functions.scoring import severity
from perfwatch.operators.releases import pair_columns, rule_flagged

EVENT_COLUMNS = (
    "detected_at", "route", "device_type", "metric", "baseline_value", "current_value",
    "delta", "delta_percent", "release_version", "severity", "probable_cause",
    "recommended_action",
)


def excess_ratio(rule: RegressionRule) -> Column:
    """How far past the rule the pair is: the larger of the worsening
    relative to its limit and the current value relative to ``poor``
    (``greatest`` skips a NULL side)."""
    n = pair_columns(rule.spec)
    vs_poor = F.try_divide(F.col(n["after"]), F.lit(float(rule.poor)))
    if rule.mode == "pct":
        vs_limit = F.try_divide(F.col(n["pct"]), F.lit(rule.limit * 100))
    else:
        vs_limit = F.try_divide(F.col(n["delta"]), F.lit(float(rule.limit)))
    return F.greatest(vs_limit, vs_poor)


def _event_struct(rule: RegressionRule) -> Column:
    n = pair_columns(rule.spec)
    if n["pct"]:
        delta_percent = F.col(n["pct"])
    else:
        delta_percent = F.round(F.try_divide(F.col(n["delta"]), F.col(n["before"])) * F.lit(100), 2)
    advice = ADVICE[rule.metric]
    return F.struct(
        F.lit(rule.metric).alias("metric"),
        F.col(n["before"]).alias("baseline_value"),
        F.col(n["after"]).alias("current_value"),
        F.col(n["delta"]).alias("delta"),
        delta_percent.alias("delta_percent"),
        severity(excess_ratio(rule)).alias("severity"),
        F.lit(advice.cause).alias("probable_cause"),
        F.lit(advice.action).alias("recommended_action"),
        rule_flagged(rule).alias("_flagged"),
    )


def _events(pairs: DataFrame, rules) -> DataFrame:
    exploded = pairs.select(
        F.col("after_release_start_date").alias("detected_at"),
        "route", "device_type",
        F.col("after_release").alias("release_version"),
        F.inline(F.array(*[_event_struct(r) for r in rules])),
    )
    return exploded.where(F.col("_flagged")).select(*EVENT_COLUMNS)


def metric_events(pairs: DataFrame, rule: RegressionRule) -> DataFrame:
    """Events of one metric - pairs where the rule flags, with baseline,
    current, delta, percent, the after-release, severity and advice."""
    return _events(pairs, [rule])


def detect_regressions(pairs: DataFrame, thresholds: RegressionThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Events of all four metrics, one pass over the pairs."""
    return _events(pairs, thresholds.rules())


def union_events(frames) -> DataFrame:
    """Stack event frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def events_by_severity(events: DataFrame) -> DataFrame:
    """Number of events per severity."""
    return events.groupBy("severity").agg(F.count(F.lit(1)).alias("count"))
