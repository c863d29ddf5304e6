"""Quality gate rules on rows of our own."""
import math
from datetime import date

import pytest
from pyspark.sql import Observation

from perfwatch.operators import quality


def test_missing_columns_keep_the_asked_order(spark):
    df = spark.range(1).selectExpr("id", "id AS z", "id AS a")
    assert quality.missing_columns(df, ("q", "a", "c", "z", "b")) == ["q", "c", "b"]


@pytest.mark.parametrize("values,negatives", [([], 0), ([None, None], 0), ([0.0, -0.0, 4.5], 0),
                                              ([-0.001, None, -7.0, 2.0, math.nan], 2)])
def test_negatives_are_counted(spark, values, negatives):
    df = spark.createDataFrame([(v,) for v in values], "ttfb_ms double")
    assert quality.count_negative(df, "ttfb_ms") == negatives


def test_only_negative_values_drop_a_row(spark):
    pairs = [(x, y) for x in (None, math.nan, 0.0, 8.0, -8.0) for y in (None, 5.0, -5.0)]
    df = spark.createDataFrame(pairs, "inp_ms double, fcp_ms double")
    assert quality.drop_negative(df, ("inp_ms", "fcp_ms")).count() == 4 * 2
    assert quality.drop_negative(df, ("inp_ms",)).count() == 4 * 3
    assert quality.drop_negative(df, ()).count() == len(pairs)


def test_single_rules(spark):
    df = spark.createDataFrame([(r, d, n) for r in ("/docs", None) for d in ("tablet", "tv", None) for n in (1, 0, None)],
                               "route string, device_type string, sample_count int")
    assert quality.require_route(df).count() == 9
    assert quality.require_device_type(df).count() == 6
    assert quality.require_device_type(df, valid=("tv", "tablet")).count() == 12
    assert quality.require_positive_samples(df).count() == 6


def test_gate_names_what_is_missing(spark):
    with pytest.raises(ValueError, match=r"\[vitals\].*'speed', 'weight'"):
        quality.quality_gate(spark.range(1), "vitals", ("id", "speed", "weight"))


def test_gate_counts_every_rule_alone_and_filters_by_all(spark):
    rows = [("/docs", "tablet", 3.0, 9)] * 4 + [(None, "tv", -3.0, 0)] * 2 + [("/docs", "desktop", None, None), ("/docs", "tv", 1.0, 1)]
    df = spark.createDataFrame(rows, "route string, device_type string, ttfb_ms double, sample_count int")
    seen = Observation("rules")
    kept = quality.quality_gate(df, "vitals", df.columns, ("ttfb_ms",), check_sample_count=True, observation=seen)
    assert kept.count() == 4
    assert seen.get == {"rows_in": 8, "failed_negative": 2, "failed_null_route": 2, "failed_bad_device_type": 3,
                        "failed_bad_sample_count": 3, "rows_out": 4}


def test_rules_without_their_column_do_not_apply(spark):
    assert quality.quality_gate(spark.range(3), "ids", ("id",), check_sample_count=True).count() == 3


def test_latest_day(spark):
    days = [date(2031, 5, 2), date(2031, 5, 30), None, date(2031, 5, 30), date(2030, 12, 31)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, i int")
    assert sorted(r.i for r in quality.latest_date_slice(df).collect()) == [1, 3]
