"""Quality gate (Q1-Q10).

The gate is a single filter.  Its counts (rows in, rows out, rows failing
each rule) are computed in the same pass as whatever action consumes the
gated frame, via ``DataFrame.observe`` - no extra ``count()`` jobs over
the input.  ``quality_metrics`` returns the same counts as a lazy one-row
frame.
"""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from perfwatch.config import VALID_DEVICE_TYPES, QualitySpec


def missing_columns(df: DataFrame, required) -> list[str]:
    """Q1: names in ``required`` that ``df`` lacks, in ``required`` order
    (schema lookup only, no job)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def non_negative_condition(columns) -> Column | None:
    """Every listed column is NULL or >= 0 (NaN passes, as NaN >= 0 in Spark).
    Written so each column is referenced once."""
    clauses = [F.coalesce(F.col(c) >= 0, F.lit(True)) for c in columns]
    return reduce(and_, clauses) if clauses else None


def count_negative(df: DataFrame, column: str) -> int:
    """Q2: rows where ``column`` is non-NULL and < 0 (runs a job)."""
    return int(df.agg(F.count_if(F.col(column) < 0).alias("n")).first()["n"])


def drop_negative(df: DataFrame, columns) -> DataFrame:
    """Q3: keep rows whose listed columns are all NULL or >= 0."""
    cond = non_negative_condition(columns)
    return df.where(cond) if cond is not None else df


def has_route(column: str = "route") -> Column:
    return F.col(column).isNotNull()


def has_device_type(column: str = "device_type", valid=VALID_DEVICE_TYPES) -> Column:
    return F.col(column).isin(*valid)


def has_samples(column: str = "sample_count") -> Column:
    return F.col(column) > 0


def require_route(df: DataFrame, column: str = "route") -> DataFrame:
    """Q4: drop rows with a NULL route."""
    return df.where(has_route(column))


def require_device_type(df: DataFrame, column: str = "device_type", valid=VALID_DEVICE_TYPES) -> DataFrame:
    """Q5: keep mobile / desktop / tablet."""
    return df.where(has_device_type(column, valid))


def require_positive_samples(df: DataFrame, column: str = "sample_count") -> DataFrame:
    """Q6: keep sample_count > 0 (NULL dropped)."""
    return df.where(has_samples(column))


def _rules(df: DataFrame, non_negative, check_route, check_device_type, check_sample_count):
    """(name, keep-condition) per active rule, in gate order.  A rule is
    skipped when its column is absent; a keep-condition that is NULL drops
    the row, as ``where`` does."""
    rules = []
    cond = non_negative_condition(non_negative or ())
    if cond is not None:
        rules.append(("negative", cond))
    if check_route and "route" in df.columns:
        rules.append(("null_route", has_route()))
    if check_device_type and "device_type" in df.columns:
        rules.append(("bad_device_type", has_device_type()))
    if check_sample_count and "sample_count" in df.columns:
        rules.append(("bad_sample_count", has_samples()))
    return rules


def _count_exprs(rules) -> list[Column]:
    """rows_in, one ``failed_<rule>`` per rule (rows the rule alone would
    drop) and rows_out."""
    exprs = [F.count(F.lit(1)).alias("rows_in")]
    for name, keep in rules:
        exprs.append(F.count_if(~F.coalesce(keep, F.lit(False))).alias(f"failed_{name}"))
    keep_all = reduce(and_, [k for _, k in rules]) if rules else F.lit(True)
    exprs.append(F.count_if(F.coalesce(keep_all, F.lit(False))).alias("rows_out"))
    return exprs


def quality_gate(
    df: DataFrame,
    table: str,
    required,
    non_negative=None,
    check_route: bool = True,
    check_device_type: bool = True,
    check_sample_count: bool = False,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Q7: raise ``ValueError`` when required columns are missing, then apply
    Q3 -> Q4 -> Q5 -> Q6 as one filter.  Pass an ``Observation`` (batch) or
    a metric name (batch or streaming; the counts then appear in the query
    progress) to receive rows_in / failed_* / rows_out."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"[{table}] missing required columns: {missing}")
    rules = _rules(df, non_negative, check_route, check_device_type, check_sample_count)
    if observation is not None:
        df = df.observe(observation, *_count_exprs(rules))
    if not rules:
        return df
    return df.where(reduce(and_, [k for _, k in rules]))


def apply_quality(df: DataFrame, spec: QualitySpec, observation: Observation | str | None = None) -> DataFrame:
    """Q7 with the per-table settings of Q8."""
    return quality_gate(df, spec.table, spec.required, spec.non_negative, spec.check_route,
                        spec.check_device_type, spec.check_sample_count, observation)


CORRUPT = "_corrupt_record"
MALFORMED = "malformed"


def quality_verdict(df: DataFrame, spec: QualitySpec, observation: Observation | str | None = None) -> DataFrame:
    """Q7 without dropping: adds ``reasons``, the names of the rules a row
    fails (empty: it passes).  A record that could not be parsed (``CORRUPT``
    is not NULL) has the one reason ``malformed``.  The observed counts are
    those of ``quality_gate`` and, where there is such a column,
    ``failed_malformed``; each rule counts parsed rows only."""
    missing = missing_columns(df, spec.required)
    if missing:
        raise ValueError(f"[{spec.table}] missing required columns: {missing}")
    rules = _rules(df, spec.non_negative, spec.check_route, spec.check_device_type, spec.check_sample_count)
    fails = {}
    parsed = F.lit(True)
    if CORRUPT in df.columns:
        parsed = F.col(CORRUPT).isNull()
        fails[MALFORMED] = ~parsed
    fails |= {name: parsed & ~F.coalesce(keep, F.lit(False)) for name, keep in rules}
    judged = df.withColumn("reasons", F.array_compact(F.array(*[F.when(f, F.lit(name)) for name, f in fails.items()])).cast("array<string>"))
    if observation is not None:
        judged = judged.observe(
            observation, F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(F.array_contains("reasons", name)).alias(f"failed_{name}") for name in fails],
            F.count_if(F.size("reasons") == 0).alias("rows_out"))
    return judged


def quality_metrics(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Q2 + Q7 counts as a one-row frame: rows_in, failed_<rule> per rule,
    rows_out, plus negatives_<column> per non-negative column.  One
    aggregation pass (partial counts per task, a single tiny shuffle)."""
    missing = missing_columns(df, spec.required)
    if missing:
        raise ValueError(f"[{spec.table}] missing required columns: {missing}")
    rules = _rules(df, spec.non_negative, spec.check_route, spec.check_device_type,
                   spec.check_sample_count)
    negatives = [F.count_if(F.col(c) < 0).alias(f"negatives_{c}") for c in spec.non_negative]
    return df.agg(*_count_exprs(rules), *negatives)


def latest_date_slice(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Q10: rows of the most recent date.  The max is a scalar subquery,
    evaluated once on the executors; nothing is collected to the driver,
    and on a date-partitioned table it prunes partitions at run time."""
    latest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == latest)
