"""Exact rollups whose partials can be merged, p75 included, by selection.

The quantile is a value of the data, which a histogram can corner.  The
partials are one row per (keys, metric, bin): a plain aggregation, combined in
every map task.  Bins are ``BINS`` steps an octave, so their number depends on
the range of a metric, not on the rows, and a hot group shuffles a few hundred
rows from each task.  Partials merge to any subset of their keys, in any
order, and carry what the other measures need (row counts, sums, counts of
good values, smallest dates).

A running count over a group's bins tells which bin holds the quantile, its
rank there, and the least and largest value of that bin.  Rounding is
monotone: where these two round to the same, that is the answer.  Elsewhere
the input is read once more, for the rows inside the open bins only: these are
counted in ``PARTS`` parts of the bin (its rounded values, where it has no
more of them), and so on until every group is answered.  Each round shuffles
at most groups x ``PARTS`` rows from a task, and divides the range by
``PARTS``; one does for milliseconds.  Only rows inside open bins are rounded.

The open bins are sent to the tasks: at most ``SELECTED`` groups.  Beyond that
number, only groups of more than one ``SELECTED``-th of all rows are (there
can't be more of those); the rest, which are small, count their values.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.functions.scoring import good_flag
from perfwatch.lineage import cut_counting


@dataclass(frozen=True)
class Measure:
    """One output column of a rollup.

    kind: ``avg`` (rounded mean), ``quantile`` (rounded q-quantile),
    ``count`` (rows), ``rate`` (share of non-NULL values <= ``good``,
    rounded), ``min``.
    """

    name: str
    kind: str
    column: str | None = None
    scale: int | None = None
    good: float | None = None
    q: float = 0.75


def avg(name, column, scale) -> Measure:
    return Measure(name, "avg", column, scale)


def p75(name, column, scale) -> Measure:
    return Measure(name, "quantile", column, scale)


def count(name) -> Measure:
    return Measure(name, "count")


def rate(name, column, good, scale=4) -> Measure:
    return Measure(name, "rate", column, scale, good)


def minimum(name, column) -> Measure:
    return Measure(name, "min", column)


def _value_columns(measures) -> dict[str, dict]:
    """Per measured column its quantile's rounding and rank, and its good limit."""
    found: dict[str, dict] = {}
    for m in measures:
        if m.kind in ("avg", "quantile", "rate"):
            spec = found.setdefault(m.column, {"scale": None, "good": None, "q": None})
            if m.kind == "quantile":
                if (spec["scale"], spec["q"]) not in ((None, None), (m.scale, m.q)):
                    raise ValueError(f"quantiles of {m.column!r} at different scales or ranks")
                spec["scale"], spec["q"] = m.scale, m.q
            if m.kind == "rate":
                if spec["good"] not in (None, m.good):
                    raise ValueError(f"rates of {m.column!r} with different limits")
                spec["good"] = m.good
    return found


BINS = 16
PARTS = 1024
SELECTED = 100_000


def _bin(value: Column, scale: int) -> Column:
    """A bin number that never falls as ``value`` rises (NaN highest)."""
    size = F.abs(value)
    step = F.floor(F.log2(size * F.lit(10.0 ** scale)) * BINS) + 2   # values under one rounding step share bin 1
    far = F.when(size < F.lit(float("inf")), F.greatest(step, F.lit(1))).otherwise(F.lit(1 << 20))
    return (F.when(F.isnan(value), F.lit(1 << 21)).when(value > 0, far).when(value < 0, -far)
            .when(value == 0, F.lit(0))).cast("int")


def _keys(keys) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in keys]


def _rounded(value: Column, spec: dict) -> Column:
    return F.round(value, spec["scale"]) + F.lit(0.0)   # -0.0 becomes 0.0


def partial_rollup(df: DataFrame, keys, measures) -> DataFrame:
    """Mergeable partials: one row per (keys, ``_metric``, ``_bin``) with
    ``_rows``, ``_measured``, ``_sum``, ``_good``, the least and largest value
    (``_lo``, ``_hi``) and one ``_min_<column>`` per ``min`` measure.  A column
    no quantile is asked of has one bin (NULL).  One scan of the input serves
    every rollup over a subset of ``keys``."""
    key_cols = _keys(keys)
    names = df.select(*key_cols).columns
    minima = sorted({m.column for m in measures if m.kind == "min"})
    entries, metrics = [], list(_value_columns(measures)) or [""]
    for column, spec in _value_columns(measures).items():
        c = F.col(column).cast("double")
        entries.append(F.struct(
            F.lit(metrics.index(column)).alias("_number"), c.alias("_raw"), F.lit(spec["scale"]).cast("int").alias("_scale"),
            (good_flag(c, spec["good"]).cast("long") if spec["good"] is not None else F.lit(None).cast("long")
             ).alias("_is_good")))
    if not entries:
        entries = [F.struct(F.lit(0).alias("_number"), F.lit(None).cast("double").alias("_raw"),
                            F.lit(None).cast("int").alias("_scale"), F.lit(None).cast("long").alias("_is_good"))]
    staged = df.select(*key_cols, *[F.col(c).alias(f"_min_{c}") for c in minima], F.inline(F.array(*entries)))
    scales = sorted({spec["scale"] for spec in _value_columns(measures).values() if spec["scale"] is not None})
    binned = F.lit(None).cast("int")
    for scale in scales:
        binned = F.when(F.col("_scale") == scale, _bin(F.col("_raw"), scale)).otherwise(binned)
    binned = staged.withColumn("_bin", binned).groupBy(*names, "_number", "_bin").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("_raw").alias("_measured"), F.sum("_raw").alias("_sum"),
        F.sum("_is_good").alias("_good"), F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"),
        *[F.min(f"_min_{c}").alias(f"_min_{c}") for c in minima])
    return binned.select(*names, F.get(F.array(*map(F.lit, metrics)), "_number").alias("_metric"),
                         *binned.columns[len(names) + 1:])


def _counted(parts: DataFrame, names, aim: Column) -> DataFrame:
    group = Window.partitionBy(*names, "_metric")
    return parts.withColumns({
        "_through": F.sum("_measured").over(group.orderBy(F.col("_part").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)),
        "_total": F.sum("_measured").over(group)}).withColumn("_aim", aim)


def _windows(quantiles) -> list[Column]:
    """Aggregates over ``_counted`` rows: per metric the window (lo, hi, rank)
    of the part that holds the quantile."""
    reached = (F.col("_measured") > 0) & (F.col("_through") >= F.col("_aim"))
    rank = F.col("_aim") - (F.col("_through") - F.col("_measured"))
    lo = F.when(rank == F.col("_measured"), F.col("_hi")).otherwise(F.col("_lo"))    # the last one is the largest
    hi = F.when(rank == 1, F.col("_lo")).otherwise(F.col("_hi"))                      # the first one the least
    window = F.struct(F.col("_part").cast("double").alias("part"), lo.alias("lo"), hi.alias("hi"), rank.alias("rank"))
    return [F.min(F.when(reached & (F.col("_metric") == m), window)).alias(f"_q_{m}") for m in quantiles]


def _is_open(metric: str, specs) -> Column:
    window = F.col(f"_q_{metric}")
    return F.coalesce(_rounded(window["lo"], specs[metric]) < _rounded(window["hi"], specs[metric]), F.lit(False))


def _same_keys(names, prefix: str) -> Column:
    return reduce(and_, [F.col(name).eqNullSafe(F.col(f"{prefix}{name}")) for name in names], F.lit(True))


def _refine(source: DataFrame, selected: DataFrame, names, specs, quantiles, light: bool) -> DataFrame:
    """One more round: per group of ``selected`` narrower windows for the open
    ones.  ``light``: also the values of all groups that are not in it."""
    windows = selected.select(*[F.col(n).alias(f"_k_{n}") for n in names], F.lit(True).alias("_selected"),
                              *[F.when(_is_open(m, specs), F.col(f"_q_{m}")).alias(f"_q_{m}") for m in quantiles])
    rows = source.join(F.broadcast(windows), _same_keys(names, "_k_"), "left" if light else "inner")
    inside, entries = [], []
    for m in quantiles:
        v, w = F.col(f"_v_{m}"), F.col(f"_q_{m}")
        meets = (v >= w["lo"]) & (v <= w["hi"])
        few = (w["hi"] - w["lo"]) * F.lit(10.0 ** specs[m]["scale"]) < PARTS
        part = F.when(few, _rounded(v, specs[m])).otherwise(F.floor((v - w["lo"]) / (w["hi"] - w["lo"]) * PARTS).cast("double"))
        if light:
            part = F.when(F.col("_selected"), part).otherwise(v)
            meets = F.when(F.col("_selected"), meets).otherwise(v.isNotNull())
        inside.append(F.coalesce(meets, F.lit(False)))
        entries.append(F.when(meets, F.struct(F.lit(m).alias("_metric"), v.alias("_value"), part.alias("_part"),
                                              w["rank"].alias("_rank"))))
    parts = (rows.where(reduce(or_, inside)).select(*names, F.explode(F.array(*entries)).alias("_e")).where("_e IS NOT NULL")
             .select(*names, "_e.*").groupBy(*names, "_metric", "_part").agg(
                 F.count(F.lit(1)).alias("_measured"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi"),
                 F.max("_rank").alias("_rank")))
    return _counted(parts, names, F.coalesce("_rank", _aim(specs))).groupBy(*names).agg(*_windows(quantiles))


def _aim(specs) -> Column:
    """The quantile's rank among the values of a group and metric."""
    q = F.lit(None).cast("double")
    for column, spec in specs.items():
        if spec["q"] is not None:
            q = F.when(F.col("_metric") == column, F.lit(spec["q"])).otherwise(q)
    return F.ceil(F.col("_total") * q)


def merge_rollup(partials: DataFrame, keys, measures, source: DataFrame | None = None) -> DataFrame:
    """Merge partials by ``keys`` (names or aliased Columns over the partials'
    key columns) and finish ``measures``: the key columns, then the measures
    in order.  ``source`` holds the rows the partials were made of (key columns
    and measured columns); it is read again where a quantile is still open.
    Runs the jobs of the selection; the result itself is lazy."""
    key_cols = _keys(keys)
    specs = _value_columns(measures)
    columns = list(specs)
    minima = sorted({m.column for m in measures if m.kind == "min"})
    quantiles = sorted({m.column for m in measures if m.kind == "quantile"})
    used = partials.where(F.col("_metric").isin(*columns)) if columns else partials
    merged = used.groupBy(*key_cols, "_metric", F.col("_bin").alias("_part")).agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_measured", "_sum", "_good")], F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
        *[F.min(f"_min_{c}").alias(f"_min_{c}") for c in minima])
    names = merged.columns[:len(key_cols)]
    whole = columns[0] if columns else ""

    def of(column: str, part: str) -> Column:
        return F.sum(F.when(F.col("_metric") == column, F.col(part)))

    def finished(m: Measure) -> Column:
        if m.kind == "avg":
            out = F.round(F.try_divide(of(m.column, "_sum"), of(m.column, "_measured")), m.scale)
        elif m.kind == "count":
            out = of(whole, "_rows")
        elif m.kind == "rate":
            out = F.round(F.try_divide(of(m.column, "_good").cast("double"), of(m.column, "_measured")), m.scale)
        elif m.kind == "min":
            out = F.min(f"_min_{m.column}")
        else:
            raise ValueError(f"unknown measure kind {m.kind!r}")
        return out.alias(m.name)

    plain = [finished(m) for m in measures if m.kind != "quantile"]
    if not quantiles:
        return merged.groupBy(*names).agg(*plain)
    if source is None:
        raise ValueError("quantiles need the rows the partials were made of")
    groups = _counted(merged, names, _aim(specs)).groupBy(*names).agg(
        *plain, of(whole, "_rows").alias("_group_rows"), *_windows(quantiles))
    source = source.select(*key_cols, *[F.col(c).cast("double").alias(f"_v_{c}") for c in quantiles])
    answered = _select(groups, source, names, specs, quantiles)
    values = [_rounded(F.col(f"_q_{m.column}")["lo"], specs[m.column]).alias(m.name) if m.kind == "quantile" else F.col(m.name)
              for m in measures]
    return answered.select(*names, *values)


def _select(groups: DataFrame, source: DataFrame, names, specs, quantiles) -> DataFrame:
    """``groups`` with every window closed."""
    any_open = reduce(or_, [_is_open(m, specs) for m in quantiles])
    groups, n_open = cut_counting(groups, any_open)
    selected, light = groups.where(any_open), n_open > SELECTED
    if light:
        everything = groups.agg(F.sum("_group_rows")).first()[0]
        selected = groups.where(F.col("_group_rows") * SELECTED > everything)
    while n_open:
        found, n_open = cut_counting(_refine(source, selected, names, specs, quantiles, light), any_open)
        later = found.select(*[F.col(n).alias(f"_k_{n}") for n in names], *[F.col(f"_q_{m}").alias(f"_l_{m}") for m in quantiles])
        groups = groups.join(later if light else F.broadcast(later), _same_keys(names, "_k_"), "left").withColumns(
            {f"_q_{m}": F.coalesce(f"_l_{m}", f"_q_{m}") for m in quantiles}).drop(*later.columns)   # a later window counts
        selected, light = found.where(any_open), False   # light groups are answered by now
    return groups


def rollup(df: DataFrame, keys, measures) -> DataFrame:
    """Group ``df`` by ``keys`` (names or aliased Columns) and compute ``measures``."""
    key_cols = _keys(keys)
    names = df.select(*key_cols).columns
    needed = {m.column for m in measures if m.column}
    source = df.select(*key_cols, *[c for c in df.columns if c in needed and c not in names])
    return merge_rollup(partial_rollup(source, names, measures), names, measures, source)
