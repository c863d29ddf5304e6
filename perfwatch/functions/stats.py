"""Aggregate and numeric helpers shared by the rollups."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_change(delta: Column, base: Column) -> Column:
    """delta / base * 100 rounded to 2 places; NULL when base is 0."""
    return F.round(F.try_divide(delta, base) * F.lit(100), 2)


def mean_of_rounded(col: Column | str, data_scale: int, out_scale: int, factor: int = 1) -> Column:
    """Mean of values that carry at most ``data_scale`` decimals (already
    rounded), times ``factor``, rounded HALF_UP to ``out_scale`` places as
    DOUBLE.  NULLs are ignored, as in ``avg``.

    The sum is exact (DECIMAL) and the division keeps 10+ decimals, so the
    result does not depend on the order rows are summed in - a plain
    floating-point mean can land either side of a rounding tie depending on
    how the input is partitioned.  If any value has no place in
    DECIMAL(18, data_scale) - NaN, an infinity, beyond 1e13 - the mean is
    ``avg`` over all values instead: none is dropped.
    """
    c = F.col(col) if isinstance(col, str) else col
    exact = c.try_cast(f"decimal(18,{data_scale})")
    scaled = exact * F.lit(factor).cast("decimal(10,0)") if factor != 1 else exact
    mean = F.try_divide(F.sum(scaled), F.count(scaled).cast("decimal(20,0)"))
    plain = F.round(F.avg(c) * F.lit(factor), out_scale)
    return F.when(F.count(exact) < F.count(c), plain).otherwise(F.round(mean, out_scale).cast("double"))
