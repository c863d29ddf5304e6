"""Timestamp and date parsing that returns NULL on bad input (Spark 4 runs
with ANSI mode on, where ``to_timestamp`` would fail the whole job)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def as_timestamp(df: DataFrame, column: str) -> Column:
    """``column`` as TIMESTAMP: strings are parsed (ISO-8601, optional
    offset; unparsable -> NULL), timestamps pass through."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, TimestampType):
        return F.col(column)
    if isinstance(dtype, (TimestampNTZType, DateType)):
        return F.col(column).cast("timestamp")
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(F.col(column))
    raise TypeError(f"column {column!r} has type {dtype.simpleString()}, expected string or timestamp")


def as_date(df: DataFrame, column: str) -> Column:
    """``column`` as DATE: strings are parsed (unparsable -> NULL)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, DateType):
        return F.col(column)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.col(column).cast("date")
    if isinstance(dtype, StringType):
        return F.try_to_date(F.col(column))
    raise TypeError(f"column {column!r} has type {dtype.simpleString()}, expected string or date")
