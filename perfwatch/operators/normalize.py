"""Normalisation of the raw inputs (N2-N7).  Pure projections and filters,
except ``normalize_devices`` which is one partial-aggregating group-by."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.functions.routes import canonical_device_type, canonical_route
from perfwatch.functions.times import as_date, as_timestamp
from perfwatch.operators.quality import CORRUPT


def standardize_route(df: DataFrame, column: str = "route") -> DataFrame:
    """Replace ``column`` with its cleaned, alias-resolved route."""
    return df.withColumn(column, canonical_route(column))


def standardize_device_type(df: DataFrame, column: str = "device_type") -> DataFrame:
    """Replace ``column`` with mobile / desktop / tablet / unknown."""
    return df.withColumn(column, canonical_device_type(column))


def normalize_lab(df: DataFrame) -> DataFrame:
    """Standard route and device type, ``run_timestamp`` as TIMESTAMP
    (unparsable -> NULL), ``report_date`` added, production runs only
    (exact, case-sensitive match; NULL environment is dropped).  Records that
    could not be parsed stay, for the gate to name them."""
    ts = as_timestamp(df, "run_timestamp")
    wanted = F.col("environment") == F.lit("production")
    if CORRUPT in df.columns:
        wanted |= F.col(CORRUPT).isNotNull()
    return (
        df.withColumns({
            "route": canonical_route("route"),
            "device_type": canonical_device_type("device_type"),
            "run_timestamp": ts,
        })
        .withColumn("report_date", F.col("run_timestamp").cast("date"))
        .where(wanted)
    )


def normalize_field_metrics(df: DataFrame) -> DataFrame:
    """Standard route and device type, ``date`` as DATE."""
    return df.withColumns({
        "route": canonical_route("route"),
        "device_type": canonical_device_type("device_type"),
        "date": as_date(df, "date"),
    })


def normalize_page_loads(df: DataFrame) -> DataFrame:
    """Standard route and device type, ``timestamp`` as TIMESTAMP,
    ``event_date`` added."""
    ts = as_timestamp(df, "timestamp")
    return (
        df.withColumns({
            "route": canonical_route("route"),
            "device_type": canonical_device_type("device_type"),
            "timestamp": ts,
        })
        .withColumn("event_date", F.col("timestamp").cast("date"))
    )


def normalize_devices(df: DataFrame, key: str = "device_id") -> DataFrame:
    """One row per ``key``.  The survivor is the smallest record by the
    remaining columns in schema order, so the result does not depend on
    partitioning.  ``min(struct)`` aggregates partially on the map side, so
    a key repeated in a third of the input is combined in parallel instead
    of being sorted inside one task."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_survivor"))
        .select(key, *[F.col(f"_survivor.{c}").alias(c) for c in rest])
    )
