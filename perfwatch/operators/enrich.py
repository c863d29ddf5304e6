"""Attach device metadata to page loads."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.lineage import cut


def device_projection(devices: DataFrame) -> DataFrame:
    """The three dimension columns the join needs."""
    return devices.select("device_id", "device_class", "network_profile")


SHARE = 1024      # a device with more than 1/SHARE of the page loads is hot


def hot_devices(page_loads: DataFrame, share: int = SHARE) -> DataFrame:
    """Devices with more than 1/``share`` of the page loads: ``device_id`` and
    ``copies``, the parts of at most 1/``share`` of all page loads they are to
    be cut into.  One pass counts them in a sketch of ``16 * share`` ids a task
    (bounded, whatever the number of devices); its counts are too high by a few
    thousandths of 1/``share`` at most.  Fewer than ``2 * share`` rows."""
    known = page_loads.where(F.col("device_id").isNotNull())
    counted = known.agg(F.count("*").alias("total"), F.expr(f"approx_top_k(device_id, {share}, {16 * share})").alias("top"))
    return cut(
        counted.select("total", F.inline("top")).where(F.col("count") * share > F.col("total"))
        .select(F.col("item").alias("device_id"), F.ceil(F.col("count") * share / F.col("total")).cast("long").alias("copies")))


def enrich_with_devices(page_loads: DataFrame, devices: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Left join on ``device_id``: adds ``device_class`` and
    ``network_profile``; unmatched or NULL ids keep the row with NULLs.

    ``devices`` must hold one row per ``device_id`` (``normalize_devices``),
    otherwise page loads would be multiplied.  Whether the dimension is sent to
    every task is the planner's decision, by its size in bytes
    (``spark.sql.autoBroadcastJoinThreshold``, measured again at run time).

    In a shuffled join page loads without an id, which would all meet in one
    task and match nothing, are spread by keys that no device has.  ``hot``
    (``hot_devices``) names the devices whose page loads are cut into parts by
    their content; only their dimension rows are repeated, one a part.  The
    result is the same with and without it, and without it AQE alone splits a
    hot device.  Page loads that are alike in ``event_id`` and ``lcp_ms`` (or,
    lacking these, all columns) stay together.
    """
    dim = device_projection(devices).where(F.col("device_id").isNotNull()).select(
        F.col("device_id").alias("_dim_id"), "device_class", "network_profile")
    loads, parts, dim_spread = page_loads, F.lit(1).cast("long"), F.lit(0).cast("long")
    if hot is not None:     # fewer than 2 * SHARE rows
        marked = F.broadcast(hot.select(F.col("device_id").alias("_hot_id"), F.col("copies").alias("_parts")))
        loads = loads.join(marked, F.col("device_id") == F.col("_hot_id"), "left").drop("_hot_id")
        dim = dim.join(marked, F.col("_dim_id") == F.col("_hot_id"), "left").drop("_hot_id")
        parts = F.coalesce("_parts", F.lit(1).cast("long"))
        dim_spread = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    dim = dim.select("_dim_id", dim_spread.alias("_dim_spread"), "device_class", "network_profile")
    telling = [c for c in ("event_id", "lcp_ms") if c in page_loads.columns] or page_loads.columns
    content = F.xxhash64(*telling)
    spread = F.when(F.col("device_id").isNull(), -1 - F.pmod(content, F.lit(1024))).otherwise(
        F.lit(0).cast("long") if hot is None else F.pmod(content, parts))
    return (
        loads.withColumn("_spread", spread)
        .join(dim, (F.coalesce(F.col("device_id"), F.lit("")) == F.col("_dim_id")) & (F.col("_spread") == F.col("_dim_spread")),
              "left")
        .drop("_spread", "_dim_id", "_dim_spread", "_parts")
    )
