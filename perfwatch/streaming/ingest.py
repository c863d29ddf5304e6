"""Incremental ingest of page loads (P3 as a stream).

Files that arrive in ``raw/page_loads_stream`` are picked up once, normalised,
passed through the gate of the batch job and enriched with the device table
as it is when the batch runs.  The result is a table of its own,
``processed/page_loads_stream``: the batch job overwrites its table as a whole
and must neither lose nor be hidden by the stream's rows.  P4 and P5 read
both.

Every micro-batch replaces the folder ``query=<id>/batch=<n>`` of that table.
The id belongs to the stream's checkpoint, so a batch that is run again after
a loss replaces itself, and a stream begun anew adds to what is there.  The
gate counts of each micro-batch are reported in the query progress
(``observedMetrics['page_load_gate']``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perfwatch.config import PAGE_LOAD_QUALITY
from perfwatch.operators.enrich import enrich_with_devices
from perfwatch.operators.normalize import normalize_page_loads
from perfwatch.operators.quality import apply_quality
from perfwatch.plans.jobs import Layout, require_utc
from perfwatch.lineage import checkpoint_root
from perfwatch.sources.readers import read_layer
from perfwatch.sources.schemas import PAGE_LOAD_SCHEMA

GATE_METRICS = "page_load_gate"


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """``<spark.checkpoint.dir>/<name>``; the cluster names the shared
    folder, this library never invents a machine-local one."""
    root = checkpoint_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir (a shared folder) or pass checkpoint=")
    return f"{root.rstrip('/')}/{name}"


def start_page_load_ingest(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    source: str | None = None,
) -> StreamingQuery:
    """Start the stream ``source`` (raw/page_loads_stream) ->
    processed/page_loads_stream, each batch partitioned by event_date.
    ``available_now`` processes what is there and stops (incremental batch
    runs); otherwise pass ``processing_time`` for a continuous query.  Files
    that the batch job reads as well would count twice: keep the folders apart."""
    require_utc(spark)
    reader = spark.readStream.schema(PAGE_LOAD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(source or layout.raw("page_loads_stream"))
    clean = apply_quality(normalize_page_loads(raw), PAGE_LOAD_QUALITY, GATE_METRICS)
    table, devices = layout.processed("page_loads_stream"), layout.processed("devices")

    def write_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        enriched = enrich_with_devices(batch, read_layer(session, devices))
        (enriched.withColumn("event_date", F.col("event_date").cast("date")).write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy("event_date")
            .parquet(f"{table}/query={query}/batch={number}"))

    writer = clean.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint or checkpoint_location(spark, "perfwatch-page-load-ingest"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
