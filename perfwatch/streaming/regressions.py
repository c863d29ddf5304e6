"""Regression events in event time (P5 as a stream).

Files that arrive in ``raw/page_loads_stream`` are normalised, passed through
the gate of the batch job and counted by day, route, device type, release,
metric and rounded value: the partials of the release aggregates (A4).  A
watermark on the day decides when a day is complete.  A day stays open, in
the state store, until a page load ``open_days`` days younger has been seen;
then its counts are appended once to ``curated/release_value_counts`` and leave
the state.  After every batch that closes a day, release pairs and regression
events (D8) of all closed days are published.

* The order in which files arrive changes nothing as long as no page load
  comes after its day was closed: the events are those of the batch job over
  the closed days.
* A page load that comes later than that is not counted here.  The query
  progress tells how many (``stateOperators[0].numRowsDroppedByWatermark``;
  rows that agree count once).  The batch job does count it, from the ingest's table.
* A page load without a day has no place in event time and is not counted
  here either; the batch job counts it.
* Rounded values bound the state: open days x groups x distinct values,
  whatever the number of page loads.

Every micro-batch replaces the folder ``query=<id>/batch=<n>``, so one that is
run again after a loss replaces itself; the published events are computed from
these folders each time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perfwatch.config import DEFAULT_THRESHOLDS, METRICS, PAGE_LOAD_QUALITY, RegressionThresholds
from perfwatch.operators.normalize import normalize_page_loads
from perfwatch.operators.quality import apply_quality
from perfwatch.operators.regressions import detect_regressions
from perfwatch.operators.releases import RELEASE_KEYS, release_aggregates_from_counts, release_pairs
from perfwatch.plans.jobs import Layout, require_utc
from perfwatch.sources.schemas import PAGE_LOAD_SCHEMA
from perfwatch.sources.sinks import write_table
from perfwatch.streaming.ingest import checkpoint_location

EVENTS = "regression_events_stream"
COUNTS = "release_value_counts"
DAY = "event_day"


def value_counts(page_loads: DataFrame, open_days: int) -> DataFrame:
    """Page loads by day, release keys, metric and rounded value: ``rows``.
    On a stream a day's counts come once, when it is closed."""
    values = [F.struct(F.lit(m.key).alias("metric"), (F.round(F.col(m.column).cast("double"), m.scale) + F.lit(0.0)).alias("value"))
              for m in METRICS]
    dated = page_loads.where(F.col("event_date").isNotNull()).withColumn(DAY, F.col("event_date").cast("timestamp"))
    return (
        dated.withWatermark(DAY, f"{open_days} days").select(DAY, *RELEASE_KEYS, F.inline(F.array(*values)))
        .groupBy(DAY, *RELEASE_KEYS, "metric", "value").agg(F.count(F.lit(1)).alias("rows"))
    )


def closed_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """The counts of all closed days, ``event_day`` as DATE."""
    return spark.read.parquet(f"{layout.curated(COUNTS)}/*/*").withColumn(DAY, F.col(DAY).cast("date"))


def start_regression_stream(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str | None = None,
    open_days: int = 2,
    thresholds: RegressionThresholds = DEFAULT_THRESHOLDS,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    source: str | None = None,
) -> StreamingQuery:
    """Start the stream ``source`` (raw/page_loads_stream) ->
    curated/release_value_counts and curated/regression_events_stream.
    ``available_now`` processes what is there and stops; otherwise pass
    ``processing_time`` for a continuous query."""
    require_utc(spark)
    if open_days < 1:
        raise ValueError("a day is open for a day at least")
    reader = spark.readStream.schema(PAGE_LOAD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(source or layout.raw("page_loads_stream"))
    counts = value_counts(apply_quality(normalize_page_loads(raw), PAGE_LOAD_QUALITY), open_days)

    def publish(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{layout.curated(COUNTS)}/query={query}/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        if not session.read.schema(batch.schema).parquet(folder).isEmpty():
            aggregates = release_aggregates_from_counts(closed_counts(session, layout), DAY)
            write_table(detect_regressions(release_pairs(aggregates), thresholds), layout.curated(EVENTS))

    writer = counts.writeStream.outputMode("append").foreachBatch(publish).option(
        "checkpointLocation", checkpoint or checkpoint_location(spark, "perfwatch-regression-stream"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
