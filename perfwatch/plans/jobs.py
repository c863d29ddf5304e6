"""Pipeline jobs (P1-P6): raw files -> processed parquet -> curated parquet ->
report exports.

Each job can run alone: it reads its inputs from the layer directories of a
``Layout`` (or takes already-built raw frames) and publishes its outputs in
one step (``sources.sinks``): a job that dies half way leaves the tables as
they were, and readers keep what they began to read.  P4 is incremental: every
curated table carries a ledger of the partitions it was built from, and only
days whose ledger differs are built again.  Written tables are the lineage cut
between jobs, so a lost executor only ever recomputes from the last written
layer.  Row counts are taken with ``Observation`` during the writes.
"""
from __future__ import annotations

import logging
import uuid
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perfwatch.config import (
    DEFAULT_THRESHOLDS,
    DEVICE_QUALITY,
    FIELD_QUALITY,
    LAB_QUALITY,
    PAGE_LOAD_QUALITY,
    RegressionThresholds,
)
from perfwatch.lineage import cut
from perfwatch.operators import enrich, normalize, quality, rankings, regressions, releases, reports, rollups
from perfwatch.sources import readers, sinks
from perfwatch.sources.schemas import PROCESSED_CONTRACTS

log = logging.getLogger("perfwatch")

LARGE_CATALOGUE = 100_000   # devices; fewer fit the planner's broadcast limit

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def require_utc(spark: SparkSession) -> None:
    """Days are cut from timestamps in the session's time zone; any other
    than UTC would move rows between days."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; the jobs need 'UTC'")


@dataclass(frozen=True)
class Layout:
    """Directory layout of one deployment (all on shared storage)."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def processed(self, name: str) -> str:
        return f"{self.root}/processed/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def concurrently(spark: SparkSession, **actions) -> dict:
    """Run independent actions (each ends in its own Spark jobs) from separate
    threads, so Spark schedules their stages side by side and one job's last
    wave does not leave the cluster idle.  Returns {name: result}.  When one
    fails, the jobs of the others are cancelled and its error is raised."""
    group = f"perfwatch-{uuid.uuid4().hex}"

    def in_group(name, action):
        spark.sparkContext.setJobGroup(group, name, True)   # of this thread only
        return action()

    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = {name: pool.submit(in_group, name, action) for name, action in actions.items()}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = [f for f in done if f.exception()]
        if failed:
            while wait(futures.values(), timeout=0.2).not_done:   # they may be about to start their jobs
                spark.sparkContext.cancelJobGroup(group)
            raise failed[0].exception()
        return {name: f.result() for name, f in futures.items()}


def _gate_log(table: str, obs: Observation) -> dict:
    counts = dict(obs.get)
    dropped = counts.get("rows_in", 0) - counts.get("rows_out", 0)
    if dropped:
        log.warning("[%s] quality gate dropped %d/%d rows (%s)", table, dropped, counts.get("rows_in", 0),
                    {k: v for k, v in counts.items() if k.startswith("failed_")})
    else:
        log.info("[%s] quality gate passed all %d rows", table, counts.get("rows_in", 0))
    return counts


def _with_record(raw: DataFrame) -> DataFrame:
    """``raw`` with its fields as they came, for the quarantine."""
    return raw.withColumn("_record", F.struct(*[c for c in raw.columns if c != quality.CORRUPT]))


def _split_and_write(judged: DataFrame, layout: Layout, name: str, partition_col: str, rebalance: bool,
                     replace: str | None = None) -> dict[str, int]:
    """Rows without a reason -> processed/<name>; the others -> quarantine/<name>
    as (record, reasons), the record being the text that could not be parsed
    or the fields as JSON.  Both in one pass."""
    columns = [c for c in judged.columns if c not in ("_record", "reasons", quality.CORRUPT)]
    passed = F.size("reasons") == 0
    record = F.to_json("_record")
    if quality.CORRUPT in judged.columns:
        record = F.coalesce(quality.CORRUPT, record)
    split = judged.select(*columns, F.when(passed, F.lit("clean")).otherwise(F.lit("broken")).alias("outcome"),
                          F.when(~passed, record).alias("record"), F.when(~passed, F.col("reasons")).alias("reasons"))
    rows = sinks.write_split(split, {"clean": (layout.processed(name), columns),
                                     "broken": (layout.quarantine(name), ["record", "reasons"])}, partition_col, rebalance, replace)
    return {"rows": rows["clean"], "quarantined": rows["broken"]}


def ingest_lab(spark: SparkSession, layout: Layout, raw: DataFrame | None = None, rebalance: bool = False) -> dict:
    """Lab reports -> normalised, production-only, gated ->
    processed/lab_reports partitioned by report_date; what fails the gate or
    could not be parsed -> quarantine/lab_reports.  ``rebalance``, here and
    in the other ingests: for raw files that are not laid out by date."""
    require_utc(spark)
    raw = raw if raw is not None else readers.read_lab_reports(spark, layout.raw("lab_reports"), quality.CORRUPT)
    obs = Observation("gate:lab_reports")
    judged = quality.quality_verdict(normalize.normalize_lab(_with_record(raw)), LAB_QUALITY, obs)
    return _split_and_write(judged, layout, "lab_reports", "report_date", rebalance) | {"gate": _gate_log("lab_reports", obs)}


def ingest_field_metrics(spark: SparkSession, layout: Layout, raw: DataFrame | None = None,
                         rebalance: bool = False) -> dict:
    """Field metrics -> normalised, gated (incl. sample_count > 0) ->
    processed/field_metrics partitioned by date, and quarantine/field_metrics.
    Nothing downstream reads it; it is kept as a processed table for ad-hoc use."""
    require_utc(spark)
    raw = raw if raw is not None else readers.read_field_metrics(spark, layout.raw("field_metrics"), quality.CORRUPT)
    obs = Observation("gate:field_metrics")
    judged = quality.quality_verdict(normalize.normalize_field_metrics(_with_record(raw)), FIELD_QUALITY, obs)
    return _split_and_write(judged, layout, "field_metrics", "date", rebalance) | {"gate": _gate_log("field_metrics", obs)}


def ingest_page_loads(spark: SparkSession, layout: Layout, raw: DataFrame | None = None,
                      raw_devices: DataFrame | None = None, rebalance: bool = False, replace_dates: bool = False) -> dict:
    """Devices -> deduped, gated -> processed/devices; page loads ->
    normalised, gated, enriched with devices -> processed/page_loads
    partitioned by event_date, and quarantine/page_loads.  Every gate rule
    looks at page-load columns only, so rows that fail don't look for a device:
    they join by NULL.  The join reads the written device table; of more than
    ``LARGE_CATALOGUE`` devices, which are not sent to every task, the hot ones
    are found by a pass over the ids and cut into parts.  With
    ``replace_dates`` only the days that the raw input holds are exchanged (in
    the quarantine, too; its records without a day are those of the last
    ingest), all others stay as they are."""
    require_utc(spark)
    raw_devices = raw_devices if raw_devices is not None else readers.read_devices(spark, layout.raw("devices"), quality.CORRUPT)
    if quality.CORRUPT in raw_devices.columns:   # a dimension of a few files: read once more for its broken records
        broken = raw_devices.where(F.col(quality.CORRUPT).isNotNull()).select(
            F.col(quality.CORRUPT).alias("record"), F.array(F.lit(quality.MALFORMED)).alias("reasons"), F.col("device_id"))
        lost = sinks.write_table(broken, layout.quarantine("devices"))
        if lost:
            log.warning("[devices] %d records could not be parsed", lost)
        raw_devices = raw_devices.where(F.col(quality.CORRUPT).isNull()).drop(quality.CORRUPT)
    dev_obs = Observation("gate:devices")
    devices = quality.apply_quality(normalize.normalize_devices(raw_devices), DEVICE_QUALITY, dev_obs)
    device_rows = sinks.write_table(devices, layout.processed("devices"))
    _gate_log("devices", dev_obs)

    raw = raw if raw is not None else readers.read_page_loads(spark, layout.raw("page_loads"), quality.CORRUPT)
    obs = Observation("gate:page_loads")
    judged = quality.quality_verdict(normalize.normalize_page_loads(_with_record(raw)), PAGE_LOAD_QUALITY, obs)
    judged = judged.withColumn("device_id", F.when(F.size("reasons") == 0, F.col("device_id")))
    hot = enrich.hot_devices(judged) if device_rows > LARGE_CATALOGUE else None
    enriched = enrich.enrich_with_devices(judged, _processed(spark, layout, "devices"), hot)
    rows = _split_and_write(enriched, layout, "page_loads", "event_date", rebalance, sinks.PRESENT if replace_dates else None)
    return {"devices": device_rows, **rows, "gate": _gate_log("page_loads", obs)}


def _processed(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A processed table, its files held against what the jobs need of it."""
    return readers.read_layer(spark, layout.processed(name), PROCESSED_CONTRACTS.get(name))


def processed_page_loads(spark: SparkSession, layout: Layout) -> DataFrame:
    """The page loads of the batch job and, where there is one, those of the
    streaming ingest, which keeps a table of its own."""
    batch = _processed(spark, layout, "page_loads")
    if not sinks.exists(spark, layout.processed("page_loads_stream")):
        return batch
    stream = readers.read_layer(spark, layout.processed("page_loads_stream"))
    return batch.unionByName(stream.select(*batch.columns))


UNDATED = "__HIVE_DEFAULT_PARTITION__"


def on_dates(df: DataFrame, column: str, dates) -> DataFrame:
    """Rows of the given days (as folder names write them); prunes partitions."""
    known = [date.fromisoformat(d) for d in dates if d != UNDATED]
    kept = F.col(column).isin(known) if known else F.lit(False)
    return df.where(kept | F.col(column).isNull() if UNDATED in dates else kept)


def page_load_ledger(spark: SparkSession, layout: Layout) -> dict[str, list[str]]:
    """Day -> what its page loads were written by: the generation of the batch
    table's partition and the batches of the stream that hold the day.  Only
    folder names are read.  Days of a table that was not published by this
    library count as changed every time."""
    batch, stream = layout.processed("page_loads"), layout.processed("page_loads_stream")
    parts = sinks.partitions(spark, batch) or {
        name: uuid.uuid4().hex for name in sinks.folder_names(spark, batch) if name.startswith("event_date=")}
    ledger = {name.partition("=")[2]: [generation] for name, generation in parts.items()}
    for query in sinks.folder_names(spark, stream):
        for number in sinks.folder_names(spark, f"{stream}/{query}") if query.startswith("query=") else ():
            for day in sinks.folder_names(spark, f"{stream}/{query}/{number}"):
                if day.startswith("event_date="):
                    ledger.setdefault(day.partition("=")[2], []).append(f"{query}/{number}")
    return ledger


def _changed(before: dict, now: dict) -> list[str]:
    return sorted(day for day in before.keys() | now.keys() if before.get(day) != now.get(day))


def _refresh(spark: SparkSession, path: str, column: str, now: dict, full: bool, build) -> int:
    """Publish the days of a table whose ledger differs from ``now``;
    ``build(days)`` gives their rows.  Returns the rows written."""
    held = None if full else sinks.current(spark, path)
    if held is None:
        return sinks.write_partitioned(build(sorted(now)), path, column, rebalance=True, ledger=now)
    days = _changed(held.ledger, now)
    return sinks.write_partitioned(build(days), path, column, rebalance=True, replace=days, ledger=now) if days else 0


def build_curated(spark: SparkSession, layout: Layout, thresholds: RegressionThresholds = DEFAULT_THRESHOLDS,
                  full: bool = False) -> dict:
    """Daily rollup, rankings, device breakdown, release aggregates and
    before/after comparisons.

    The page loads are scanned and aggregated once into the partials of the
    three rollups, a table by day that stays.  When it runs again, only days
    are built that were added, exchanged or removed since (of the rankings
    also those whose lab reports were), and of the release aggregates those
    releases that have, or had, page loads on such a day; their partials are
    merged over all days.  The result equals that of ``full``, which builds
    everything.  Each table's ledger is published with its rows, so a run that
    died half way is completed by the next.  Returns the rows written."""
    require_utc(spark)
    now = page_load_ledger(spark, layout)
    loads = processed_page_loads(spark, layout)
    lab = _processed(spark, layout, "lab_reports")
    lab_days = {name.partition("=")[2]: g for name, g in sinks.partitions(spark, layout.processed("lab_reports")).items()}
    path = layout.curated("page_load_partials")
    held = sinks.current(spark, path)
    earlier = None if held is None or full else sinks.read_published(spark, path, held)
    _refresh(spark, path, "event_date", now, full, lambda days: rollups.curated_partials(on_dates(loads, "event_date", days)))
    partials = readers.read_layer(spark, path)

    def daily_and_rankings():
        daily_path = layout.curated("core_web_vitals_daily")
        rows = _refresh(spark, daily_path, "date", now, full, lambda days: rollups.daily_from_partials(
            on_dates(partials, "event_date", days), on_dates(loads, "event_date", days)))
        daily = readers.read_layer(spark, daily_path)
        with_lab = {day: [*made_of, f"lab {lab_days.get(day)}"] for day, made_of in now.items()}
        ranked = _refresh(spark, layout.curated("route_performance_rankings"), "date", with_lab, full or not lab_days,
                          lambda days: rankings.route_rankings(on_dates(daily, "date", days), on_dates(lab, "report_date", days)))
        return rows, ranked

    def breakdown():
        return _refresh(spark, layout.curated("device_breakdowns"), "date", now, full, lambda days: rollups.breakdown_from_partials(
            on_dates(partials, "event_date", days), on_dates(loads, "event_date", days)))

    def changed_releases(aggregates: DataFrame) -> DataFrame:
        """``aggregates`` with the releases of the changed days computed anew."""
        days = _changed(held.ledger, now)
        keys = releases.RELEASE_KEYS
        touched = on_dates(earlier, "event_date", days).select(*keys).unionByName(
            on_dates(partials, "event_date", days).select(*keys)).distinct()
        touched = cut(touched.select(*[F.col(key).alias(f"_{key}") for key in keys]))
        same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
        theirs = partials.join(touched, same, "left_semi")
        seen = [str(r[0]) if r[0] else UNDATED for r in theirs.select("event_date").distinct().collect()]   # days
        anew = releases.release_aggregates_from_partials(
            theirs, on_dates(loads, "event_date", seen).join(touched, same, "left_semi"))
        return aggregates.join(touched, same, "left_anti").unionByName(anew)

    def releases_and_comparisons():
        release_path = layout.curated("release_aggregates")
        known = None if full else sinks.current(spark, release_path)
        rows = 0
        if known is None or known.ledger != now:
            if known is not None and earlier is not None and known.ledger == held.ledger:
                aggregates = changed_releases(sinks.read_published(spark, release_path, known))
            else:
                aggregates = releases.release_aggregates_from_partials(partials, loads)
            rows = sinks.write_table(aggregates, release_path, ledger=now)
        aggregates = readers.read_layer(spark, release_path)
        compared = sinks.write_table(releases.before_after(releases.release_pairs(aggregates), thresholds),
                                     layout.curated("before_after_comparisons"))
        return rows, compared

    done = concurrently(spark, daily=daily_and_rankings, breakdown=breakdown, releases=releases_and_comparisons)
    return {"daily": done["daily"][0], "rankings": done["daily"][1], "breakdown": done["breakdown"],
            "release_aggregates": done["releases"][0], "before_after": done["releases"][1]}


def build_regressions(spark: SparkSession, layout: Layout, reuse_aggregates: bool = False,
                      thresholds: RegressionThresholds = DEFAULT_THRESHOLDS) -> dict:
    """P5: regression events, from the processed page loads.  With
    ``reuse_aggregates`` the release aggregates that P4 has written are read
    instead, however old they are: for callers that have just run P4."""
    require_utc(spark)
    if reuse_aggregates:
        aggregates = readers.read_layer(spark, layout.curated("release_aggregates"))
    else:
        aggregates = releases.release_aggregates(processed_page_loads(spark, layout))
    events = regressions.detect_regressions(releases.release_pairs(aggregates), thresholds)
    rows = sinks.write_table(events, layout.curated("regression_events"))
    written = readers.read_layer(spark, layout.curated("regression_events"))
    by_severity = {r["severity"]: r["count"] for r in regressions.events_by_severity(written).collect()}
    if rows:
        log.warning("detected %d regression events %s", rows, by_severity)
    return {"rows": rows, "by_severity": by_severity}


def build_reports(spark: SparkSession, layout: Layout, generated_at=None) -> dict:
    """Sorted CSV exports of four curated tables and the summary text."""
    daily = readers.read_layer(spark, layout.curated("core_web_vitals_daily"))
    ranked = readers.read_layer(spark, layout.curated("route_performance_rankings"))
    comparisons = readers.read_layer(spark, layout.curated("before_after_comparisons"))
    events = readers.read_layer(spark, layout.curated("regression_events"))
    breakdown = readers.read_layer(spark, layout.curated("device_breakdowns"))
    done = concurrently(
        spark,
        route_rankings=lambda: sinks.export_csv(reports.export_rankings(ranked), layout.report("route_rankings")),
        regression_events=lambda: sinks.export_csv(reports.export_regressions(events),
                                                   layout.report("regression_events")),
        before_after=lambda: sinks.export_csv(reports.export_before_after(comparisons),
                                              layout.report("before_after_comparison")),
        device_breakdown=lambda: sinks.export_csv(reports.export_breakdown(breakdown),
                                                  layout.report("device_breakdown")),
        summary=lambda: reports.write_summary(reports.summary_lines(daily, comparisons, events, generated_at),
                                              layout.report("summary")),
    )
    done.pop("summary")
    return done


def run_all(spark: SparkSession, layout: Layout, lab: DataFrame | None = None,
            field: DataFrame | None = None, page_loads: DataFrame | None = None,
            devices: DataFrame | None = None, generated_at=None,
            thresholds: RegressionThresholds = DEFAULT_THRESHOLDS) -> dict:
    """The three ingests side by side, then P4, P5 (on the release
    aggregates P4 has just written) and P6."""
    require_utc(spark)
    ingested = concurrently(
        spark,
        lab=lambda: ingest_lab(spark, layout, lab),
        field=lambda: ingest_field_metrics(spark, layout, field),
        page_loads=lambda: ingest_page_loads(spark, layout, page_loads, devices),
    )
    curated = build_curated(spark, layout, thresholds)
    return {**ingested, "curated": curated, "regressions": build_regressions(spark, layout, True, thresholds),
            "reports": build_reports(spark, layout, generated_at)}
