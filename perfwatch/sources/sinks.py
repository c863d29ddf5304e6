"""Parquet and CSV sinks.

A Parquet table is written beside what is there and then published in one
step.  Its folder holds the data as ``generation=<id>/`` folders, each written
by one job and never changed again, and ``_manifests/<n>.json``.  The manifest
of the highest number tells which generation every partition is read from; it
is created exclusively, so of two writers one fails and must try again.  A job
that dies half way leaves a generation that no manifest names: the table is as
it was.  A reader keeps the files it planned with: generations go only when
none of the last ``KEPT`` manifests names them.

A manifest also carries the table's schema and, for incremental jobs, a ledger
of what the data was built from.  Row counts for logs come from an
``Observation`` on the same write instead of re-scanning the output.
"""
from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEPT = 3
PRESENT = "the partitions that the rows fall in"


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _path(spark: SparkSession, path: str):
    """The path in whatever store it names, and that store's file system."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files in ``path``, sorted; none if there is no such folder."""
    store, found = _path(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(found)) if store.exists(found) else []


@dataclass
class Manifest:
    """What a table consists of.  ``parts`` maps partition folders
    (``date=2031-04-02``; "" for a table written as a whole) to generations."""

    number: int
    schema: dict
    parts: dict[str, str]
    ledger: dict = field(default_factory=dict)


def manifests(spark: SparkSession, path: str, last: int = 1) -> list[Manifest]:
    """The ``last`` published manifests, newest first.  One that a writer died
    over before it was complete is none."""
    found = []
    for name in reversed(folder_names(spark, f"{path}/_manifests")):
        store, file = _path(spark, f"{path}/_manifests/{name}")
        stream = store.open(file)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found.append(Manifest(**json.loads(text)))
        except ValueError:
            continue
        if len(found) == last:
            break
    return found


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest the table is read by; None if it isn't a published table."""
    return next(iter(manifests(spark, path)), None)


def partitions(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folder -> generation of a published table."""
    manifest = current(spark, path)
    if manifest is None:
        return {}
    whole = manifest.parts.get("")
    if whole is None:
        return manifest.parts
    return {name: whole for name in folder_names(spark, f"{path}/generation={whole}") if "=" in name}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written to ``path``."""
    if current(spark, path) is not None:
        return True
    return any(not name.startswith(("_", ".", "generation=")) for name in folder_names(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table this library has written for its own use."""
    store, found = _path(spark, path)
    store.delete(found, True)


def folders(path: str, manifest: Manifest) -> list[str]:
    """The folders a published table is read from."""
    return [f"{path}/generation={generation}/{name}".rstrip("/") for name, generation in sorted(manifest.parts.items())]


def read_published(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    schema = StructType.fromJson(manifest.schema)
    if "" in manifest.parts:
        return spark.read.schema(schema).parquet(*folders(path, manifest))
    if not manifest.parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders(path, manifest)).select(*schema.names)


def _publish(spark: SparkSession, path: str, schema: StructType, parts: dict, ledger: dict, after: Manifest | None) -> None:
    """Create the next manifest, then drop generations only older ones name."""
    numbers = [int(name.partition(".")[0]) for name in folder_names(spark, f"{path}/_manifests")]
    if after is not None and current(spark, path).number != after.number:
        raise RuntimeError(f"{path} was published by another writer; run the job again")
    manifest = Manifest(max(numbers, default=0) + 1, json.loads(schema.json()), parts, ledger)
    store, file = _path(spark, f"{path}/_manifests/{manifest.number:010d}.json")
    stream = store.create(file, False)
    try:
        stream.write(bytearray(json.dumps(asdict(manifest)), "utf-8"))
    finally:
        stream.close()
    known = manifests(spark, path, KEPT + 2)
    kept = {g for m in known[:KEPT] for g in m.parts.values()}
    for old in known[KEPT:]:
        for generation in set(old.parts.values()) - kept:
            remove(spark, f"{path}/generation={generation}")
        remove(spark, f"{path}/_manifests/{old.number:010d}.json")


def write_partitioned(df: DataFrame, path: str, partition_col: str, rebalance: bool = False, replace: list[str] | str | None = None,
                      ledger: dict | None = None) -> int:
    """Publish a parquet table partitioned by ``partition_col``; returns
    the number of rows written.

    With ``replace`` (values of ``partition_col`` as written in folder names)
    only these partitions are exchanged, and those of them that ``df`` has no
    rows for vanish.  ``PRESENT`` exchanges those that ``df`` has rows for;
    without ``replace`` the whole table is.

    Without ``rebalance`` no shuffle is added: the file writer sorts each
    task's rows by the partition column and keeps one file open per task.
    That is the right choice for raw-sized ingest whose files already follow
    the date.  ``rebalance=True`` clusters rows by the partition column first
    (the ``rebalance`` hint: AQE splits a hot date over several tasks and
    merges small ones), for curated tables, and for raw input that is not laid
    out by date, which would else leave a small file per task and date.
    """
    spark, generation = df.sparkSession, uuid.uuid4().hex
    schema = StructType([f for f in df.schema if f.name != partition_col] + [df.schema[partition_col]])
    before = current(spark, path) if replace is not None else None
    given = {f"{partition_col}={value}" for value in replace} if isinstance(replace, list) else None
    parts = {name: g for name, g in partitions(spark, path).items() if name not in (given or ())} if before else {}
    observed, obs = _observed(df.hint("rebalance", partition_col) if rebalance else df, f"write:{path}")
    observed.write.partitionBy(partition_col).parquet(f"{path}/generation={generation}")
    if replace is None:
        parts = {"": generation}
    else:
        written = [name for name in folder_names(spark, f"{path}/generation={generation}") if "=" in name]
        if given is not None and not given.issuperset(written):
            raise ValueError(f"rows outside the partitions to replace: {sorted(set(written) - given)}")
        parts |= dict.fromkeys(written, generation)
    _publish(spark, path, schema, parts, ledger or {}, before)
    return int(obs.get["rows"])


def write_split(df: DataFrame, outputs: dict[str, tuple[str, list[str]]], partition_col: str, rebalance: bool = False,
                replace: str | None = None) -> dict[str, int]:
    """One pass over ``df``, several tables: the rows whose ``outcome`` is a
    key of ``outputs`` go to the (path, columns) it maps to.  All are
    partitioned by ``partition_col`` and published one after the other, the
    first last.  With ``replace`` (``PRESENT``) a partition that any row falls
    in is exchanged in all of them (rows of no partition: where they are).
    Returns the rows of each."""
    spark, generation = df.sparkSession, uuid.uuid4().hex
    staged = f"{next(iter(outputs.values()))[0]}/_staged-{generation}"
    counts = Observation(f"split:{staged}")
    rows = df.where(F.col("outcome").isin(*outputs)).observe(
        counts, *[F.count_if(F.col("outcome") == name).alias(name) for name in outputs])
    if rebalance:
        rows = rows.hint("rebalance", "outcome", partition_col)
    rows.write.partitionBy("outcome", partition_col).parquet(staged)
    seen = {p for name in outputs for p in folder_names(spark, f"{staged}/outcome={name}") if not p.endswith("__HIVE_DEFAULT_PARTITION__")}
    for name, (path, columns) in reversed(outputs.items()):
        before = current(spark, path) if replace is not None else None
        store, target = _path(spark, f"{path}/generation={generation}")
        store.mkdirs(target.getParent())
        _, written = _path(spark, f"{staged}/outcome={name}")
        if not (store.rename(written, target) if store.exists(written) else store.mkdirs(target)):
            raise OSError(f"{written} could not be moved to {target}")
        schema = StructType([df.schema[c] for c in columns if c != partition_col] + [df.schema[partition_col]])
        parts = {"": generation}
        if replace is not None:
            parts = {p: g for p, g in partitions(spark, path).items() if p not in seen} if before else {}
            parts |= {p: generation for p in folder_names(spark, f"{path}/generation={generation}") if "=" in p}
        _publish(spark, path, schema, parts, {}, before)
    remove(spark, staged)
    found = counts.get
    return {name: int(found[name]) for name in outputs}


def write_table(df: DataFrame, path: str, ledger: dict | None = None) -> int:
    """Publish an unpartitioned parquet table; returns rows written."""
    generation = uuid.uuid4().hex
    observed, obs = _observed(df, f"write:{path}")
    observed.write.parquet(f"{path}/generation={generation}")
    _publish(df.sparkSession, path, df.schema, {"": generation}, ledger or {}, None)
    return int(obs.get["rows"])


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Header CSV export into directory ``path``.

    A sorted frame is written by its range partitions, so the part files
    read in name order give the rows in sort order.  ``single_file=True``
    funnels the write through one task to get one part file; use it only
    for frames with a known small size (report sections, top-k lists).
    """
    observed, obs = _observed(df, f"csv:{path}")
    if single_file:
        observed = observed.coalesce(1)
    observed.write.mode("overwrite").option("header", True).csv(path)
    return int(obs.get["rows"])
