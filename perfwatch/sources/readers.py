"""Readers for the raw inputs (S1-S4) and the parquet layers.

Every raw reader declares its schema, so no inference pass runs over the
input.  JSON arrays need ``multiLine`` (one file per task, which is fine for
the per-day report files); JSON Lines and CSV split by byte range.
"""
from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from perfwatch.sources.schemas import (
    DEVICE_SCHEMA,
    FIELD_METRICS_SCHEMA,
    LAB_REPORT_SCHEMA,
    PAGE_LOAD_SCHEMA,
)
from perfwatch.sources.sinks import Manifest, current, folders, read_published


def _declared(reader, schema: StructType, corrupt: str | None):
    """``reader`` with the declared schema and, if asked for, a column that
    holds what could not be parsed (the line, or a whole multi-line file);
    such a record has NULL in the fields that did not parse."""
    if corrupt is None:
        return reader.schema(schema)
    return reader.option("columnNameOfCorruptRecord", corrupt).schema(StructType([*schema.fields, StructField(corrupt, StringType())]))


def read_lab_reports(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Directory of JSON-array files; missing fields come back NULL."""
    return _declared(spark.read.option("multiLine", True), LAB_REPORT_SCHEMA, corrupt).json(path)


def read_field_metrics(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """CSV with header.  With a declared schema the columns bind by
    position; the header line is skipped, not used for mapping."""
    return _declared(spark.read.option("header", True).option("enforceSchema", True), FIELD_METRICS_SCHEMA, corrupt).csv(path)


def read_page_loads(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """S3: JSON Lines, one page-load event per line."""
    return _declared(spark.read, PAGE_LOAD_SCHEMA, corrupt).json(path)


def read_devices(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Device dimension as a JSON array."""
    return _declared(spark.read.option("multiLine", True), DEVICE_SCHEMA, corrupt).json(path)


class LayerMismatch(ValueError):
    """Files of a layer do not hold what its contract declares."""


def _departures(found: StructType, contract: StructType) -> list[str]:
    held = {f.name: f.dataType for f in found}
    return [f"column {f.name} is missing" if f.name not in held else
            f"column {f.name} is {held[f.name].simpleString()}, declared {f.dataType.simpleString()}"
            for f in contract if held.get(f.name) != f.dataType]


def check_layer(spark: SparkSession, path: str, contract: StructType, manifest: Manifest | None = None) -> None:
    """Raise ``LayerMismatch``, naming layer, column and one file, unless the
    footers of all files agree with ``contract`` (the columns a reader needs;
    others may be there).  A column may be missing from some files, which then
    read as NULL, but not from all.  Partition columns are cast from folder
    names when read and are not looked at.

    Spark merges the footers in one distributed job.  Only if they depart are
    the files halved until one is left that does: if both halves of a set
    agree with the contract, the set does.
    """
    by_partition = manifest is not None and "" not in manifest.parts

    def reader():
        return spark.read.option("basePath", path) if by_partition else spark.read

    def departing(files: list[str]) -> list[str]:
        try:
            found = reader().option("mergeSchema", True).parquet(*files).schema
        except (PySparkException, Py4JJavaError) as problem:
            if "CANNOT_MERGE" not in str(problem):
                raise
            return ["files disagree"]
        return _departures(found, wanted)

    whole = folders(path, manifest) if manifest is not None else [path]
    below = reader().schema(contract).parquet(*whole).inputFiles() if whole else []
    if not below:
        return
    wanted = StructType([f for f in contract if not any(f"/{f.name}=" in name for name in below)])
    problems = departing(whole)
    if not problems:
        return
    missing = [p for p in problems if p.endswith("missing")]
    if len(missing) < len(problems):        # a type departs: find one file it departs in
        def typed(files: list[str]) -> list[str]:
            return [p for p in departing(files) if not p.endswith("missing")]

        files = below
        while len(files) > 1:
            half = files[:len(files) // 2]
            files = half if typed(half) else files[len(files) // 2:]
        problems = [f"{p} (in {files[0]})" for p in typed(files)] + missing
    raise LayerMismatch(f"layer {path}: " + "; ".join(problems))


def read_layer(spark: SparkSession, path: str, contract: StructType | None = None) -> DataFrame:
    """A processed or curated parquet table, as it was last published
    (``sinks``), with the schema it was published with and the partition
    column last.  Any other folder is read as the Parquet files it holds.
    With a ``contract`` the files are held against it first (``check_layer``)."""
    manifest = current(spark, path)
    if contract is not None:
        check_layer(spark, path, contract, manifest)
    return spark.read.parquet(path) if manifest is None else read_published(spark, path, manifest)
