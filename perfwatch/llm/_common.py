"""Helpers shared by the operators of this package."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent and no folder has been set on the
    context, a session on one machine (tests) gets a temporary folder; on a
    cluster, whose executors would not see it, that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later readers do not recompute ``df`` and a lost
    executor costs nothing, since the rows lie in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """Intermediate results as compressed Parquet tables in a folder of their
    own under the checkpoint folder, each removed when its last reader is done."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fanout(spark: SparkSession) -> int:
    """Number of groups to deal blocks out to: the session's shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def id_residue(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def sampled(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """At most ``limit`` rows of ``df`` (more only by ties), those with the
    smallest 64-bit hash of ``key``: the same rows on every run.  Only hashes
    are sorted; one number comes back to the driver."""
    hashed = F.xxhash64(key, F.lit(7))
    top = df.select(hashed.alias("h")).orderBy("h").limit(limit).agg(F.max("h")).first()[0]
    return df.filter(F.lit(False) if top is None else hashed <= F.lit(top))


def sampled_by(df: DataFrame, key: Column, by: Column, limit: int) -> DataFrame:
    """At most ``limit`` rows of each class ``by`` (more only if a class is one
    key throughout), those with the smallest hashes of ``key``: the same rows
    on every run.  Hashes are counted on a scale of quarter octaves, at most
    253 counts a class, so nothing is gathered or sorted by row."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 1).cast("double") + 1) / F.lit(2.0**63)
    level = F.floor(-4 * F.log2(unit)).cast("int")
    seen = Window.partitionBy("_by").orderBy(F.desc("_level"))
    least = (
        df.select(by.alias("_by"), level.alias("_level")).groupBy("_by", "_level").agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(seen)).groupBy("_by")
        .agg(F.coalesce(F.min(F.when(F.col("_upto") <= limit, F.col("_level"))), F.max("_level")).alias("_least"))
    )
    return df.withColumns({"_of": by, "_at": level}).join(
        least, (F.col("_of") == F.col("_by")) & (F.col("_at") >= F.col("_least")), "left_semi").drop("_of", "_at")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of a batch stays small."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)
