"""Lineage cuts in the shared folder the cluster names."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str | None:
    """The folder of ``spark.checkpoint.dir``, or the one set on the context; None if there is neither."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint: computed once however often it is
    read, nothing stays cached, and a lost executor costs no recomputation.
    Without a configured folder the frame is returned as it is."""
    return df.checkpoint(eager=True) if checkpoint_root(df.sparkSession) else df


def cut_counting(df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
    """``cut(df)`` and how many of its rows meet ``condition``, counted while they are written."""
    if not checkpoint_root(df.sparkSession):
        return df, df.where(condition).count()
    counted = Observation()
    done = cut(df.observe(counted, F.count_if(condition).alias("n")))
    return done, int(counted.get["n"])
