"""Queries over the driver tables, one per operator, and the oracle SQL of those SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.llm import (
    aho_resample,
    ann_tree,
    fair_mix,
    histogram_sort,
    langid,
    line_runs,
    nbsvm,
    norm_topk,
    order_minhash,
    packing,
    spelling,
    suffix_dedup,
    toxicity,
)
from perfwatch.llm._common import id_residue


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), added_tokens=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_residue("doc_id", 5) == 0
    scored = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_sort.shard_documents(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_residue("doc_id", 4) == 2
    scored = nbsvm.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify_language(docs, learn=id_residue("doc_id", 3) != 1)
    return found.select("doc_id", (id_residue("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.drop_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                       F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fair_mix.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = aho_resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"), delete_one_in=199)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_nearest": op2_nearest,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_toxicity": op4_toxicity,
        "op5_sharding": op5_sharding,
        "op6_quality": op6_quality,
        "op7_language_id": op7_language_id,
        "op8_repeats": op8_repeats,
        "op9_top_products": op9_top_products,
        "op10_mixing": op10_mixing,
        "op11_resampling": op11_resampling,
        "op12_line_dedup": op12_line_dedup,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_top_products": norm_topk.oracle(), "op10_mixing": fair_mix.oracle(),
            "op11_resampling": aho_resample.oracle(), "op12_line_dedup": line_runs.oracle(),
            "op13_spelling": spelling.oracle()}
