"""Corpus preparation: raw documents to packed windows of tokens, in five stages.

Every stage takes the documents its predecessor kept and returns a frame with
the columns of documents (the last one: pieces of packed windows).  ``run``
writes each stage's result to the shared folder and reads it again, so a lost
executor costs one stage at most.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.llm import fair_mix, langid, order_minhash, packing, suffix_dedup
from perfwatch.llm._common import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_CERTAINTY = 0.5


def _text_key(column: str = "text"):
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")).cast("binary"))


def _one_of_each(docs: DataFrame, *keys: str) -> DataFrame:
    """One row per ``keys``: of rows that differ in other columns only, the smallest by source, language and length."""
    rest = [c for c in ("source", "lang", "n_chars", "text") if c not in keys]
    return docs.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row")).select(*keys, "row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter, and
    those no language is likelier for than all others together, go.  If no
    document tells its language, nothing can be recognised, and only those
    without a letter go."""
    if docs.filter("text IS NOT NULL AND lang IS NOT NULL").isEmpty():
        return docs.filter(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = langid.identify_language(docs, learn=F.lit(True), carry=COLUMNS)
    kept = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_CERTAINTY)
    return found.filter(kept).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: the one of smallest id."""
    kept = order_minhash.near_duplicates(docs).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    keyed = docs.select(*COLUMNS, _text_key().alias("text_key"))
    same = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed["text_key"] == kept["kept_key"])
    # rows that repeat an id and its text match themselves: one of them stays
    return _one_of_each(keyed.join(kept, same, "left_semi"), "doc_id", "text_key").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier in the corpus.  A
    character that a removal cuts in two goes with it; documents of which
    nothing is left go."""
    kept = suffix_dedup.drop_repeats(docs, carry=("doc_id", "lang", "source"))
    whole = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("�"), F.lit(""))
    text = F.when(F.size("span_starts") > 0, whole).otherwise(F.col("kept").cast("string"))
    return kept.select("doc_id", text.alias("text"), "lang", "source").filter("text <> ''").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.
    Rows that repeat id, source and text count their turns together."""
    turns = (
        fair_mix.mix_sources(docs).filter("taken > 0")
        .groupBy("doc_id", "source", "text_key").agg(F.sum(F.expr("taken div size")).alias("turns"))
        .select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("text_key").alias("mix_key"),
                "turns"))
    keyed = _one_of_each(docs.select(*COLUMNS, _text_key().alias("text_key")), "doc_id", "source", "text_key")
    same = (keyed["doc_id"].eqNullSafe(turns["mix_id"]) & keyed["source"].eqNullSafe(turns["mix_source"])
            & (keyed["text_key"] == turns["mix_key"]))
    return keyed.join(turns, same).withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), "turns"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows; a document taken twice is packed twice."""
    pieces = packing.pack_documents(docs, added_tokens=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_to_targets),
    ("packing", pack),
]
ORACLE_SQL = None   # recognition, alignment and packing are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the documents of ``sf_dir``."""
    root, shared = sf_dir.rstrip("/"), f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, root)
        if n < len(STAGES) - 1:
            docs.write.parquet(f"{shared}/{name}")
            docs = spark.read.parquet(f"{shared}/{name}")
    return docs
