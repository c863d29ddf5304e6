"""The pipeline's stages on given and on messy documents."""
import corpus_pipeline
import pytest
from brute import SF_DIR, near_classes, removed_repeats
from pyspark.sql import functions as F

from perfwatch.llm import fair_mix
from perfwatch.llm._common import ensure_checkpoint_dir

COLUMNS = list(corpus_pipeline.COLUMNS)


def cut(df):
    return df.checkpoint()


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    known = cut(stages["language_id"](spark, docs, SF_DIR))
    assert known.columns == COLUMNS
    assert known.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()

    single = cut(stages["near_duplicates"](spark, known, SF_DIR))
    assert single.columns == COLUMNS
    want = near_classes([(r["doc_id"], r["text"]) for r in known.filter(F.length("text") < 2500).collect()])
    got = {r["doc_id"] for r in single.collect()}
    assert {d for d in want if d in got} == {d for d, lead in want.items() if d == lead}

    fresh = cut(stages["repeated_passages"](spark, single, SF_DIR))
    assert fresh.columns == COLUMNS and dict(fresh.dtypes) == dict(docs.dtypes)
    brute = {d: (n, gone) for d, n, gone, _, _ in removed_repeats([(r["doc_id"], r["text"]) for r in single.collect()])}
    for r in fresh.collect():
        size, gone = brute[r["doc_id"]]
        assert size - gone - 6 <= len(r["text"].encode()) <= size - gone and r["n_chars"] == len(r["text"])
    assert {r["doc_id"] for r in fresh.collect()} == {d for d, (n, gone) in brute.items() if n - gone > 0}

    mixed = cut(stages["mixing"](spark, fresh, SF_DIR))
    turns = {r["doc_id"]: r["taken"] // r["size"] for r in fair_mix.mix_sources(fresh).collect() if r["size"]}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {d: t for d, t in turns.items() if t}

    pieces = stages["packing"](spark, mixed, SF_DIR)
    tokens = {r["doc_id"]: (r["total"], r["each"]) for r in pieces.groupBy("doc_id").agg(
        F.sum("length").alias("total"), F.max("doc_tokens").alias("each")).collect()}
    assert tokens.keys() == counts.keys()
    assert all(total == counts[d] * each for d, (total, each) in tokens.items())


def test_run_and_messy_rows(spark, messy, tmp_path):
    messy.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")).write.parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert corpus_pipeline.run(spark, SF_DIR).select("sequence_id", "offset").distinct().count() > 0


def test_empty_documents(spark, messy):
    docs = messy.limit(0).select("doc_id", "text", "lang", "source", F.lit(0).cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF_DIR))
        assert docs.count() == 0


def test_repeated_rows_leave_one(spark):
    row = (1, "the same words again and again in one row", "en", "a", 40)
    docs = spark.createDataFrame([row, row, (None, row[1], "en", None, 40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).count() == 1


def test_no_known_language_keeps_what_has_letters(spark):
    docs = spark.createDataFrame([(1, "plain words", None, "a", 11), (2, "12 ½ --", None, "a", 7), (3, None, None, "a", None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS and [r["doc_id"] for r in kept.collect()] == [1]


def test_of_rows_that_repeat_an_id_the_same_one_stays(spark):
    text = "one text that came in from three sources at once"
    rows = [(5, text, lang, source, 40) for lang, source in (("fr", "c"), ("en", "b"), ("de", "b"), (None, "c"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for partitions in (1, 4):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(partitions), SF_DIR).collect()
        assert [(r["lang"], r["source"]) for r in kept] == [("de", "b")]


def test_a_cluster_needs_a_shared_folder():
    class Bare:
        master = "spark://somewhere:7077"
        sparkContext = conf = property(lambda self: self)
        getCheckpointDir = lambda self: None
        getConf = lambda self: self
        get = lambda self, name, default="": default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Bare())
