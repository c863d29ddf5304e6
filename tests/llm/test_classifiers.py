"""Language, quality and toxicity: brute force, gradients, held-out accuracy, awkward rows."""
import numpy as np
import pytest
from brute import MESSY, SF_DIR, all_segmentations
from pyspark.sql import functions as F

from perfwatch.llm import langid, nbsvm, queries, toxicity
from perfwatch.llm._common import sampled_by


@pytest.fixture(scope="module")
def pieces():
    return langid.Pieces(langid.vocabulary_path())


def random_prob(pieces, languages=2):
    prob = np.random.default_rng(0).random((len(pieces) + 1, languages)) * 1e-2
    prob[-1] = 0
    return prob


def test_forward_sums_all_segmentations(pieces):
    prob = random_prob(pieces)
    words = [b" the", b" abcab", "é".encode(), b"\xff\x00", b" internationally"]
    got = langid.likelihoods(words, pieces, prob)
    for g in range(2):
        table = {p: prob[i, g] for i, p in enumerate(pieces.pieces)}
        for i, word in enumerate(words):
            assert np.isclose(got[i, g], np.log(all_segmentations(word, table)))
    assert np.isfinite(langid.likelihoods([b"x" * 3000], pieces, prob)).all()


def test_expected_counts_by_differences(pieces):
    """d log P / d log p of a piece is its expected number of uses."""
    prob, words, n = random_prob(pieces, 1), [b" there", b" an", b" theatre"], np.array([2.0, 1.0, 3.0])
    got = langid.expected_counts(words, n, pieces, prob)
    for piece in (b"the", b" the", b"e", b"at"):
        i = pieces.pieces.index(piece)
        up = prob.copy()
        up[i] *= 1 + 1e-6
        moved = n @ (langid.likelihoods(words, pieces, up) - langid.likelihoods(words, pieces, prob))[:, 0] / 1e-6
        assert np.isclose(got[i], moved, rtol=1e-4, atol=1e-6)


def test_language_given_and_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = queries.op7_language_id(spark, SF_DIR)
    both = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(both) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in both]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in both)


def test_language_awkward(spark, messy, no_documents):
    got = langid.identify_language(messy, F.lit(True), carry=("doc_id", "text", "size", "bucket"))
    rows = got.collect()
    assert len(rows) == len(MESSY) and got.columns == ["doc_id", "text", "size", "bucket", "lang_pred", "score"]
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert {r["lang_pred"] for r in langid.identify_language(messy, F.lit(False)).collect()} == {"und"}
    assert langid.identify_language(no_documents, F.lit(True)).count() == 0


def test_numerals_are_no_letters(spark):
    rows = [(1, "the old house by the sea", "en"), (2, "das alte Haus am See", "de"), (3, "½ ② Ⅷ ¹ ٣", None), (4, "½ x", None)]
    found = langid.identify_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), carry=("doc_id",))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert got[3] == ("und", 0.0) and got[4][0] != "und"


def test_a_rare_language_is_learned(spark):
    rows = [(i, f"the house number {i % 97} stands by the old sea wall", "en") for i in range(20_000)]
    rows += [(20_000, "der alte Mann geht über die lange Brücke", "de"), (20_001, "über die lange alte Brücke geht der Mann", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify_language(docs, F.lit(True), train_documents=40).filter("doc_id >= 19999").collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {19_999: "en", 20_000: "de", 20_001: "de"}


def test_samples_are_bounded_by_class(spark):
    docs = spark.range(30_000).selectExpr("id", "CASE WHEN id % 1000 = 0 THEN 'rare' ELSE 'common' END AS kind")
    repeated = docs.unionByName(spark.range(500).selectExpr("7L AS id", "'single' AS kind"))
    for df in (repeated, repeated.repartition(7)):
        got = {r["kind"]: r["count"] for r in sampled_by(df, F.col("id"), F.col("kind"), 200).groupBy("kind").count().collect()}
        assert got["rare"] == 30 and got["single"] == 500 and 140 <= got["common"] <= 200


def test_words_are_split_alike(spark):
    text = "".join(f"a{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(F.split("text", langid.WHITE_SPACE).alias("words")).first()["words"]
    assert [w for w in got if w] == text.split()


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label > 0
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / max(1, ones.sum() * (~ones).sum())


@pytest.mark.parametrize("name,label,least", [("op4_toxicity", "toxic", 0.75), ("op6_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = queries.queries()[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    both = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert both["score"].between(0, 1).all() and auc(both["score"].to_numpy(), both[label].to_numpy()) > least


def test_classifiers_awkward(spark, messy, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 1), (8, 0, 1), (9, None, None), (None, 1, 1), (7, 5, 5), (10, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for score, column in ((nbsvm.score_quality, "quality"), (toxicity.score_toxicity, "toxic")):
        rows = score(messy, labels, F.lit(True), column).collect()
        assert len(rows) == len(MESSY) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in score(messy, labels.limit(0), F.lit(True), column).collect()}) == 1
        assert score(no_documents, labels, F.lit(True), column).count() == 0


def test_indicators_are_sets_of_ngrams():
    text = "ab ab ab".encode()
    (found,) = nbsvm.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    one = [f for f in found if f < nbsvm.PAIRS_AT]
    two = [f - nbsvm.PAIRS_AT for f in found if nbsvm.PAIRS_AT <= f < nbsvm.TRIPLES_AT]
    repeats = {f - nbsvm.REPEATS_AT for f in found if f >= nbsvm.REPEATS_AT}
    assert one == sorted(set(text)) and set(two) == {a << 8 | b for a, b in zip(text, text[1:], strict=False)}
    assert repeats == {0b10, 0b11, 0b101, 0b111, 0b1011}      # a leading one marks the length


def test_hinge_fit_separates():
    rng = np.random.default_rng(5)
    rows = [np.sort(rng.choice(50, 8, replace=False)) + (60 if i % 2 else 0) for i in range(60)]
    labels = np.array([i % 2 for i in range(60)])
    ratios = nbsvm.log_count_ratios(rows, labels)
    weights, bias = nbsvm.hinge_fit(rows, labels, ratios)
    assert ((nbsvm.decisions(rows, weights, bias, ratios) > 0) == (labels > 0)).all()


def test_network_gradients(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 7)
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    table, number = rng.normal(size=(9, net.p["xf"].shape[0])), rng.integers(0, 9, (4, 7))
    present = np.arange(7) < np.array([7, 3, 1, 5])[:, None]
    slope, tape = rng.normal(size=4), {}
    net.forward(table, number, present, tape)
    grad = net.gradients(tape, slope)
    for name in ("hf", "hb", "xf", "xb", "cf", "cb", "look", "out", "bias"):
        at = tuple(rng.integers(0, n) for n in net.p[name].shape)
        step = 1e-3     # states are kept in single precision
        kept = net.p[name][at]
        values = []
        for sign in (1, -1):
            net.p[name][at] = kept + sign * step
            values.append(slope @ net.forward(table, number, present))
        net.p[name][at] = kept
        assert np.isclose(grad[name][at], (values[0] - values[1]) / (2 * step), rtol=2e-2, atol=2e-3), name


def test_windows_cover_every_word():
    first = np.array([0, 0, 1, 129, 1000])
    index, present, text = toxicity.windows(first)
    for i in range(4):
        seen = {int(w) for w in index[text == i][present[text == i]]}
        assert seen == set(range(first[i], first[i + 1]))
