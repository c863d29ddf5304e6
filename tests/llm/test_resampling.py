"""Importance resampling against a plain count of words."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from brute import MESSY, SF_DIR
from pyspark.sql import functions as F

from perfwatch.llm import aho_resample, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, ngram):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]


def by_hand(rows, target, ngram=1, buckets=10_000, percent=10, least=20):
    """(id, features, weight, score, rank) of every row."""
    found = [(doc, *features(text, ngram)) for doc, text in rows]
    s = Counter(c % buckets for _, _, crcs in found for c in crcs)
    t = Counter(c % buckets for text in target for c in features(text, ngram)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, words, crcs in found:
        weight = sum(gain[c % buckets] for c in crcs) // len(crcs) if crcs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(crcs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    drawn = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    places = [n + 1 if n < percent * len(drawn) // 100 else None for n in range(len(drawn))]
    rest = [(*r[:4], None) for r in out if r[4] < least]
    return sorted([(*r[:4], place) for r, place in zip(drawn, places)] + rest, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_whole_table_matches_a_plain_count(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    assert rows_of(queries.op11_resampling(spark, SF_DIR)) == by_hand(docs, target)


def test_messy_rows_runs_of_words_and_small_dictionaries(spark, messy, monkeypatch):
    target = ["the cat and the dog", None, "", "ÄPFEL über Straße", "the cat and the dog"]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id long")
    for ngram, words, piece in ((1, 131_072, 1 << 20), (1, 3, 40), (3, 5, 64), (2, 0, 1 << 20)):
        monkeypatch.setattr(aho_resample, "PIECE", piece)
        got = aho_resample.resample(messy, frame, ngram=ngram, dictionary_words=words, percent=50, least_words=2, buckets=50)
        assert rows_of(got) == by_hand(MESSY, target, ngram, 50, 50, 2)


def test_scanner_pieces_and_unknown_words(monkeypatch):
    text = " ".join(f"w{n % 70}  Größe, x{n}\n" for n in range(400)) + "y" * 300
    for words in ([], [b"w1", b"w2", "größe".encode()], sorted({f"w{n}".encode() for n in range(70)})):
        scanner = aho_resample.Scanner(words)
        for piece in (7, 64, 1 << 20):
            monkeypatch.setattr(aho_resample, "PIECE", piece)
            for ngram in (1, 2, 4):
                got = [c for _, crcs in scanner.features(text.encode(), ngram) for c in crcs.tolist()]
                assert Counter(got) == Counter(features(text, ngram)[1])
    assert list(scanner.features(None, 2)) == [] and list(scanner.features(b"", 1)) == []


def test_crc_of_a_concatenation():
    a, b = [b"", b"abc", b"x" * 1000, "ñ".encode()], [b"q", b"", b"y" * 70_001, b" z"]
    got = aho_resample.concat_crc(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([zlib.crc32(x) for x in b], np.uint32),
                                  np.array([len(x) for x in b], np.int64))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_dictionary_is_bounded_and_most_frequent_first(spark):
    df = spark.createDataFrame([("a a a b b c " + "l" * 70,), (None,), ("b c d",)], "text string")
    assert aho_resample.dictionary([df], "text", 2) == [b"a", b"b"]     # three times each; c, twice, would still fit no more
    assert aho_resample.dictionary([df], "text", 3) == [b"a", b"b", b"c"]
    assert aho_resample.dictionary([df.limit(0)], "text", 3) == []


def test_a_third_of_the_rows_is_one_row(spark):
    rows = [(n, f"some words of row {n} " * 6) for n in range(600)] + [(7, "the same words again and again " * 5)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    target = spark.createDataFrame([("the same words again",)], "text string")
    got = aho_resample.resample(df, target, percent=40)
    assert rows_of(got) == by_hand(rows, ["the same words again"], percent=40)
    assert sorted(r[0] for r in got.filter("rank is not null").select("rank").collect()) == list(range(1, 361))


def test_empty_tables(spark, no_documents):
    target = spark.createDataFrame([("a b",)], "text string")
    assert aho_resample.resample(no_documents, target).count() == 0
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    got = aho_resample.resample(docs, target.limit(0), least_words=1, percent=100)
    assert rows_of(got) == by_hand([(1, "a b c")], [], percent=100, least=1)
    assert got.select(F.max("rank")).first()[0] == 1
