"""Pairs at and just above the least similarity, and short texts, are found."""
import random

import numpy as np

from perfwatch.llm import order_minhash


def substituted(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(words)), changes):
        out[at] = f"new{rng.randrange(10**9)}"
    return out


def planted(pairs_each=60):
    """(id, text) rows: pairs 2i, 2i + 1 that differ in a share of their words, at random places."""
    rng, rows = random.Random(4), []
    for size, share in [(200, 0.2), (200, 0.15), (200, 0.1), (60, 0.2), (45, 0.2), (39, 0.2)] + [(n, 0.2) for n in range(8, 16)]:
        for _ in range(pairs_each):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for words in (base, substituted(rng, base, int(size * share + 1e-9))):
                rows.append((len(rows), " ".join(words)))
    # an inner word of every place of a ten-word and a five-word text
    for size in (10, 5):
        for at in range(1, size - 1):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for words in (base, [*base[:at], "other", *base[at + 1:]]):
                rows.append((len(rows), " ".join(words)))
    return rows


def test_pairs_at_the_threshold(spark):
    rows = planted()
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(got) == len(rows) and all(got[i] in (i, i - i % 2) for i in got)     # no pair joins another
    missed = sum(got[i + 1] != i for i in range(0, len(rows), 2))
    assert missed <= 0.01 * len(rows) / 2


def test_word_counts_never_rule_out_a_similar_pair():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randrange(2000) for _ in range(rng.randrange(5, 80))]
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            b[rng.randrange(len(b))] = rng.randrange(2000)
        assert order_minhash.aligned_similarity(np.array(a), np.array(b)) >= 0.8 - 1e-12
