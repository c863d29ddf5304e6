"""Spelling variants against all pairs of words."""
import random
import re
import zlib
from collections import Counter

import pytest
from brute import MESSY, SF_DIR
from pyspark.sql import functions as F

from perfwatch.llm import queries, spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cuts(word):
    return [word[:i] + word[i + 1:] for i in range(len(word))]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in cuts(b) if len(a) < len(b) else b in cuts(a)


def by_hand(rows, delete_one_in=199, least_chars=6, least_count=5, ratio=5):
    """(word, form, root, n, n_near, form_n), each word held against every other."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if delete_one_in and h % delete_one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_chars:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least_count}
    near = {w: [] for w in words}
    by_cut = {}
    for w in words:   # words one edit apart share a cut or one is a cut of the other
        for key in {w, *cuts(w)}:
            by_cut.setdefault(key, []).append(w)
    for group in by_cut.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    forms = {}
    for w, n in words.items():
        best = min(set(near[w]), key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(set(near[w])), words.get(forms[w])))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def dense_rows(words=400, docs=120):
    """Words over few letters, so that many are near, share all counts, or differ by an accent."""
    rng = random.Random(3)
    pool = {"".join(rng.choice("anrà") for _ in range(rng.choice([5, 6, 6, 7]))) for _ in range(words)}
    pool = sorted(pool) + ["testing", "tasting", "testings", "estings", "ÿelloww", "aabbaabb", "abababab", "bbaabbaa"]
    weight = [1 + 200 * rng.random() ** 8 for _ in pool]
    return [(n, " ".join(rng.choices(pool, weight, k=80))) for n in range(docs)]


def test_whole_table_matches_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op13_spelling(spark, SF_DIR)) == by_hand(rows)


@pytest.mark.parametrize("node_words", [20_000, 3])
def test_dense_words_in_shallow_and_deep_nodes(spark, node_words):
    rows = dense_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = by_hand(rows, 20, 5, 2, 2)
    assert sum(r[4] for r in want) > len(want) and any(r[2] not in (r[0], r[1]) for r in want)   # near words, chains
    got = spelling.group_variants(df, least_chars=5, least_count=2, ratio=2, delete_one_in=20, node_words=node_words)
    assert rows_of(got) == want


def test_every_pair_is_met_once(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abn") for _ in range(rng.choice([4, 5, 6]))) for _ in range(500)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(3)
    want = sorted((a, b) if (len(a), a) > (len(b), b) else (b, a) for i, a in enumerate(words) for b in words[:i] if one_edit(a, b))
    for node_words in (20_000, 10):
        got = [(r["a"], r["b"]) for r in spelling.near_pairs(df, node_words).collect()]
        assert sorted((a, b) if (len(a), a) > (len(b), b) else (b, a) for a, b in got) == want


def test_large_leaves_compare_only_words_of_an_equal_half():
    words = [f"{a:05b}{b:05b}".translate({48: "a", 49: "n"}) for a in range(32) for b in range(32)]   # a and n count as one
    compared = []
    trie = spelling.build(words, 0)
    leaf = trie
    while isinstance(leaf, dict):
        leaf, = leaf.values()
    for word in words:
        compared.append(len(leaf.candidates(word)))
        found: list = []
        spelling.search(trie, 0, word, spelling.Counts(word), 1, 1, True, found)
        assert sorted(found) == sorted(w for w in words if w > word and one_edit(word, w))
    assert max(compared) == 63


def test_messy_rows_and_empty_table(spark, messy, no_documents):
    got = spelling.group_variants(messy, least_chars=2, least_count=1, ratio=2, delete_one_in=3)
    assert rows_of(got) == by_hand(MESSY, 3, 2, 1, 2)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):   # words of equal counts would point at each other
        spelling.group_variants(messy, ratio=1)
    assert spelling.group_variants(no_documents).count() == 0


def test_a_third_of_all_words_is_one_word(spark):
    rows = [(n, "common " * 50 + f"commom rarer{'abcdefg'[n % 7]}") for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(spelling.group_variants(df)) == by_hand(rows, None)
    assert spelling.group_variants(df).filter(F.col("word") == "commom").first()["root"] == "common"
