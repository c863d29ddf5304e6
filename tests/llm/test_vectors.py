"""Vector searches against brute force."""
import math

import numpy as np
import pytest
from brute import SF_DIR, best_products
from pyspark.sql import functions as F

from perfwatch.llm import ann_tree, norm_topk

SCHEMA = "vec_id long, embedding array<float>, query string, ids int"


@pytest.fixture
def awkward(spark):
    """Copies, ties, NULLs, zeros, non-finite components, lengths far apart, a repeated row."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6) * 10 ** rng.uniform(-1, 1)]) for i in range(60)]
    rows += [(100 + i, rows[5][1]) for i in range(30)] + [(7, rows[7][1])]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (204, [math.nan] + [0.0] * 5), (205, [math.inf] + [0.0] * 5), (None, rows[3][1]), (300, [1.0, 2.0])]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)


def usable(df, zero: bool):
    out = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out[r["vec_id"]] = np.array(v, dtype=float)
    return out


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for hits in out.values():
        assert [h[0] for h in hits] == list(range(1, len(hits) + 1))
    return {q: [h[1:] for h in hits] for q, hits in out.items()}


def by_width(vectors, query, k):
    return best_products({i: v for i, v in vectors.items() if len(v) == len(vectors[query])}, query, k)


def test_exact_search_awkward(awkward, monkeypatch):
    vectors = {i: np.floor(256 * v) for i, v in usable(awkward, True).items()}
    got = found(norm_topk.top_inner_products(awkward, F.col("vec_id") % 5 == 0))
    queries = [i for i in vectors if i % 5 == 0 and len(vectors[i]) > 2]
    assert set(queries) <= set(got)
    for q in queries:
        assert got[q] == [(i, int(s)) for i, s in by_width(vectors, q, 5)]
    monkeypatch.setattr(norm_topk, "BLOCK", 7)      # many blocks: bounds of later ones bite
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 4)
    assert found(norm_topk.top_inner_products(awkward, F.col("vec_id") % 5 == 0)) == got
    assert norm_topk.top_inner_products(awkward.limit(0), F.lit(True)).count() == 0


def check_whole_products(df, vectors, modulus, got):
    """``vectors``: Python integers; products beyond a long count as the nearest one."""
    asked = [i for i in vectors if i % modulus == 0]
    assert set(got) == set(asked)
    for q in asked:
        products = [(i, min(max(sum(x * y for x, y in zip(vectors[q], v, strict=True)), -2**63), 2**63 - 1))
                    for i, v in vectors.items() if i != q]
        assert got[q] == sorted(products, key=lambda p: (-p[1], p[0]))[:5]


@pytest.mark.parametrize("power", [20, 24, 30, 100])
def test_products_beyond_doubles_are_exact(spark, monkeypatch, power):
    """Products around 2**56 to 2**63, where doubles round, and far beyond a long."""
    rng = np.random.default_rng(power)
    rows = [(i, [float(math.floor(x * 2.0**power)) + 0.25 for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, [x * 2.0**-power for x in rows[i][1]]) for i in range(20)]
    rows += [(200, [0.0] * 4), (201, [1e308, 0.0, 0.0, 0.0])]       # the last one overflows when scaled
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows if i != 201}
    check_whole_products(df, vectors, 3, found(norm_topk.top_inner_products(df, F.col("vec_id") % 3 == 0)))
    monkeypatch.setattr(norm_topk, "BLOCK", 7)
    check_whole_products(df, vectors, 3, found(norm_topk.top_inner_products(df, F.col("vec_id") % 3 == 0)))


def test_huge_components_do_not_end_the_search(spark):
    rows = [(i, [1e305 / (i + 1), -1e305 * (i % 3), 1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    check_whole_products(df, vectors, 1, found(norm_topk.top_inner_products(df, F.lit(True))))


@pytest.mark.parametrize("blocks", [1_000, 10_000])
def test_many_blocks(spark, monkeypatch, blocks):
    """The plan does not grow with the number of blocks."""
    rng = np.random.default_rng(blocks)
    count = 2 * blocks
    matrix = np.floor(rng.normal(size=(count, 3)) * 256) / 256 * rng.uniform(0.2, 3, size=(count, 1))
    df = spark.createDataFrame(list(zip(range(count), matrix.tolist(), strict=True)), "vec_id long, embedding array<double>")
    monkeypatch.setattr(norm_topk, "BLOCK", 2)
    monkeypatch.setattr(norm_topk, "TASK_BLOCKS", blocks // 8)
    asked = count // 20
    got = found(norm_topk.top_inner_products(df, F.col("vec_id") % asked == 0))
    whole = np.floor(matrix * 256)
    assert len(got) == 20
    for q, hits in got.items():
        scores = (whole @ whole[q]).astype(int)
        order = [i for i in np.lexsort((np.arange(count), -scores)).tolist() if i != q][:5]
        assert hits == [(i, int(scores[i])) for i in order]


def test_block_search_prunes_without_loss():
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.normal(size=(300, 20)) * 50)
    queries = np.floor(rng.normal(size=(8, 20)) * 50)
    rotation = np.linalg.svd(vectors, full_matrices=False)[2].T
    exact = queries @ vectors.T
    floor = np.sort(exact, axis=1)[:, -20]
    got = {q: set(left.tolist()) for q, left, _ in norm_topk._search_block(
        vectors, np.sqrt((vectors ** 2).sum(axis=1)), rotation, queries, floor, 5)}
    for q in range(8):
        assert set(np.flatnonzero(exact[q] >= np.sort(exact[q])[-5]).tolist()) <= got[q]


def test_tree_search_awkward(awkward):
    vectors = usable(awkward, False)
    got = found(ann_tree.nearest(awkward, F.col("vec_id") % 5 == 0, k=6))
    for q in [i for i in vectors if i % 5 == 0 and len(vectors[i]) > 2]:
        want = by_width(vectors, q, 6)
        assert [h[0] for h in got[q]] == [w[0] for w in want]
        assert np.allclose([h[1] for h in got[q]], [w[1] for w in want], rtol=1e-12)
    assert ann_tree.nearest(awkward.limit(0), F.lit(True)).count() == 0


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "", 0), (2, [0.5, 0.5], "", 0), (3, [1.0, 0.0], "", 0)], SCHEMA)
    assert found(ann_tree.nearest(df, F.lit(True), k=20)) == {
        1: [(3, 1.0), (2, 0.5)], 2: [(1, 0.5), (3, 0.5)], 3: [(1, 1.0), (2, 0.5)]}


def test_recall_on_given_embeddings(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF_SIZE", 40)     # a tree of many leaves
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    vectors = usable(df, False)
    got = found(ann_tree.nearest(df, F.col("vec_id") % 20 == 0))
    hits = [len({h[0] for h in got[q]} & {w[0] for w in best_products(vectors, q, 20)}) for q in got]
    assert set(got) == {i for i in vectors if i % 20 == 0} and sum(hits) >= 0.9 * 20 * len(got)
    exact = found(norm_topk.top_inner_products(df, F.col("vec_id") % 50 == 0))
    whole = {i: np.floor(256 * v) for i, v in vectors.items()}
    assert all(exact[q] == [(i, int(s)) for i, s in best_products(whole, q, 5)] for q in exact) and exact


def test_leaves_come_best_bin_first():
    points = np.random.default_rng(1).normal(size=(500, 8))
    tree = ann_tree.Tree(points, 30)
    query = points[3]
    order = tree.visits(query, tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.visits(query, 3) == order[:3]
    assert set(tree.assign(points)) <= set(range(tree.leaves))
