"""A tree over a table of which one vector holds a third of the rows."""
import numpy as np
from brute import best_products
from pyspark.sql import functions as F

from perfwatch.llm import ann_tree


def test_points_that_cannot_be_divided_are_a_leaf():
    tree = ann_tree.Tree(np.ones((500, 4)), 30)
    assert tree.leaves == 1 and set(tree.assign(np.ones((3, 4)))) == {0}
    mixed = np.concatenate([np.ones((400, 4)), np.random.default_rng(0).normal(size=(200, 4))])
    tree = ann_tree.Tree(mixed, 60)
    assert sorted(tree.visits(mixed[0], tree.leaves)) == list(range(tree.leaves))


def test_a_third_of_the_rows_equal(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF_SIZE", 8)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (rng.normal(size=8) if i % 3 else np.ones(8))]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in df.collect()}
    got: dict = {}
    for r in ann_tree.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = sum(len(got[q] & {w[0] for w in best_products(vectors, q, 20)}) for q in got)
    assert hits >= 0.9 * 20 * len(got)
