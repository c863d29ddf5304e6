"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of the distinct vectors and holds a bounded number of leaves,
so it can be sent to every task; *every* row is then assigned to a leaf.  A
query walks the tree best bin first: a priority queue of branches, ordered by
inner product with the branch centre, yields leaves until enough are visited.
How many is calibrated: for a sample of queries the true neighbours are found
by brute force over all rows, and visits are widened until the wanted recall
is reached.  Equal vectors are one entry with their smallest ids.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, sampled
from perfwatch.llm.norm_topk import _best_entries, _expand, _found, _matrix, clean_vectors, collapsed

FIT_SAMPLE = 20_000       # vectors the tree is fitted on, at most
CALIBRATION_QUERIES = 128
BRANCHES = 8
LEAF_SIZE = 256           # wished rows per leaf
MOST_LEAVES = 4096        # bound of the tree
RECALL = 0.97             # calibrated on the sample; the promise is 0.9
FIRST_VISITS = 4          # leaves of the first round
BLOCK = 2048              # rows of one block of a leaf
QUERY_BLOCK = 512


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = points[rng.choice(len(points), size=min(k, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        centres = np.array([points[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c]
                            for c in range(len(centres))])
    return centres


class Tree:
    """Inner nodes: centres of the children and what they are (node, or leaf as -1 - number)."""

    def __init__(self, points: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 5):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        self.root = self._grow(points, max(1, leaves), branches, rng)

    def _grow(self, points: np.ndarray, leaves: int, branches: int, rng: np.random.Generator) -> int:
        if leaves <= 1 or len(points) < 2 * branches:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        centres = _kmeans(points, branches, rng)
        nearest = ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        if (nearest == nearest[0]).all():       # cannot be divided
            self.leaves += 1
            return -self.leaves
        self.centres.append(centres)
        self.children.append([])
        for c in range(len(centres)):
            part = points[nearest == c]
            share = max(1, round(leaves * len(part) / len(points)))
            self.children[node].append(self._grow(part, share, branches, rng))
        return node

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: nearest centre at every level."""
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            centres = self.centres[node]
            nearest = ((centres ** 2).sum(axis=1) - 2 * points[rows] @ centres.T).argmin(axis=1)
            todo += [(child, rows[nearest == c]) for c, child in enumerate(self.children[node]) if (nearest == c).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        heap, order, serial = [(0.0, 0, self.root)], [], 0
        while heap and len(order) < most:
            _, _, node = heapq.heappop(heap)
            while node >= 0:
                products = self.centres[node] @ query
                best = int(products.argmax())
                for c, child in enumerate(self.children[node]):
                    if c != best:
                        serial += 1
                        heapq.heappush(heap, (-float(products[c]), serial, child))
                node = self.children[node][best]
            order.append(-1 - node)
        return order


def _inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in one fixed order, whatever the block."""
    return (vectors * query).sum(axis=1)


def _best_of(vectors: np.ndarray, ids: list, queries: np.ndarray, names: list, floors: list, k: int) -> list[tuple]:
    """Each query's k best of a block that reach its floor, the k-th best so far."""
    out = []
    rough = queries @ vectors.T
    for q, name in enumerate(names):
        row = rough[q]
        cutoff = max(floors[q], np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf)
        near = np.flatnonzero(row >= cutoff - 1e-9 * max(1.0, abs(cutoff))) if np.isfinite(cutoff) else np.arange(len(row))
        if len(near):
            found, scores = _expand([], [ids[i] for i in near.tolist()], _inner(vectors[near], queries[q]), k - 1)
            out.append((name, found.tolist(), scores.tolist()))
    return out


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(row["ids"]), -1)
            queries = np.frombuffer(row["asked"], "<f8").reshape(len(row["queries"]), -1)
            yield _found(_best_of(vectors, row["ids"], queries, row["queries"], row["floors"], k))


def _leaf_block(table: pa.Table) -> pa.Table:
    return pa.table({"leaf": table.column("leaf").slice(0, 1), "ids": pa.array([table.column("ids").to_pylist()]),
                     "vectors": pa.array([_matrix(table.column("vector")).astype("<f8").tobytes()], pa.binary())})


def _query_block(table: pa.Table) -> pa.Table:
    return pa.table({"leaf": table.column("leaf").slice(0, 1), "queries": pa.array([table.column("query").to_pylist()]),
                     "floors": pa.array([table.column("floor").to_pylist()], pa.list_(pa.float64())),
                     "asked": pa.array([_matrix(table.column("vector")).astype("<f8").tobytes()], pa.binary())})


def calibrate(tree: Tree, placed: DataFrame, queries: np.ndarray, names: list[int], k: int, recall: float) -> int:
    """Least number of leaf visits at which the sample queries reach ``recall``.

    True neighbours come from brute force of the bounded sample against all
    rows, each task keeping k + 1 per query; what matters of them is their leaf.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, first = _matrix(batch.column("vector")), [i[0] for i in batch.column("ids").to_pylist()]
            first, leaf = np.array(first, dtype=np.int64), batch.column("leaf").to_numpy()
            scores = queries @ vectors.T
            for q in range(len(names)):
                ids, value, of = (np.concatenate(x) for x in zip(best[q], (first, scores[q], leaf), strict=True))
                top = np.lexsort((ids, -value))[:k + 1]
                best[q] = ids[top], value[top], of[top]
        rows = [(n, i, v, f) for n, b in zip(names, best, strict=True) for i, v, f in zip(*b, strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64())],
                                         names=["query", "id", "score", "leaf"])

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    true = (
        placed.select("ids", "vector", "leaf").mapInArrow(scan, "query long, id long, score double, leaf long")
        .filter(F.col("id") != F.col("query")).withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k).select("query", "leaf").collect())
    if not true:
        return 1
    needed = []
    for name, query in zip(names, queries, strict=True):
        rank = {leaf: i + 1 for i, leaf in enumerate(tree.visits(query, tree.leaves))}
        needed += [rank[r["leaf"]] for r in true if r["query"] == name]
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            recall: float = RECALL, fit_sample: int = FIT_SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products found for each
    query, over all rows but its own id, in double precision.

    * Vectors NULL, empty, zero, or with NULL or non-finite components take no
      part, neither do rows without an id.  Vectors of another length meet
      only queries of their length.
    * Ties go to the smaller id.  Fewer than k candidates are all returned;
      with more, a query visits on until its leaves hold over k entries.
    * Rows that repeat id and vector count once.  An empty table gives no
      rows; other columns are ignored.
    """
    vectors = cut(clean_vectors(rows, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0.0)).distinct())
    asked_ids = clean_vectors(rows.filter(is_query), id_col, vector_col).select("id").distinct()
    widths = sorted(r[0] for r in vectors.select(F.size("vector")).distinct().collect())
    out = None
    for width in widths:
        found = _one_width(vectors.filter(F.size("vector") == width), asked_ids, k, recall, fit_sample)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                             F.lit(0.0).alias("score"))
    return out


def _one_width(vectors: DataFrame, asked_ids: DataFrame, k: int, recall: float, fit_sample: int) -> DataFrame:
    kinds = cut(collapsed(vectors, k + 1))
    asked = vectors.join(asked_ids, "id")
    distinct_asked = cut(asked.groupBy("vector").agg(F.min("id").alias("query")))
    total = kinds.count()
    points = _matrix(pa.array([r[0] for r in sampled(kinds, F.col("vector"), fit_sample).select("vector").collect()],
                              pa.list_(pa.float64())))
    tree = Tree(points, min(MOST_LEAVES, -(-total // LEAF_SIZE)))
    del points

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column("vector"))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=["vector", "ids", "leaf"])

    placed = cut(kinds.select("vector", "ids").mapInArrow(place, "vector array<double>, ids array<long>, leaf long"))
    probe = sampled(distinct_asked, F.col("query"), CALIBRATION_QUERIES).collect()
    if not probe:
        most = 1
    else:
        most = calibrate(tree, placed, _matrix(pa.array([r["vector"] for r in probe], pa.list_(pa.float64()))),
                         [r["query"] for r in probe], k, recall)
    sizes = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    def leaves_of(query: np.ndarray) -> list[int]:
        """The calibrated visits; more, if those leaves hold too few entries."""
        order = tree.visits(query, most)
        if sum(sizes.get(leaf, 0) for leaf in order) <= k:
            order, held = tree.visits(query, tree.leaves), 0
            for n, leaf in enumerate(order):
                held += sizes.get(leaf, 0)
                if held > k and n + 1 >= most:
                    return order[:n + 1]
        return order

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = [leaves_of(q) for q in _matrix(batch.column("vector"))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                                                 names=["vector", "query", "leaves"])

    walked = distinct_asked.select("vector", "query").mapInArrow(
        walk, "vector array<double>, query long, leaves array<long>")
    crews = max(1, -(-distinct_asked.count() // QUERY_BLOCK))
    blocks = (
        placed.withColumn("part", F.pmod(F.xxhash64(F.col("ids")[0]), F.create_map(
            *[F.lit(x) for leaf, n in sizes.items() for x in (leaf, -(-n // BLOCK))])[F.col("leaf")]))
        .groupBy("leaf", "part").applyInArrow(_leaf_block, "leaf long, ids array<array<long>>, vectors binary"))
    blocks, walked = cut(blocks), cut(walked)
    # visits are widened round by round, three times as many leaves as before; each round tells
    # only what reaches the k-th best of the rounds before
    met, done = None, 0
    most = walked.agg(F.max(F.size("leaves"))).first()[0] or 0
    while done < most:
        upto = min(most, 4 * done or FIRST_VISITS)
        if met is None:
            asking = walked.withColumn("floor", F.lit(float("-inf")))
        else:
            asking = walked.join(met.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")), "query",
                                 "left").withColumn("floor", F.when(F.col("n") > k, F.col("least")).otherwise(float("-inf")))
        asking = (
            asking.withColumn("leaf", F.explode(F.slice("leaves", done + 1, upto - done)))
            .withColumn("crew", F.pmod(F.xxhash64("query"), F.lit(crews))).select("leaf", "crew", "query", "floor", "vector")
            .groupBy("leaf", "crew").applyInArrow(
                _query_block, "leaf long, queries array<long>, floors array<double>, asked binary"))
        found = asking.join(blocks, "leaf").select("ids", "vectors", "queries", "floors", "asked").mapInArrow(
            lambda it: _search(it, k + 1), "query long, ids array<long>, scores array<double>")
        met, done = cut(_best_entries(found, met, k)), upto
    if met is None:     # no query of this length
        met = distinct_asked.select("query", F.lit(0).alias("place"), F.col("query").alias("vec_id"),
                                    F.lit(0.0).alias("score"))
    lists = met.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    return (
        asked.join(distinct_asked, "vector").select("id", "query").join(lists, "query")
        .select("id", F.posexplode(F.slice(F.filter("list", lambda e: e["vec_id"] != F.col("id")), 1, k)).alias("pos", "e"))
        .select(F.col("id").alias("query_id"), (F.col("pos") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"),
                F.col("e.score").alias("score")))
