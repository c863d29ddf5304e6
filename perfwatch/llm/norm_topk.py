"""Exact top-k inner products over norm-sorted vectors.

Vectors are processed in blocks of falling length.  Coordinates are rotated
by the singular vectors of a bounded sample, which gathers most of each
product in the leading coordinates: a partial sum over them plus the product
of the residual lengths (Cauchy-Schwarz) bounds the whole product.  A query
leaves a block unread if its length times the block's greatest length stays
below the query's k-th best so far, and a vector is finished in exact integer
arithmetic only if its bound does not: in doubles where lengths prove that they
hold every partial sum, in 64-bit integers where these hold the product, and in
Python's integers beyond.

Blocks are cut from a range sort by falling length, so that their numbers
follow it.  The longest vectors, one block, are seen by all queries first; they
give each query its first k-th best.  Rounds over more and more blocks follow,
each with the k-th best of the rounds before; the blocks of a round are
independent tasks.  Equal vectors are collapsed first; of their ids the k + 1
smallest suffice.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm._common import cut

SCALE = 256.0
BLOCK = 4096             # vectors of one block
QUERY_BLOCK = 512        # queries that travel together
HEAD = 16                # leading rotated coordinates
SAMPLE = 4096            # vectors the rotation is computed from
SALTS = 16
TASK_BLOCKS = 16         # blocks cut by one task of the range sort
TASK_BITS = 33           # monotonically_increasing_id: the partition's number lies above these bits
EXACT_DOUBLE, EXACT_LONG = 2.0**53, 2.0**62
GREATEST, LEAST = 2**63 - 1, -2**63


def clean_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part: vector not NULL, not
    empty, all components present and finite."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).filter(
        F.col("id").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)))


def collapsed(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest ids, ascending.  A vector
    that very many rows share is gathered through salted partial lists, which
    hold ``keep`` ids each."""
    def least(ids: Column) -> Column:
        return F.slice(F.array_sort(ids), 1, keep)

    rank = F.row_number().over(Window.partitionBy("vector", "salt").orderBy("id"))
    return (
        rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).withColumn("rank", rank)
        .filter(F.col("rank") <= keep)
        .groupBy("vector").agg(least(F.collect_list("id")).alias("ids")))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(np.float64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    falling = ~scores if scores.dtype.kind == "i" else -scores      # the least long has no negative
    return np.lexsort((ids, falling))[:k]


def _exact_products(vectors: np.ndarray, query: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers, those beyond as the
    nearest one.  ``limits`` bound each sum of absolute products."""
    with np.errstate(over="ignore", invalid="ignore"):
        rough = vectors @ query
    small, middle = limits < EXACT_DOUBLE, limits < EXACT_LONG
    out = np.where(small, rough, 0.0).astype(np.int64)
    at = np.flatnonzero(middle & ~small)
    if len(at):     # neither vector is zero, so no component is longer than the limit
        out[at] = vectors[at].astype(np.int64) @ query.astype(np.int64)
    at = np.flatnonzero(~middle)
    if len(at):
        whole = [int(x) for x in query.tolist()]
        for i in at.tolist():
            product = sum(int(x) * y for x, y in zip(vectors[i].tolist(), whole, strict=True))
            out[i] = min(max(product, LEAST), GREATEST)
    return out


def _search_block(vectors: np.ndarray, norms: np.ndarray, rotation: np.ndarray, queries: np.ndarray,
                  floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the vectors that may enter its best k, with exact scores.

    ``floor``: each query's k-th best score so far (-inf: none).  Bounds get a
    relative slack against rounding, and one that overflows rules nothing out.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        turned, asked = vectors @ rotation, queries @ rotation
        rest = np.sqrt((turned[:, HEAD:] ** 2).sum(axis=1))
        asked_rest = np.sqrt((asked[:, HEAD:] ** 2).sum(axis=1))
        length = np.sqrt((queries ** 2).sum(axis=1))
        hopeless = length * norms.max(initial=0.0) * (1 + 1e-9) + 1e-6 < floor
    for q in np.flatnonzero(~hopeless).tolist():
        with np.errstate(over="ignore", invalid="ignore"):
            limit = norms * length[q] * (1 + 1e-9)
            bound = turned[:, :HEAD] @ asked[q, :HEAD] + rest * asked_rest[q]
            bound += np.abs(bound) * 1e-9 + 1e-6 + limit * 1e-9
        # scores end at those of 64 bits, so bounds do
        left = np.flatnonzero(~np.isfinite(bound) | (np.maximum(bound, float(LEAST)) >= floor[q]))
        if not len(left):
            continue
        exact = _exact_products(vectors[left], queries[q], limit[left])
        fine = exact.astype(np.float64) >= floor[q]
        if len(left) > k:
            fine &= exact >= np.partition(exact, len(exact) - k)[len(exact) - k]
        left, exact = left[fine], exact[fine]
        if len(left):
            yield q, left, exact


def _expand(query_ids: list, ids: list, scores: np.ndarray, k: int):
    """Best k + 1 candidate ids of one distinct query vector."""
    flat = np.concatenate([np.array(i, dtype=np.int64) for i in ids])
    value = np.repeat(scores, [len(i) for i in ids])
    best = _best(flat, value, k + 1)
    return flat[best], value[best]


def _found(rows: list[tuple], score: pa.DataType = pa.float64()) -> pa.RecordBatch:
    q, ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, pa.list_(pa.int64())),
                                       pa.array(scores, pa.list_(score))], names=["query", "ids", "scores"])


def _pair_blocks(batches: Iterator[pa.RecordBatch], rotation: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Rows of (block of vectors, block of queries) -> each query's best of the block."""
    for batch in batches:
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(row["ids"]), -1)
            queries = np.frombuffer(row["asked"], "<f8").reshape(len(row["queries"]), -1)
            if vectors.shape[1] != queries.shape[1]:
                continue
            with np.errstate(over="ignore"):
                norms = np.sqrt((vectors ** 2).sum(axis=1))
            out = []
            for q, left, exact in _search_block(vectors, norms, rotation, queries,
                                                np.array(row["floor"], dtype=float), k + 1):
                ids, scores = _expand([], [row["ids"][i] for i in left.tolist()], exact, k)
                out.append((row["queries"][q], ids.tolist(), scores.tolist()))
            yield _found(out, pa.int64())


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Vectors in their order -> blocks of ``size`` of them, one held at a time."""
    parts: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        matrix = _matrix(table.column("vector"))
        with np.errstate(over="ignore"):
            top = float(np.sqrt((matrix ** 2).sum(axis=1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
             pa.array([matrix.astype("<f8").tobytes()], pa.binary()), pa.array([top])], names=["ids", "vectors", "top"])

    held = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            parts.append(batch.slice(at, size - held))
            at, held = at + parts[-1].num_rows, held + parts[-1].num_rows
            if held == size:
                yield block()
                parts, held = [], 0
    if held:
        yield block()


def _asked(table: pa.Table) -> pa.Table:
    matrix = _matrix(table.column("vector"))
    return pa.table({"crew": table.column("crew").slice(0, 1), "queries": pa.array([table.column("query").to_pylist()]),
                     "asked": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
                     "floor": pa.array([table.column("floor").to_pylist()], pa.list_(pa.float64()))})


def top_inner_products(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                       k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k greatest integer inner
    products of the vectors floor(SCALE * x), over all rows but its own id.

    * Vectors NULL, empty, or with NULL or non-finite components take no part,
      neither do rows without an id; vectors of another length than the
      majority's meet only queries of their own length.
    * Ties go to the smaller id.  Fewer than k candidates are all returned.
    * Rows that repeat an id and a vector count once; rows that repeat the id
      with another vector are candidates of their own, but never of that id.
    * Products are exact however large components are.  One that a long cannot
      hold counts as the nearest long, so ties among such go to the smaller id
      too.  A finite component that overflows a double when scaled is not finite.
    * An empty table gives no rows; other columns are ignored.
    """
    def whole(x: Column) -> Column:
        # from 2**52 on doubles are whole numbers, and floor() would end at the greatest long
        return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)

    def scaled(some: DataFrame) -> DataFrame:
        fit = clean_vectors(some, id_col, vector_col).withColumn("vector", F.transform("vector", lambda x: x * SCALE))
        return clean_vectors(fit, "id", "vector").select("id", F.transform("vector", whole).alias("vector"))

    asked_ids = scaled(rows.filter(is_query)).select("id").distinct()
    vectors = cut(scaled(rows).distinct())
    kinds = cut(collapsed(vectors, k + 1).withColumn("norm", F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x * x)).withColumn("width", F.size("vector")))
    out = None
    for width in sorted(r["width"] for r in kinds.select("width").distinct().collect()):
        found = _one_width(kinds.filter(F.col("width") == width), vectors.filter(F.size("vector") == width), asked_ids, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                             F.lit(0).cast("long").alias("score"))
    return out


def _best_entries(found: DataFrame, met: DataFrame | None, k: int) -> DataFrame:
    """(query, vec_id, score, place) of each query's k + 1 best so far."""
    entries = found.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("e")).select(
        "query", F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score"))
    if met is not None:
        entries = entries.unionByName(met.drop("place"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return entries.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)


def _one_width(kinds: DataFrame, vectors: DataFrame, asked_ids: DataFrame, k: int) -> DataFrame:
    sample = _matrix(pa.array([r[0] for r in kinds.orderBy(F.xxhash64(F.col("ids")[0])).select("vector").limit(SAMPLE)
                               .collect()], pa.list_(pa.float64())))
    rotation = np.linalg.svd(sample / max(1.0, np.abs(sample).max()), full_matrices=sample.shape[0] < sample.shape[1])[2].T
    # one range sort by falling length, cut into blocks as it streams by; the numbers of blocks
    # rise in that order, and only the number of tasks depends on the table
    tasks = max(1, -(-kinds.count() // (BLOCK * TASK_BLOCKS)))
    size = BLOCK
    order = [F.col("norm").desc(), F.xxhash64(F.col("ids")[0])]
    blocks = cut(
        kinds.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("ids", "vector")
        .mapInArrow(lambda it: _blocks(it, size), "ids array<array<long>>, vectors binary, top double")
        .withColumn("block", F.monotonically_increasing_id()))
    queries = cut(
        vectors.join(asked_ids, "id").groupBy("vector").agg(F.min("id").alias("query"))
        .withColumn("crew", F.pmod(F.xxhash64("query"), F.lit(max(1, -(-asked_ids.count() // QUERY_BLOCK))))))

    def search(some_blocks: DataFrame, asking: DataFrame) -> DataFrame:
        # every query block against every vector block that its lengths can still reach: a
        # stated query set against all rows, in blocks; only the blocks' descriptions are paired
        length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
        reach = asking.groupBy("crew").agg(F.max(length).alias("longest"), F.min("floor").alias("lowest"))
        pairs = reach.join(some_blocks.select("block", "top"),
                           F.col("longest") * F.col("top") * (1 + 1e-9) + 1e-6 >= F.col("lowest")).select("crew", "block")
        crews = asking.groupBy("crew").applyInArrow(
            _asked, "crew long, queries array<long>, asked binary, floor array<double>")
        return pairs.join(crews, "crew").join(some_blocks, "block").select(
            "ids", "vectors", "queries", "asked", "floor").mapInArrow(
                lambda it: _pair_blocks(it, rotation, k), "query long, ids array<long>, scores array<long>")

    # rounds of falling length, each over three times as many blocks as all before it, so that
    # every query's k-th best is known early and later blocks tell little
    ends = [1, 4, 1 << TASK_BITS]
    while ends[-1] < tasks << TASK_BITS:
        ends.append(4 * ends[-1])
    done, met, last = 0, None, blocks.agg(F.max("block")).first()[0]
    for upto in ends:
        if done > last:
            break
        if met is None:
            asking = queries.withColumn("floor", F.lit(float("-inf")))
        else:
            asking = queries.join(met.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")), "query",
                                  "left").withColumn("floor", F.when(F.col("n") > k, F.col("least").cast("double")).otherwise(float("-inf"))
                                                     ).drop("least", "n")
        found = search(blocks.filter((F.col("block") >= done) & (F.col("block") < upto)), asking)
        met, done = cut(_best_entries(found, met, k)), upto
    lists = met.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    # back to every query id of that vector, without its own id
    asked = vectors.join(asked_ids, "id").join(queries.select("vector", "query"), "vector").select("id", "query")
    return (
        asked.join(lists, "query")
        .select("id", F.posexplode(F.slice(F.filter("list", lambda e: e["vec_id"] != F.col("id")), 1, k)).alias("pos", "e"))
        .select(F.col("id").alias("query_id"), (F.col("pos") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"),
                F.col("e.score").alias("score")))


def oracle(divisor: int = 50, k: int = 5) -> str:
    """DuckDB statement for the query: every product, no pruning."""
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
products AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(a.q, lambda x, i: x * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {divisor} = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM products)
WHERE place <= {k}
"""
