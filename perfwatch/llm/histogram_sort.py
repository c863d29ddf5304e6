"""Sharding by histogram sort.

Documents are ordered by (hash of the text, hash of the id, number of the row).
Splitters that cut the order into shards of near-equal bytes are found by counting: every
round sums, across all partitions, the exact bytes that lie below a grid of
candidate boundaries, and narrows each unmet splitter to one grid cell.  Once
all splitters meet the tolerance the rows are exchanged once.

Equal texts are neighbours in the order.  A boundary prefers to fall between
texts; only if one text alone is too heavy does it cut inside the group, by
the hash of the id, and only if one text and id alone are, between rows that
are alike in all of it.  Only DataFrame functions are used; the driver
receives at most ``shards * probes`` sums a round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm._common import cut

LEVELS = ("key", "sub", "row")      # a cell fixes the first few of them and is an interval of the next
DOMAINS = (1 << 60, 1 << 60, (1 << 63) - 1)
TASK_BITS = 33      # monotonically_increasing_id: the partition's number lies above these bits


def _grid(lo: int, hi: int, probes: int) -> list[int]:
    step = max(1, -(-(hi - lo) // probes))
    return list(range(lo, hi, step)) + [hi]


def _histogram(rows: DataFrame, open_cells: list[tuple[tuple[int, ...], int, int]], probes: int) -> dict:
    """Exact bytes between neighbouring probes of each open cell (fixed, lo, hi):
    the rows whose first levels equal ``fixed``, over an interval of the next."""
    which = F.lit(None).cast("long")
    for n, (fixed, lo, hi) in enumerate(open_cells):
        step = max(1, -(-(hi - lo) // probes))
        level = LEVELS[len(fixed)]
        inside = (F.col(level) >= F.lit(lo)) & (F.col(level) < F.lit(hi))
        for name, value in zip(LEVELS, fixed, strict=False):
            inside &= F.col(name) == F.lit(value)
        which = F.when(inside, F.expr(f"{n * (probes + 1)}L + ({level} - {lo}L) div {step}L")).otherwise(which)
    counted = rows.select(which.alias("cell"), "size").filter("cell IS NOT NULL").groupBy("cell").agg(
        F.sum("size").alias("bytes"))
    return {r["cell"]: r["bytes"] for r in counted.collect()}


def find_splitters(rows: DataFrame, shards: int, tolerance: float, probes: int) -> list[tuple[int, int, int]]:
    """``shards - 1`` boundaries (key, sub, row): a row lies right of a boundary
    if its (key, sub, row) is not smaller.  Among the equal rows of one text and
    id the boundary that is nearest to its goal is taken, not just one within
    the tolerance: how many lie left of it does not hang on their numbers."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    goals = [total * i / shards for i in range(1, shards)]
    found: dict[int, tuple[int, int, int]] = {}
    cells: dict[int, tuple[tuple[tuple[int, ...], int, int], int]] = {i: (((), 0, DOMAINS[0]), 0) for i in range(len(goals))}
    while cells:
        open_cells = sorted({c for c, _ in cells.values()}, key=lambda c: (len(c[0]), c))
        counts = _histogram(rows, open_cells, probes)
        narrowed = {}
        for i, (cell, below) in cells.items():
            fixed, lo, hi = cell
            grid, n = _grid(lo, hi, probes), open_cells.index(cell)
            at = below
            for j in range(len(grid) - 1):
                after = at + counts.get(n * (probes + 1) + j, 0)
                if after >= goals[i] or j == len(grid) - 2:
                    break
                at = after
            edge, gap = min(((grid[j], goals[i] - at), (grid[j + 1], after - goals[i])), key=lambda e: abs(e[1]))
            last, unit = len(fixed) == len(LEVELS) - 1, grid[j + 1] - grid[j] == 1
            if unit if last else abs(gap) <= slack:
                found[i] = (*fixed, edge, 0, 0)[:len(LEVELS)]
            elif unit:      # what this value holds is too heavy: go on inside it
                narrowed[i] = (((*fixed, grid[j]), 0, DOMAINS[len(fixed) + 1]), at)
            else:
                narrowed[i] = ((fixed, grid[j], grid[j + 1]), at)
        cells = narrowed
    return [found[i] for i in range(len(goals))]


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
                    tolerance: float = 0.001, probes: int = 64) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Sizes of shards are equal up to ``tolerance`` or to one row, whichever is
    coarser.  NULL text has size 1 and the checksum of no bytes, and groups
    with the empty text.  NULL ids and repeated rows are rows like others; a
    boundary may fall between identical rows too.  Slots follow the order of
    text and id, so equal texts are neighbours and slots do not depend on how
    the rows lay in files.  An empty table gives no rows.  Other columns are
    ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = cut(docs.select(
        F.col(id_col).alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(text), 4).alias("key"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(1)), 4).alias("sub"),
        F.monotonically_increasing_id().alias("row")))
    shard = F.lit(0)
    for splitter in find_splitters(rows, shards, tolerance, probes):
        right, same = F.lit(False), F.lit(True)
        for level, value in zip(LEVELS, splitter, strict=True):
            right |= same & (F.col(level) > F.lit(value))
            same &= F.col(level) == F.lit(value)
        shard = shard + (right | same).cast("int")
    # the one exchange of the rows; a sorted row's number holds its partition and its place there
    ordered = cut(
        rows.withColumn("shard", shard).repartitionByRange("shard", *LEVELS).sortWithinPartitions("shard", *LEVELS)
        .select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at"))
        .withColumn("part", F.shiftright("at", TASK_BITS)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
        .select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    )  # at most one row per shard and one per partition of the exchange
    return ordered.join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("at") + F.col("shift")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
