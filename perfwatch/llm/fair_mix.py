"""Mixing sources to target weights by weighted fair queueing.

Every document of a shuffled source gets a virtual finish time: the tokens
of its source up to and including it, divided by the source's target.  All
entries are ordered by finish time and taken until the total budget is
spent, so each source advances in proportion to its target.  A document is
queued ``cap`` times, the later rounds after the whole source has passed.

Only DataFrame functions are used.  Both orders, the one inside the sources
and the one by finish time, are range sorts whose last key numbers the rows,
so a source, an id or a finish time that many rows share is cut between tasks
like anything else.  Running sums come from the sums of whole ranges and a
window inside each range.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm._common import cut

WORD = r"[^\x20\x09-\x0D]+"
TASK_BITS = 33      # monotonically_increasing_id: the partition's number lies above these bits


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """One row per source (``src``, ``source``, ``source_size``) plus its ``target``.

    The budget ``share * total`` is divided by weight; a target stops at
    ``cap`` times its source, and the level at which the rest fills up is
    found in closed form: sources ordered by cap per weight, the largest
    consistent level.  One row per source, so one small window.
    """
    everything = Window.partitionBy()
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("reach", "src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(by_code_point) - 1) % len(weights) + 1)
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("reach", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("most_before", F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weight_left", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.coalesce("most_before", F.lit(0.0))) / F.col("weight_left"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("reach"), F.col("level"))).over(everything))
    )
    return ranked.select("src", "source", "source_size", "budget", F.least(
        F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def _range_sort(rows: DataFrame, number: str, order: list[str]) -> DataFrame:
    """``rows`` after one range sort: ``number`` grows along the order, ``part`` is a row's range."""
    return cut(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(number, F.monotonically_increasing_id()).withColumn("part", F.shiftright(number, TASK_BITS)))


def _passed(ordered: DataFrame) -> DataFrame:
    """One row per range: ``passed``, the sizes in all ranges before it, and ``part_size``, those in it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered.groupBy("part").agg(F.sum("size").alias("part_size")).withColumn(
        "passed", F.coalesce(F.sum("part_size").over(before), F.lit(0)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "42") -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken,
    text_key (hash of the text).

    * NULL text has size 0; NULL source is a source of its own, last in order;
      NULL id is shuffled as the empty id.
    * A document of size 0 takes nothing; an empty table gives no rows.
    * Repeated rows are separate entries, next to each other in the order.
    * Ties in finish time go by source, shuffle key, id, size and round.
    * Other columns of the input are ignored, whatever their names.
    """
    base = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("text_key"),
    ).select("*", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"),
             F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
             .alias("draw"), F.monotonically_increasing_id().alias("row")))

    sizes = base.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    earlier = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sizes, weights, share, cap).drop("source").withColumn(
        "sources_before", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))

    # shuffled sources, one behind the other; rows alike in all but their number change nothing by their order
    queued = _range_sort(base, "place", ["src", "draw", "doc_id", "size", "text_key", "row"])
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    served = cut(
        queued.withColumn("upto", F.sum("size").over(inside))
        .join(F.broadcast(_passed(queued)), "part")     # one row per range
        .join(targets, "src")
        .select("doc_id", "source", "size", "source_size", "target", "budget", "place", "text_key",
                (F.col("passed") + F.col("upto") - F.col("sources_before")).alias("served"))
    )

    def key(turn: Column) -> list[Column]:
        """An entry's place in the queue: finish time, then the place of its row, then the round."""
        finish = F.try_divide((F.col("served") + turn * F.col("source_size")).cast("double"), F.col("target"))
        return [finish.alias("time"), F.col("place"), turn.cast("int").alias("turn")]

    entries = (
        served.filter(F.col("size") > 0).withColumn("turn", F.explode(F.array(*[F.lit(t) for t in range(cap)])))
        .select(*key(F.col("turn")), "size", "budget")
    )
    queue = _range_sort(entries, "at", ["time", "place", "turn"])
    # the range in which the budget ends, and in it the first entry that is not paid for any more
    budget = queue.agg(F.max("budget")).first()[0]
    edge = None if budget is None else (
        _passed(queue).filter(F.col("passed") + F.col("part_size") > budget).orderBy("part").limit(1).first())
    if edge is None:
        taken = F.col("size") * cap
    else:
        through = F.lit(edge["passed"]) + F.sum("size").over(Window.partitionBy("part").orderBy("at").rowsBetween(
            Window.unboundedPreceding, 0))
        first_out = (
            queue.filter(F.col("part") == edge["part"]).withColumn("through", through)
            .filter(F.col("through") > budget).orderBy("at").limit(1).first()
        )
        end = F.struct(F.lit(first_out["time"]).alias("time"), F.lit(first_out["place"]).cast("long").alias("place"),
                       F.lit(first_out["turn"]).cast("int").alias("turn"))
        admitted = [(F.struct(*key(F.lit(turn))) < end) & (F.col("size") > 0) for turn in range(cap)]
        taken = F.col("size") * sum(F.coalesce(a, F.lit(False)).cast("long") for a in admitted)
    return served.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                         "text_key")


def oracle(weights=(3, 1, 2), share=1.5, cap=2, seed="42") -> str:
    """DuckDB statement for the query's columns: plain running sums, no cells or bins."""
    choice = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {choice} END AS weight FROM sizes),
level0 AS (
  SELECT *, source_size * {float(cap)} AS most, source_size * {float(cap)} / weight AS reach,
         (SELECT sum(source_size) FROM sizes) * {share} AS budget FROM ranked),
level1 AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY reach, source NULLS FIRST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY reach, source NULLS FIRST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM level0),
targets AS (
  SELECT source, source_size, budget,
         least(most, coalesce((SELECT max(level) FROM level1 WHERE level <= reach) * weight, most)) AS target FROM level1),
served AS (
  SELECT b.doc_id, b.source, b.draw, b.size, t.source_size, t.target, t.budget,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.draw, b.doc_id, b.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS served
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, CAST(served + turn * source_size AS DOUBLE) / target AS finish
  FROM served, (SELECT unnest(range({cap})) AS turn) WHERE size > 0),
passed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, coalesce('=' || source, ''), draw, doc_id, size, turn) AS through
  FROM entries),
won AS (
  SELECT doc_id, source, draw, size, served, CAST(sum(size) AS BIGINT) AS taken
  FROM passed WHERE through <= budget GROUP BY ALL)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, s.source_size, s.target, coalesce(w.taken, 0) AS taken
FROM served s LEFT JOIN won w ON s.doc_id IS NOT DISTINCT FROM w.doc_id AND s.draw = w.draw AND s.size = w.size
  AND s.served = w.served AND s.source IS NOT DISTINCT FROM w.source
"""
