"""Removal of repeated lines with levelled sorted runs of line hashes.

The index of seen lines is a set of runs.  A run is a bucketed table, sorted
by line hash within every bucket, one row per line key: in how many documents
it was found and the largest id among them.  Documents arrive in batches.  A
batch is counted by line key and merge-anti-joined with each run: what a run
has settled (found in enough documents, and in one of no smaller id) the batch
can't change, so it goes; the rest becomes a run of level 0.  Whenever a level
holds ``runs_per_level`` runs, they are merged into one of the next.

A line key is the line without blanks (space and \\x09-\\x0D) at its ends and
with A-Z in lower case; keys shorter than ``least_chars`` code points are
never dropped.  A key found in ``least_docs`` documents or more loses its
lines everywhere but in the document of the largest id.

Scale: texts are read twice and shuffled once, by id and text.  Everything
else carries hashes (128 bits a line).  Counting combines in the map tasks.
When the drops are looked up, the few keys that hold more than one in
``HOT_SHARE`` of all lines - at most ``HOT_SHARE`` keys - are broadcast; the
others are joined by hash.  Runs, lines and settled keys are tables in the
shared folder, so a lost executor repeats tasks of one step only.

Defined cases: a NULL or empty text is one empty line.  Rows without an id
count as one document, smaller than all others; rows that repeat an id are one
document as well, but each keeps its own row.  A line twice in a document
counts once, and stays or goes twice.  An empty table gives an empty result.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, ensure_checkpoint_dir, fanout

BATCHES = 6
RUNS_PER_LEVEL = 4
HOT_SHARE = 4096
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


@dataclass
class LineRuns:
    """The levelled index.  ``levels[k]`` names the runs of level k."""

    spark: SparkSession
    folder: str
    least_docs: int = 3
    runs_per_level: int = RUNS_PER_LEVEL
    buckets: int = 0   # 0: as many as the session shuffles to
    levels: list[list[str]] = field(default_factory=list)
    merges: int = 0

    def __post_init__(self):
        self.buckets = self.buckets or fanout(self.spark)

    def _write(self, entries: DataFrame, level: int) -> None:
        """``entries`` (h1, h2, docs, top), already dealt by key, as one sorted run."""
        name = f"line_run_{uuid.uuid4().hex}"
        (entries.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        newest = self.spark.table(names[0])
        if len(names) == 1:
            return newest
        # read as plain files: Spark 4.1 takes a union of bucketed tables for dealt by key, and groups it wrongly
        runs = self.spark.read.schema(newest.schema).parquet(*[f"{self.folder}/{name}" for name in names])
        return runs.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def add(self, batch: DataFrame) -> None:
        """Take in the lines (h1, h2, doc_id) of a batch.  A document's lines
        must come in one batch."""
        entries = batch.select(*KEY, "doc_id").distinct().groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top"))
        for names in self.levels:
            for name in names:
                run = self.spark.table(name).filter(F.col("docs") >= self.least_docs).select(
                    F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("top").alias("_top"))
                no_later = F.col("top").isNull() | (F.col("_top") >= F.col("top"))
                entries = entries.join(run.hint("merge"), (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")) & no_later,
                                       "left_anti")
        self._write(entries, 0)
        level = 0
        while len(self.levels[level]) >= self.runs_per_level:   # a full level becomes one run of the next
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            self._drop(full)
            self.merges, level = self.merges + 1, level + 1

    def settled(self) -> DataFrame:
        """(h1, h2, docs, top) of every key found in enough documents.
        ``docs`` counts no more than was needed to settle it."""
        names = [name for level in self.levels for name in level]
        return self._merged(names).filter(F.col("docs") >= self.least_docs)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Remove the runs."""
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def with_row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (NULL: empty) and a 128-bit key (t1, t2) of both: rows of equal key have equal results."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("t1"),
                       F.xxhash64(F.lit(1), F.col("doc_id").isNull(), "text", "doc_id").alias("t2"))


def line_hashes(rows: DataFrame, least_chars: int) -> DataFrame:
    """(t1, t2, doc_id, line, h1, h2): one row per line whose key is long
    enough, ``line`` counting from 0."""
    lines = rows.select("t1", "t2", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "_line"))
    bare = F.btrim(F.col("_line"), F.lit(BLANKS))
    key = F.translate(bare, UPPER, LOWER)
    return lines.filter(F.length(bare) >= least_chars).select(
        "t1", "t2", "doc_id", "line", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def dropped_lines(lines: DataFrame, settled: DataFrame) -> DataFrame:
    """(t1, t2, drops): the numbers of the lines whose key is settled, and not
    by their own document.  Keys that hold more than one in ``HOT_SHARE`` of
    the lines are looked up in a broadcast table, all others by hash."""
    total = lines.count()
    frequent = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HOT_SHARE > total).select(*KEY)
    hot = cut(frequent.join(settled, KEY, "left").select(*KEY, "top", F.col("docs").isNotNull().alias("_settled")))
    elsewhere = ~F.col("doc_id").eqNullSafe(F.col("top"))
    of_hot = lines.join(F.broadcast(hot.filter("_settled")), KEY).filter(elsewhere)
    of_others = lines.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(
        settled.hint("shuffle_hash"), KEY).filter(elsewhere)
    going = of_hot.select("t1", "t2", "line").unionAll(of_others.select("t1", "t2", "line"))
    return going.groupBy("t1", "t2").agg(F.collect_set("line").alias("drops"))


def drop_repeated_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20,
                        least_docs: int = 3, batches: int = BATCHES, runs_per_level: int = RUNS_PER_LEVEL) -> DataFrame:
    """Every row of ``df`` as doc_id, n_lines, n_dropped and ``kept``: the
    text without the lines that go.  The table is taken in as ``batches``
    batches, dealt by a hash of the id."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    rows = with_row_key(df, id_col, text_col)
    batch = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(batches)).cast("int")
    hashes = line_hashes(rows, least_chars).withColumn("batch", batch)
    hashes.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(hashes.schema).parquet(f"{folder}/lines")
    index = LineRuns(spark, f"{folder}/runs", least_docs, runs_per_level)
    for number in range(batches):
        index.add(lines.filter(F.col("batch") == number))
    found = index.settled()
    found.write.parquet(f"{folder}/settled")
    index.close()
    settled = spark.read.schema(found.schema).parquet(f"{folder}/settled")

    # one row per distinct row: a row that is repeated as a whole is combined in the map tasks
    distinct = rows.groupBy("t1", "t2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"),
                                            F.count(F.lit(1)).alias("_copies"))
    marked = distinct.join(dropped_lines(lines, settled).hint("merge"), ["t1", "t2"], "left").select(
        "doc_id", "_copies", F.split("text", "\n").alias("_lines"),
        F.coalesce("drops", F.array().cast("array<int>")).alias("_drops"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    return marked.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"), F.size("_drops").cast("long").alias("n_dropped"),
        F.array_join(F.transform(staying, lambda n: F.get(F.col("_lines"), n)), "\n").alias("kept"),
        F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copy")


def oracle(least_chars: int = 20, least_docs: int = 3) -> str:
    """DuckDB SQL of the same result, for ids that no two rows share."""
    blanks = " || ".join(["' '", *[f"chr({b})" for b in range(9, 14)]])
    return f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents),
keyed AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS k FROM lines),
settled AS (
    SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= {least_chars}
    GROUP BY k HAVING count(DISTINCT doc_id) >= {least_docs}),
marked AS (SELECT keyed.*, top IS NOT NULL AND doc_id <> top AS gone FROM keyed LEFT JOIN settled USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
