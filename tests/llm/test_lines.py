"""Repeated lines against a plain dictionary of lines."""
import hashlib
import random
import re
import time
from collections import defaultdict

from brute import MESSY, SF_DIR
from pyspark.sql import functions as F

from perfwatch.llm import line_runs, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least_chars=20, least_docs=3):
    """(id, lines, dropped, kept) of every row; a missing id is one document below all others."""
    def keys(text):
        return [re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(UPPER) for line in (text or "").split("\n")]

    docs = defaultdict(set)
    for doc, text in rows:
        for key in keys(text):
            docs[key].add(float("-inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        lines, own = (text or "").split("\n"), float("-inf") if doc is None else doc
        gone = [len(k) >= least_chars and len(docs[k]) >= least_docs and max(docs[k]) != own for k in keys(text)]
        out.append((doc, len(lines), sum(gone), "\n".join(line for line, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


def tangled(count=300):
    rng = random.Random(11)
    shared = [f"a line that many documents share, number {n}" for n in range(25)]
    odd = ["", " ", "\t\tshort", "ÄÖ line with A Ümlaut in it", "äÖ line with a Ümlaut in it", "x" * 19, "x" * 20, "\x0b  " + "y" * 20 + " \r"]
    rows = []
    for n in range(count):
        lines = [rng.choice([shared[int(rng.random() ** 3 * 25)], shared[0].upper(), "  " + shared[1] + "\r", rng.choice(odd),
                             f"a line of its own: {rng.random()}"]) for _ in range(rng.randrange(12))]
        rows.append((rng.choice([n, n, n, rng.randrange(40), None]), "\n".join(lines) if lines else None))
    return rows


def test_whole_table_matches_a_plain_dictionary(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_line_dedup(spark, SF_DIR).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in sorted(by_hand(rows))]


def test_tangled_rows_in_any_batches_and_levels(spark, monkeypatch):
    rows = tangled()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for batches, level, hot, least in ((1, 4, 4096, 3), (5, 2, 4096, 3), (3, 4, 3, 2)):   # hot 3: keys with a third of the lines
        monkeypatch.setattr(line_runs, "HOT_SHARE", hot)
        got = line_runs.drop_repeated_lines(df, batches=batches, runs_per_level=level, least_docs=least)
        assert rows_of(got) == by_hand(rows, least_docs=least)


def test_messy_rows_and_empty_table(spark, messy, no_documents):
    rows = MESSY + [(20 + n, "word " * 3000) for n in range(2)] + [(None, "a row without an id, yet again")] * 3
    more = spark.createDataFrame([(d, t) for d, t in rows[len(MESSY):]], "doc_id long, text string")
    got = line_runs.drop_repeated_lines(messy.select("doc_id", "text", "bucket", "row").unionByName(more, allowMissingColumns=True))
    assert rows_of(got) == by_hand(rows)
    assert line_runs.drop_repeated_lines(no_documents).count() == 0


def test_runs_merge_level_by_level_and_settled_keys_stay_out(spark, tmp_path):
    index = line_runs.LineRuns(spark, str(tmp_path), least_docs=2, runs_per_level=2, buckets=4)
    sizes = []
    for doc in (9, 8, 7, 6, 5):   # one document a batch, largest first: from the third on, the line is settled
        index.add(spark.createDataFrame([(1, 1, doc), (doc, doc, doc)], "h1 long, h2 long, doc_id long"))
        sizes.append([len(level) for level in index.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]] and index.merges == 3
    newest = spark.table(index.levels[0][0])
    assert [r["h1"] for r in newest.collect()] == [5]        # the settled key was anti-joined away
    assert [tuple(r) for r in index.settled().collect()] == [(1, 1, 2, 9)]
    plan = newest.join(spark.table(index.levels[2][0]).hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan   # runs are dealt and sorted already
    index.add(spark.createDataFrame([(1, 1, 30)], "h1 long, h2 long, doc_id long"))   # a larger id must come through
    assert index.settled().filter("h1 = 1").first()["top"] == 30
    index.close()
    assert not spark.catalog.listTables("default", "line_run_*")


def test_a_text_of_many_lines_takes_linear_time(spark):
    text = "\n".join(f"this line is in all three of them {n % 50_000}" for n in range(200_000))
    df = spark.createDataFrame([(1, text), (2, text), (3, text)], "doc_id long, text string")
    began = time.time()
    got = line_runs.drop_repeated_lines(df, batches=1).select("doc_id", "n_lines", "n_dropped", F.length("kept").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(1, 200_000, 200_000, 0), (2, 200_000, 200_000, 0), (3, 200_000, 0, len(text))]
    assert time.time() - began < 60
