"""Near duplicates and repeated passages against brute force."""
import random

import numpy as np
from brute import MESSY, SF_DIR, longest_common, near_classes, removed_repeats
from pyspark.sql import functions as F

from perfwatch.llm import order_minhash, suffix_dedup


def digests(df):
    return [tuple(r) for r in df.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("gone"),
                                        F.size("span_starts"), F.sha2("kept", 256)).collect()]


def tangled(count=70):
    rng = random.Random(4)
    words = ["ab", "cd", "efg", "hä", "ij\0", "k"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(90)) for _ in range(3)]
    rows = []
    for i in range(count):
        text = rng.choice(base)
        if i % 3 == 0:
            chars = list(text)
            for _ in range(rng.randrange(6)):
                chars[rng.randrange(len(chars))] = "X"
            text = "".join(chars)
        if i % 5 == 0:
            text = " ".join(str(rng.random()) for _ in range(12)) + base[0][:rng.randrange(90, 200)] + str(rng.random())
        if i % 11 == 0:
            text = "Thor " * rng.randrange(10, 80)
        if i % 17 == 0:
            text = "a" * rng.randrange(80, 300)
        rows.append((i, None if i == 26 else text))
    return rows


def test_repeats_match_brute_force_on_every_path(spark):
    rows = tangled()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(removed_repeats(rows))
    # anchors gathered, all of them frequent in a task, all of them frequent overall
    for task_many, group_many in ((256, 20_000), (1, 20_000), (256, 2)):
        assert sorted(digests(suffix_dedup.drop_repeats(df, task_many=task_many, group_many=group_many))) == want


def test_repeats_in_messy_rows(spark, messy, no_documents):
    got = suffix_dedup.drop_repeats(messy, carry=("bucket", "size"))
    assert got.columns[:3] == ["doc_id", "bucket", "size"] and {r["bucket"] for r in got.collect()} == {"clash"}
    want = removed_repeats(list(dict.fromkeys(MESSY)))
    assert {r for r in digests(got)} == set(want) and got.count() == len(MESSY)
    assert suffix_dedup.drop_repeats(no_documents).count() == 0


def test_repeats_in_given_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(digests(suffix_dedup.drop_repeats(df))) == sorted(removed_repeats(rows))


def test_texts_longer_than_a_segment(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([data.tobytes()]), pa.array([0])],
                                       names=["doc", "key", "text", "bucket"])
    whole = [suffix_dedup.stretches(d, b) for d, b, _ in suffix_dedup._segments(batch)]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    pieces = [(suffix_dedup.stretches(d, b), p) for d, b, p in suffix_dedup._segments(batch)]
    assert sum(x[2].sum() for x in whole) == sum(x[0][2].sum() for x in pieces) == 5000 - suffix_dedup.MATCH + 1


def test_loser_tree_reads_nothing_twice():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(suffix_dedup.MATCH)) for _ in range(40)]
    strings += [s[:60] + strings[0][60:] for s in strings] * 2
    runs = [sorted(strings[i::5]) for i in range(5)] + [[]]

    def shared(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), suffix_dedup.MATCH)

    prefixes = [[0] + [shared(a, b) for a, b in zip(r[:-1], r[1:], strict=True)] if r else [] for r in runs]
    run, index, known = suffix_dedup.loser_tree_merge(runs, prefixes)
    merged = [runs[r][i] for r, i in zip(run, index, strict=True)]
    assert merged == sorted(strings)
    assert known == [0] + [shared(a, b) for a, b in zip(merged[:-1], merged[1:], strict=True)]


def test_front_coding_round_trip():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 3, (50, suffix_dedup.MATCH)).astype(np.uint8)
    text[10:20, :90] = text[9, :90]
    text[30] = text[29]
    assert (suffix_dedup._decode(*suffix_dedup._front_code(text)) == text).all()


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 30))]
        b = list(a)
        for _ in range(rng.randrange(6)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randrange(len(b) + 1), rng.randrange(6))
        if not b:
            continue
        want = longest_common(a, b) / max(len(a), len(b))
        got = order_minhash.aligned_similarity(np.array(a), np.array(b))
        assert abs(got - (want if want >= 0.8 - 1e-12 else 0.0)) < 1e-9


def edited(count=90):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(60, 160))] for _ in range(8)]
    shared = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(count):
        words = list(rng.choice(base)) if i % 3 else [rng.choice(vocabulary) for _ in range(70)] + shared
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    return rows


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    rows = edited()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = near_classes(rows)
    got = order_minhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(set(want.values()))
    monkeypatch.setattr(order_minhash, "BLOCK", 3)      # buckets in many blocks
    got = order_minhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_near_duplicates_messy(spark, messy, no_documents):
    got = order_minhash.near_duplicates(messy).collect()
    assert len(got) == len(MESSY)
    classes: dict = {}
    for r in got:
        classes.setdefault((r["class_id"], r["class_rows"]), []).append(r)
    for (_, size), members in classes.items():
        assert len(members) == size and sum(r["kept"] for r in members) == 1
    by_id = {r["doc_id"]: r["class_id"] for r in got}
    assert by_id[1] == 1 and by_id[8] == 8
    assert len({r["class_id"] for r in got if r["doc_id"] in (3, 4)}) == 1       # NULL text counts as empty
    assert order_minhash.near_duplicates(no_documents).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in order_minhash.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


def test_components_of_any_graph(spark):
    rng = random.Random(12)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 400 + i) for i in range(200)]
    edges = spark.createDataFrame(pairs + pairs[:50], "a long, b long")
    above = {x: x for pair in pairs if pair[0] != pair[1] for x in pair}
    for _ in above:
        for a, b in pairs:
            if a != b:
                above[a] = above[b] = min(above[a], above[b])
    assert sorted((r["node"], r["root"]) for r in order_minhash.components(edges).collect()) == sorted(above.items())


def test_rounds_of_few_edges_take_few_tasks(spark):
    """Every task that feeds a shuffle leaves three files: a round must not take the shuffle width again and again."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup("few-edges", "components")
        assert order_minhash.components(edges).count() == 61
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("few-edges")]
    stages = [tracker.getStageInfo(s) for s in {s for job in jobs for s in job.stageIds}]
    rounds = sum(s.name.startswith("first") for s in stages if s and s.numCompletedTasks) // 2
    tasks = sum(s.numCompletedTasks for s in stages if s)
    assert 0 < rounds and tasks <= rounds * 200 + 200
