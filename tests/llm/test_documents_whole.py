"""Packing, sharding and mixing: what goes in comes out, on messy and on given tables."""
import struct
import zlib

import duckdb
import numpy as np
import pytest
from brute import SF_DIR

from perfwatch.llm import fair_mix, histogram_sort, packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.vocabulary_path())
    found.encode_special_tokens = True
    return found


def check_pieces(pieces, docs, tokenizer, window):
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    want: dict = {}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault((doc, len(ids)), []).append(struct.pack(f"<{len(ids)}I", *ids))
    assert set(by_doc) == set(want)
    for key, bodies in want.items():
        got = sorted((p["start"], bytes(p["ids"])) for p in by_doc[key])
        covered = sum(len(ids) for _, ids in got)
        assert covered == sum(len(b) for b in bodies)
        for start, ids in got:
            assert any(b[4 * start:4 * start + len(ids)] == ids for b in bodies)
        assert all(p["length"] * 4 == len(p["ids"]) for p in by_doc[key])
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return [sum(n for _, n in parts) for parts in sequences.values()]


def test_packing_messy(spark, messy, no_documents, tokenizer):
    for window, open_windows in ((16, 2), (64, 3), (2048, 32)):
        pieces = packing.pack_documents(messy, window=window, open_windows=open_windows).collect()
        fill = check_pieces(pieces, [(r["doc_id"], r["text"]) for r in messy.collect()], tokenizer, window)
        assert max(fill) <= window
    assert packing.pack_documents(no_documents).count() == 0


def test_packing_given(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.pack_documents(docs).collect()
    fill = check_pieces(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, packing.WINDOW)
    assert sum(fill) / (len(fill) * packing.WINDOW) > 0.97
    row = queries.op1_packing(spark, SF_DIR).first()
    assert row["ids_crc32"] >= 0


def test_cached_stretches_give_the_same_ids(tokenizer):
    ids_of = packing.TokenIds(packing.vocabulary_path(), 50)
    texts = ["a b", " a", "a ", "a  b", "a\n b", "it's I'll", "x y z", "été ß", "a " * 200, "\t\ta b\r\n",
             "1 22 333", "<|endoftext|> a", "\U0001f600 smile \U0001f600", "a\u0085 b", "a 　b"]
    for text in texts * 2:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == struct.pack(f"<{len(ids)}I", *ids), text


def check_shards(rows, docs, shards, slack):
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (d is not None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    sums = [0] * shards
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
        sums[s] = sum(r["size"] for r in rows if r["shard"] == s)
    assert max(sums) - min(sums) <= slack
    assert {r["law"] for r in rows} <= {"bytes"} and all(r["grown_shard"] is None for r in rows)


def test_sharding(spark, messy, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in messy.collect()]
    rows = histogram_sort.shard_documents(messy, shards=3, probes=4).collect()
    check_shards(rows, docs, 3, 2 * max(len((t or "").encode()) + 1 for _, t in docs))
    assert histogram_sort.shard_documents(no_documents).count() == 0
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in given.collect()]
    check_shards(histogram_sort.shard_documents(given).collect(), docs, 8, 2 * max(len(t.encode()) + 1 for _, t in docs))


def test_one_heavy_text_is_cut_and_others_stay_whole(spark):
    texts = ["same text " * 5] * 60 + [f"text {i % 20} " * 4 for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = histogram_sort.shard_documents(df, shards=4, tolerance=0.2, probes=8).collect()
    check_shards(rows, list(enumerate(texts)), 4, 600)
    assert len({r["shard"] for r in rows if r["doc_id"] < 60}) > 1
    small: dict = {}
    for r in rows:
        if r["doc_id"] >= 60:
            small.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(shards) == 1 for shards in small.values())      # light texts stay whole


@pytest.mark.parametrize("doc_id", [7, None])
def test_a_repeated_row_is_cut_alike_on_any_partitioning(spark, doc_id):
    docs = [(doc_id, "one row over and over " * 4)] * 400 + [(1000 + i, f"text {i % 150} " * 9) for i in range(600)]
    sizes = [len(t) + 1 for _, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    results = []
    for parts in (1, 4, 16):
        rows = histogram_sort.shard_documents(df.repartition(parts), probes=16).collect()
        check_shards(rows, docs, 8, 2 * max(sizes) + 0.002 * sum(sizes) / 8)
        results.append(sorted((r["shard"], r["slot"], r["doc_id"] or 0, r["text_crc32"]) for r in rows))
    assert results[0] == results[1] == results[2]
    texts = [r[3] for r in results[0]]
    assert sum(a != b for a, b in zip(texts, texts[1:], strict=False)) == len(set(texts)) - 1    # equal texts are neighbours


def oracle_rows(docs):
    con = duckdb.connect()
    con.register("documents", docs)
    return con.sql(fair_mix.oracle()).fetchall()


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_mixing_matches_sql(spark, messy, no_documents):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for df in (messy, given):
        got = [tuple(r) for r in fair_mix.mix_sources(df).select(*columns).collect()]
        assert order(got) == order(oracle_rows(df.select("doc_id", "text", "source").toArrow()))
    assert fair_mix.mix_sources(no_documents).count() == 0


def test_mixing_cuts_one_hot_id_between_ranges(spark):
    """A third of all rows without an id and with one text, another third of one id: several
    ranges share them, and the result is the plain running sums' whatever the partitions."""
    rows = [(None, "hot words here", "a")] * 700 + [(7, "w " * 5, "a")] * 700 + [
        (i, "w " * (1 + i % 9), "abc"[i % 3]) for i in range(100, 800)]
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = order(oracle_rows(docs.toArrow()))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # small ranges would be put together again
    try:
        for partitions in (1, 5):
            got = fair_mix.mix_sources(docs.repartition(partitions)).select(*columns).collect()
            assert order([tuple(r) for r in got]) == wanted
        sizes = docs.selectExpr("'a' AS src", "doc_id", "1L AS size", "monotonically_increasing_id() AS row")
        ranges = fair_mix._range_sort(sizes, "place", ["src", "doc_id", "size", "row"]).groupBy("part").count().collect()
        assert len(ranges) > 4 and max(r["count"] for r in ranges) < 700
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_targets_and_limits(spark):
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate([None, "b", "a", "a", "b", "c", "c", "c", "c"] * 40)]
    got = fair_mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes: dict = {}
    for r in got:
        sizes[r["source"]] = r["source_size"]
    # water filling by repeated resharing
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    for s in names:
        mine = [r for r in got if r["source"] == s]
        assert np.allclose([r["target"] for r in mine], target[s])
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 7
        assert all(r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in mine)
