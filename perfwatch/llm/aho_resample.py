"""Importance resampling towards a target distribution, with an Aho-Corasick dictionary.

A text's features are all runs of 1 to ``ngram`` consecutive words, joined by
one space; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``buckets``.  The automaton holds frequent words, each between two delimiters,
with the word's CRC and byte length as payload.  Every delimiter of a text
becomes a blank, so a scan emits one payload for each occurrence of a held
word, and nothing else.  A run's CRC is composed of the payloads of its words
(the CRC of a concatenation is the first CRC, shifted by the second's length,
plus the second), so no feature is ever spelt out.

The dictionary is bounded (``DICTIONARY_WORDS`` words of at most ``WORD_BYTES``
bytes, the most frequent of ``SAMPLE_TEXTS`` texts of either table).  It only
decides how a word gets its payload: words it lacks lie in the gaps between
two matches, and theirs is computed on the spot.  Every word of every text is
counted and scored.

Counting and scoring are one pass each, without a shuffle of texts.  What
travels are counts per bucket and, to the driver, one number per bucket.  The
draw finds the score of the last drawn document by counting scores, then
range-sorts the documents at or above it; a range may be cut inside equal rows.

Defined cases: a NULL or empty text has no feature (weight 0, never drawn
unless ``least_words`` is 0).  A NULL id hashes as the empty text and sorts
before all others.  Rows that repeat an id are documents of their own, with
equal noise; equal rows get consecutive ranks.  An empty raw table gives an
empty result; an empty target gives gains of the raw counts alone.  Words of
any length are whole; texts are scanned in pieces cut at blanks.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, fanout, sampled, slices

DICTIONARY_WORDS = 131_072
WORD_BYTES = 64
SAMPLE_TEXTS = 10_000
PIECE = 1 << 20   # bytes scanned at once

# digits, letters and every byte above ASCII belong to words; A-Z fold to a-z; all else is a delimiter
FOLD = bytes(b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
BLANK_CRC = zlib.crc32(b" ")


def _zero_steps() -> np.ndarray:
    """Tables [k, byte, value] that append 2**k zero bytes to a CRC register."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> 1), step >> 1)
    tables = np.zeros((40, 4, 256), dtype=np.uint32)
    for byte in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        tables[0, byte] = (value >> 8) ^ step[value & 255]
    for k in range(1, len(tables)):
        tables[k] = _apply(tables[k - 1], tables[k - 1])
    return tables


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


STEPS = _zero_steps()


def concat_crc(first: np.ndarray, second: np.ndarray, second_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation, from the CRCs of both parts and the second's length."""
    out, left, k = first.copy(), second_bytes.copy(), 0
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = _apply(STEPS[k], out[odd])
        left >>= 1
        k += 1
    return out ^ second


class Scanner:
    """The automaton over ``words`` (UTF-8 bytes) and its payload columns."""

    def __init__(self, words: list[bytes]):
        self.crcs = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        for n, word in enumerate(words):   # one character per byte
            self.automaton.add_word(f" {word.decode('latin-1')} ", n)
        if words:
            self.automaton.make_automaton()

    def _piece(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(crc, size) of every word of ``piece``, in order."""
        padded = f" {piece.decode('latin-1')} "
        found = (np.fromiter(chain.from_iterable(self.automaton.iter(padded)), dtype=np.int64)
                 if len(self.sizes) else np.zeros(0, np.int64))
        ends, ids = found[0::2], found[1::2]
        crcs, sizes = self.crcs[ids], self.sizes[ids]
        # a word the dictionary lacks lies between a match's closing blank and the next one's opening blank
        closing = np.concatenate(([0], ends))
        opening = np.concatenate((ends - sizes - 1, [len(padded) - 1]))
        at, more = [], []
        for gap in np.flatnonzero(opening > closing + 1).tolist():
            for word in padded[closing[gap] + 1:opening[gap]].split(" "):
                if word:
                    at.append(gap)
                    more.append(word.encode("latin-1"))
        if more:
            crcs = np.insert(crcs, at, np.array([zlib.crc32(w) for w in more], dtype=np.uint32))
            sizes = np.insert(sizes, at, np.array([len(w) for w in more], dtype=np.int64))
        return crcs, sizes

    def words(self, text: bytes | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Payloads of the words of ``text``, piece by piece."""
        folded, at = (text or b"").translate(FOLD), 0
        while at < len(folded):
            end = at + PIECE
            if end < len(folded):
                blank = folded.find(b" ", end)
                end = len(folded) if blank < 0 else blank
            yield self._piece(folded[at:end])
            at = end

    def features(self, text: bytes | None, ngram: int) -> Iterator[tuple[int, np.ndarray]]:
        """Per piece: its number of words and the CRCs of the runs that end in it."""
        crcs, sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for piece_crcs, piece_sizes in self.words(text):
            if ngram == 1:
                yield len(piece_crcs), piece_crcs
                continue
            kept = len(crcs)
            crcs, sizes = np.concatenate((crcs, piece_crcs)), np.concatenate((sizes, piece_sizes))
            runs, run = [piece_crcs], crcs
            for n in range(2, min(ngram, len(crcs)) + 1):   # runs of n words: those of n - 1, a blank, one word more
                run = concat_crc(run[:-1], np.full(len(run) - 1, BLANK_CRC, np.uint32), np.ones(len(run) - 1, np.int64))
                run = concat_crc(run, crcs[n - 1:], sizes[n - 1:])
                runs.append(run[max(0, kept - n + 1):])   # the others ended in an earlier piece
            yield len(piece_crcs), np.concatenate(runs)
            crcs, sizes = crcs[len(crcs) - min(len(crcs), ngram - 1):], sizes[len(sizes) - min(len(sizes), ngram - 1):]


_built: dict[int, Scanner] = {}


def _scanner(words: list[bytes], key: int) -> Scanner:
    """The scanner of a dictionary, built once per worker."""
    if key not in _built:
        _built.clear()
        _built[key] = Scanner(words)
    return _built[key]


def _text_bytes(df: DataFrame, text_col: str):
    return F.col(text_col).cast("binary").alias("_text")


def dictionary(frames: list[DataFrame], text_col: str, limit: int = DICTIONARY_WORDS, texts: int = SAMPLE_TEXTS) -> list[bytes]:
    """The most frequent words of a bounded number of texts of each frame: at
    most ``limit``, sorted.  Words are counted on the executors; the count
    that at most ``limit`` words reach is found by counting counts."""
    def count(batches):
        for part in slices(batches):
            found = Counter()
            for text in part.column(0).to_pylist():
                found.update(w for w in (text or b"").translate(FOLD).split(b" ") if 0 < len(w) <= WORD_BYTES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    chosen = [sampled(f.select(_text_bytes(f, text_col)), F.col("_text"), texts) for f in frames]
    words = chosen[0]
    for other in chosen[1:]:
        words = words.unionAll(other)
    counted = cut(words.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    least, held = None, 0
    for row in counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if held + row["words"] > limit:
            break
        least, held = row["n"], held + row["words"]
    if least is None:
        return []
    return sorted(bytes(r["word"]) for r in counted.filter(F.col("n") >= least).select("word").toLocalIterator())


def bucket_counts(df: DataFrame, text_col: str, words: list[bytes], ngram: int, buckets: int) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    key = hash(tuple(words))

    def count(batches):
        scanner, total = _scanner(words, key), np.zeros(buckets, np.int64)
        for part in slices(batches, 256):
            found = [crcs for text in part.column(0).to_pylist() for _, crcs in scanner.features(text, ngram)]
            if found:
                total += np.bincount(np.concatenate(found) % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return df.select(_text_bytes(df, text_col)).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def _whole(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():   # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the raw table), per bucket."""
    buckets, raw_all, target_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (raw_all + buckets) / ((float(s) + 1) * (target_all + buckets))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def weigh(df: DataFrame, text_col: str, words: list[bytes], gains: np.ndarray, ngram: int, carry) -> DataFrame:
    """``carry``, n_words, n_features and weight (the floored mean gain) of every row."""
    key, carry = hash(tuple(words)), list(carry)

    def score(batches):
        scanner = _scanner(words, key)
        for part in slices(batches):
            counts = np.zeros((3, part.num_rows), np.int64)
            for row, text in enumerate(part.column(0).to_pylist()):
                for n_words, crcs in scanner.features(text, ngram):
                    counts[:, row] += (n_words, len(crcs), gains[crcs % len(gains)].sum())
            n_words, features, total = counts
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], *[pa.array(c, pa.int64()) for c in (n_words, features, weight)]],
                names=[*carry, "n_words", "n_features", "weight"])

    staged = df.select(_text_bytes(df, text_col), *carry)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema.fields[1:]],
                        "n_words long, n_features long, weight long"])
    return staged.mapInArrow(score, schema)


def draw(scored: DataFrame, id_col: str, count: int) -> DataFrame:
    """``scored`` (id, score, eligible) with the ranks 1 to ``count`` of the
    highest scores among the eligible, ties to smaller ids; NULL elsewhere.

    ``scored`` must be a cut frame.  Scores are whole numbers of a bounded
    range, so counting them finds the last drawn score.  Rows at or above it
    are sorted by range; a row's place is its range's offset plus its index."""
    last, above = None, 0
    for row in scored.filter("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("score")).toLocalIterator():
        if above >= count:
            break
        last, above = row["score"], above + row["n"]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    reaching = F.col("eligible") & (F.col("score") >= last)
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_first(), F.col("_row")]   # _row: equal rows may be cut
    ranged = cut(scored.filter(reaching).withColumn("_row", F.monotonically_increasing_id())
                 .repartitionByRange(fanout(scored.sparkSession), *order).sortWithinPartitions(*order))
    placed = ranged.withColumn("_at", F.monotonically_increasing_id()).withColumns(
        {"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    offsets = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(   # one row per range
        F.col("_range").alias("_of"),
        (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_at") + 1
    drawn = placed.join(F.broadcast(offsets), F.col("_range") == F.col("_of")).withColumn(
        "rank", F.when(rank <= count, rank)).select(*scored.columns, "rank")
    return drawn.unionAll(scored.filter(~reaching).withColumn("rank", F.lit(None).cast("long")))


def resample(raw: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             ngram: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
             dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """Every document of ``raw`` with its weight towards ``target``, its noisy
    score and, for the ``percent`` of the documents of at least
    ``least_words`` words that are drawn, its rank from 1."""
    raw = raw.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    target = target.select(F.col(target_col).alias("text"))
    words = dictionary([raw, target], "text", dictionary_words)
    gains = bucket_gains(_whole(bucket_counts(raw, "text", words, ngram, buckets), buckets),
                         _whole(bucket_counts(target, "text", words, ngram, buckets), buckets))
    weighed = weigh(raw, "text", words, gains, ngram, ["doc_id"])
    drawn_from = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(drawn_from.cast("binary"), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = cut(weighed.withColumns({
        "score": F.col("weight") + F.floor(-1000 * F.log(-F.log(share))),
        "eligible": F.col("n_words") >= least_words}))
    eligible = scored.filter("eligible").count()
    return draw(scored, "doc_id", percent * eligible // 100).drop("eligible")


def oracle(buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> str:
    """DuckDB SQL for single words.  CRC-32 is a fold over the bytes of each distinct word."""
    punctuation = "".join(f"\\x{{{b:02X}}}" for b in range(128) if FOLD[b] == 32)
    split = (f"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             f"'abcdefghijklmnopqrstuvwxyz'), '[{punctuation}]+'), lambda w: w <> '')")
    return f"""
WITH RECURSIVE steps(n, byte, r) AS (
    SELECT 0, i, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT n + 1, byte, CASE WHEN r & 1 = 1 THEN xor(3988292384, r >> 1) ELSE r >> 1 END FROM steps WHERE n < 8),
crc_table AS (SELECT list(r ORDER BY byte) AS entries FROM steps WHERE n = 8),
raw_words AS (SELECT doc_id, unnest({split}) AS w FROM documents),
target_words AS (SELECT unnest({split}) AS w FROM benchmark),
known AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM raw_words UNION SELECT w FROM target_words)),
hashed AS (
    SELECT w, xor(4294967295, list_reduce(
        list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % {buckets} AS bucket
    FROM known, crc_table),
s AS (SELECT bucket, count(*) AS n FROM raw_words JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target_words JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM raw_words)::DOUBLE AS all_s, (SELECT count(*) FROM target_words)::DOUBLE AS all_t),
gains AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (all_s + {buckets}) / ((s.n::DOUBLE + 1) * (all_t + {buckets}))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals),
weights AS (
    SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM raw_words JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
           floor({percent} * count(*) OVER () / 100) AS drawn
    FROM scored WHERE n_features >= {least_words})
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, (CASE WHEN place <= drawn THEN place END)::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
