"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public
vocabulary.  A text's likelihood under a language sums over all ways to cut
it into pieces: a forward pass over byte positions.  No piece spans white
space, so the sum factors over words and equal words are scored once per
task.  Piece probabilities are fitted by expectation maximisation on word
counts of a bounded sample of the labelled documents.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, sampled_by, slices

LONGEST_PIECE = 8          # bytes; a piece is then one 64-bit number
TRAIN_DOCUMENTS = 2000     # bound of the labelled sample, for each language
ROUNDS = 4                 # of expectation maximisation
FLOOR = 1e-8               # probability of a piece the sample never uses
CACHE_WORDS = 250_000
BATCH_BYTES = 1 << 19      # word bytes scored in one vectorised pass
UNDETERMINED = "und"
# what str.split takes for white space, for the words that are learned (regular expression of the JVM)
WHITE_SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
class Pieces:
    """The vocabulary's pieces of up to LONGEST_PIECE bytes; lookup by (number, length)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            found = sorted({p for p in (base64.b64decode(line.split()[0]) for line in lines if line.strip())
                            if len(p) <= LONGEST_PIECE})
        self.pieces = found
        self.tables = []
        for length in range(1, LONGEST_PIECE + 1):
            ids = np.array([i for i, p in enumerate(found) if len(p) == length], dtype=np.int64)
            keys = np.array([int.from_bytes(found[i], "little") for i in ids], dtype=np.uint64)
            self.tables.append(self._slots(keys, ids))

    @staticmethod
    def _slots(keys: np.ndarray, ids: np.ndarray):
        bits = 17
        slot_key = np.zeros(1 << bits, dtype=np.uint64)
        slot_id = np.full(1 << bits, -1, dtype=np.int32)
        reach = 1
        for key, piece in zip(keys.tolist(), ids.tolist(), strict=True):
            at, steps = ((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - bits), 1
            while slot_id[at] >= 0:
                at, steps = (at + 1) & ((1 << bits) - 1), steps + 1
            slot_key[at], slot_id[at], reach = key, piece, max(reach, steps)
        return slot_key, slot_id, reach, bits

    def __len__(self) -> int:
        return len(self.pieces)

    def find(self, numbers: np.ndarray, length: int) -> np.ndarray:
        """Piece ids of the numbers, -1 where there is no such piece."""
        slot_key, slot_id, reach, bits = self.tables[length - 1]
        at = ((numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
        out = np.where(slot_key[at] == numbers, slot_id[at], -1)
        for step in range(1, reach):
            near = (at + step) & ((1 << bits) - 1)
            out = np.where((out < 0) & (slot_key[near] == numbers), slot_id[near], out)
        return out


def lattice(words: list[bytes], pieces: Pieces):
    """Words of equal length as a byte matrix; per piece length, the piece ids ending at each position."""
    text = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1).astype(np.uint64)
    number = np.zeros_like(text)
    ends = []
    for length in range(1, min(LONGEST_PIECE, text.shape[1]) + 1):
        # little-endian number of the `length` bytes that start at each position
        number = number[:, :text.shape[1] - length + 1] | (text[:, length - 1:] << np.uint64(8 * (length - 1)))
        ends.append(pieces.find(number, length))
    return text.shape[1], ends


def forward(words: list[bytes], pieces: Pieces, prob: np.ndarray, scaled: bool = True):
    """Log-likelihoods (words x languages) of words of equal length.  ``prob``:
    (pieces + 1) x languages, the last row all zero for "no such piece"."""
    size, starts = lattice(words, pieces)
    alpha = [np.ones((len(words), prob.shape[1]))]
    log_scale = np.zeros((len(words), prob.shape[1]))
    for end in range(1, size + 1):
        now = 0.0
        for length in range(1, min(len(starts), end) + 1):
            now = now + alpha[-length] * prob[starts[length - 1][:, end - length]]
        alpha.append(now)
        if len(alpha) > LONGEST_PIECE:
            alpha.pop(0)
        if end % 8 == 0:
            top = np.maximum.reduce(alpha)
            alpha = [a / top for a in alpha]
            log_scale += np.log(top)
    return np.log(alpha[-1]) + log_scale


def by_length(words: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of equal length, cut into blocks of bounded size."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        size = len(words[order[at]])
        most, to = max(1, BATCH_BYTES // size), at
        while to < len(order) and to - at < most and len(words[order[to]]) == size:
            to += 1
        yield order[at:to], [words[i] for i in order[at:to]]
        at = to


def likelihoods(words: list[bytes], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), prob.shape[1]))
    for rows, block in by_length(words):
        out[rows] = forward(block, pieces, prob)
    return out


def expected_counts(words: list[bytes], weights: np.ndarray, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, over all segmentations, under one language."""
    total = np.zeros(len(pieces) + 1)
    column = prob[:, 0]
    for rows, block in by_length(words):
        size, starts = lattice(block, pieces)
        moves = [column[s] for s in starts]
        # logarithms of what reaches each position from the left and from the right; they are
        # taken relative to a neighbour, so that long words do not vanish
        left, right = np.zeros((size + 1, len(block))), np.zeros((size + 1, len(block)))
        for end in range(1, size + 1):
            near = left[end - 1]
            left[end] = near + np.log(sum(np.exp(left[end - k] - near) * moves[k - 1][:, end - k]
                                          for k in range(1, min(len(starts), end) + 1)))
        for at in range(size - 1, -1, -1):
            near = right[at + 1]
            right[at] = near + np.log(sum(np.exp(right[at + k] - near) * moves[k - 1][:, at]
                                          for k in range(1, min(len(starts), size - at) + 1)))
        for k in range(1, len(starts) + 1):
            used = np.exp(left[:size - k + 1] + right[k:] - left[size]) * moves[k - 1].T * weights[rows]
            # "no such piece" (-1) is the last place
            total += np.bincount(starts[k - 1].T.ravel() % len(total), weights=used.ravel(), minlength=len(total))
    return total[:-1]


def _word_bytes(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass")


def fit(labelled: DataFrame, vocabulary: str, text: Column, lang: Column, key: Column,
        train_documents: int = TRAIN_DOCUMENTS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities ((pieces + 1) x languages).

    The word counts of the sample stay in Spark; each round brings back one
    number per language and piece in use.
    """
    pieces = Pieces(vocabulary)
    sample = sampled_by(labelled.select(lang.alias("lang"), text.alias("text"), key.alias("key")), F.col("key"),
                        F.col("lang"), train_documents)
    counts = cut(
        sample.select("lang", F.explode(F.split("text", WHITE_SPACE)).alias("word")).filter("word <> ''")
        .groupBy("lang", "word").agg(F.count("*").alias("n")))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((len(pieces) + 1, 0))
    prob = np.full((len(pieces) + 1, len(langs)), 1.0 / len(pieces))
    prob[-1] = 0.0
    for _ in range(rounds):
        sent = counts.sparkSession.sparkContext.broadcast(prob)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, table = Pieces(vocabulary), sent.value
            for batch in batches:
                lang_of, words, n = (batch.column(i).to_pylist() for i in range(3))
                for g, name in enumerate(langs):
                    rows = [i for i, x in enumerate(lang_of) if x == name]
                    if rows:
                        used = expected_counts([_word_bytes(words[i]) for i in rows],
                                               np.array([n[i] for i in rows], dtype=float), own, table[:, [g]])
                        seen = np.flatnonzero(used)
                        yield pa.RecordBatch.from_pydict({
                            "g": pa.array(np.full(len(seen), g), pa.int32()), "piece": pa.array(seen, pa.int32()),
                            "used": pa.array(used[seen], pa.float64())})

        rows = counts.mapInArrow(expect, "g int, piece int, used double").groupBy("g", "piece").agg(
            F.sum("used").alias("used")).toPandas()
        sent.unpersist()
        used = np.zeros((len(pieces), len(langs)))
        used[rows["piece"], rows["g"]] = rows["used"]
        prob = np.zeros((len(pieces) + 1, len(langs)))
        prob[:-1] = np.maximum(used / used.sum(axis=0), FLOOR)
        prob[:-1] /= prob[:-1].sum(axis=0)
    return langs, prob


def predict(docs: DataFrame, langs: list[str], prob: np.ndarray, vocabulary: str, text_col: str,
            carry: tuple[str, ...]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(prob)
    names, kinds = [f"c{i}" for i in range(len(carry))], dict(docs.select(*carry).dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = Pieces(vocabulary), sent.value
        known: dict[str, int] = {}
        values = np.zeros((0, len(langs)))
        for batch in slices(batches):
            texts = batch.column(0).to_pylist()
            found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if len(known) > CACHE_WORDS:
                known, values = {}, values[:0]
            rows, words = [], []
            for i, text in enumerate(texts):
                if langs and text and any(map(str.isalpha, text)):   # numerals such as ½ or ② are no letters
                    split = text.split()
                    rows.append(i)
                    words.append(np.array([known.setdefault(w, len(known)) for w in split], dtype=np.int32))
            if rows:
                fresh = list(known)[len(values):]
                values = np.concatenate([values, likelihoods([_word_bytes(w) for w in fresh], pieces, table)])
                total = np.array([values[w].sum(axis=0) for w in words])
                best = total.argmax(axis=1)
                share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for i, b, s in zip(rows, best, share, strict=True):
                    found[i], scores[i] = langs[b], s
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string()), pa.array(scores)],
                                             names=[*names, "lang_pred", "score"])

    scored = docs.select(F.col(text_col).cast("string").alias("text"),
                         *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)]).mapInArrow(
        score, ", ".join([f"{n} {kinds[c]}" for c, n in zip(carry, names, strict=True)] + ["lang_pred string, score double"]))
    return scored.select(*[F.col(n).alias(c) for c, n in zip(carry, names, strict=True)], "lang_pred", "score")


def identify_language(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", vocabulary: str | None = None,
                      train_documents: int = TRAIN_DOCUMENTS, rounds: int = ROUNDS,
                      carry: tuple[str, ...] | None = None) -> DataFrame:
    """One row per input row: the id (or the ``carry`` columns), lang_pred,
    score (posterior of the predicted language).

    ``learn`` marks the rows whose text and language may be learned from; of
    these at most ``train_documents`` of each language (smallest id hashes)
    are used, so a rare language is learned like a common one.  NULL
    texts and texts without a letter, and all texts if nothing can be learned
    from, are ``und`` with score 0.  Equal likelihoods go to the first
    language in code point order.  Repeated rows are predicted each; an
    empty table gives no rows; other columns are ignored.
    """
    path = vocabulary or vocabulary_path()
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    labelled = docs.filter(learn & text.isNotNull() & lang.isNotNull())
    langs, prob = fit(labelled, path, text, lang, F.col(id_col), train_documents, rounds)
    return predict(docs, langs, prob, path, text_col, carry or (id_col,))
