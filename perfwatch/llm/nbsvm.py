"""Quality classifier: Naive Bayes support vectors.

A text is the set of its n-grams (indicators, not counts): byte n-grams of one
to three bytes, and n-grams of the signal "this word equals the one before".
Each indicator is scaled by the log ratio of its class counts; a linear
hinge-loss model is then fitted by dual coordinate descent.  Decision values
become probabilities by a logistic fit on values from cross-validation.

The model is fitted on a bounded sample of the labelled rows; every whole
text is scored in one pass, without a shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import sampled, slices
from perfwatch.llm.order_minhash import chunks, word_hashes

TRAIN_DOCUMENTS = 8000    # bound of the labelled sample
TRIPLES = 1 << 17         # hash places of the three-byte n-grams
REPEATS = 5               # longest n-gram of the repetition signal
PAIRS_AT = 256
TRIPLES_AT = PAIRS_AT + (1 << 16)
REPEATS_AT = TRIPLES_AT + TRIPLES
FEATURES = REPEATS_AT + (2 << REPEATS)
PENALTY = 1.0
EPOCHS = 12
FOLDS = 3


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted indicator numbers of each of the texts laid end to end."""
    words, first = word_hashes(data, bounds)
    same = np.zeros(len(words), dtype=np.int64)
    same[1:] = words[1:] == words[:-1]
    wide = data.astype(np.int64)
    pairs = PAIRS_AT + (wide[:-1] << 8 | wide[1:]) if len(data) > 1 else wide[:0]
    triple = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) if len(data) > 2 else wide[:0]
    triples = TRIPLES_AT + ((triple.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 17)).astype(np.int64)
    present = np.zeros(FEATURES, dtype=bool)
    for text in range(len(bounds) - 1):
        a, b = bounds[text], bounds[text + 1]
        present[wide[a:b]] = True
        present[pairs[a:max(a, b - 1)]] = True
        present[triples[a:max(a, b - 2)]] = True
        signal = same[first[text]:first[text + 1]].copy()
        signal[:1] = 0
        gram = np.zeros(len(signal), dtype=np.int64)
        for n in range(1, REPEATS + 1):
            gram = gram[:len(signal) - n + 1] << 1 | signal[n - 1:] if len(signal) >= n else gram[:0]
            present[REPEATS_AT + (1 << n) + gram] = True
        found = np.flatnonzero(present)
        present[found] = False
        yield found


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.ones(FEATURES), np.ones(FEATURES)]
    for row, label in zip(rows, labels, strict=True):
        counts[int(label)][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def hinge_fit(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, epochs: int = EPOCHS,
              seed: int = 3) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss on unit-length rows; the
    classes weigh the same.  Returns weights by feature (ratio included) and bias."""
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.array([max(1, (labels <= 0).sum()), max(1, (labels > 0).sum())])
    most = PENALTY * len(labels) / (2.0 * share)
    values = [ratios[r] for r in rows]
    values = [v / (np.sqrt(v @ v) or 1.0) for v in values]
    weights, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            row, value = rows[i], values[i]
            slope = sign[i] * (weights[row] @ value + bias) - 1.0
            new = min(max(alpha[i] - slope / 2.0, 0.0), most[int(sign[i] > 0)])   # the row and the bias: length 2
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[row] += step * value
                bias += step
                alpha[i] = new
    return weights * ratios, bias


def decisions(rows, weights: np.ndarray, bias: float, ratios: np.ndarray) -> np.ndarray:
    squares = ratios ** 2
    return np.array([weights[r].sum() / (np.sqrt(squares[r].sum()) or 1.0) + bias for r in rows])


def logistic_fit(values: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Slopes and offset of P(label = 1 | values), by Newton steps on smoothed targets."""
    x = np.column_stack([values, np.ones(len(labels))])
    ones, zeros = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (ones + 1.0) / (ones + 2.0), 1.0 / (zeros + 2.0))
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(x.shape[1]),
                               x.T @ (p - target) + 1e-3 * weights)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights[:-1], float(weights[-1])


class Model:
    def __init__(self, rows: list[np.ndarray], labels: np.ndarray):
        self.ratios = log_count_ratios(rows, labels)
        self.weights, self.bias = hinge_fit(rows, labels, self.ratios)
        fold = np.random.default_rng(11).integers(0, FOLDS, len(rows))
        values = np.zeros(len(rows))
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            part = [rows[i] for i in inside]
            ratios = log_count_ratios(part, labels[inside])
            weights, bias = hinge_fit(part, labels[inside], ratios)
            values[outside] = decisions([rows[i] for i in outside], weights, bias, ratios)
        self.slope, self.offset = logistic_fit(values, labels)

    def scores(self, rows) -> np.ndarray:
        value = self.slope[0] * decisions(rows, self.weights, self.bias, self.ratios) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(value, -35, 35)))


def labelled_sample(labels: DataFrame, learn: Column, id_col: str, label_col: str, limit: int) -> DataFrame:
    """(id, label) of at most ``limit`` labelled ids: small enough to be sent to every task."""
    label = F.col(label_col).cast("int")
    known = labels.filter(learn & F.col(id_col).isNotNull() & label.isin(0, 1))
    return sampled(known, F.col(id_col), limit).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(label).alias("label"))


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str, id_col: str, text_col: str,
        train_documents: int) -> Model | None:
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for a, b, data, bounds in chunks(batch.column(1).to_pylist()):
                found = [f.astype("<i4").tobytes() for f in features(data, bounds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                                                  pa.array(found, pa.binary())], names=["doc_id", "label", "features"])

    sample = labelled_sample(labels, learn, id_col, label_col, train_documents)
    table = _plain(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label").mapInArrow(
        rows_of, "doc_id long, label int, features binary").toArrow()
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    answers = table.column("label").to_numpy()[order].astype(np.int64)
    if len(np.unique(answers)) < 2:
        return None
    bodies = table.column("features")
    return Model([np.frombuffer(bodies[i].as_py(), "<i4") for i in order.tolist()], answers)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """One row per input row: doc_id and score, the probability of label 1.

    ``learn`` marks the label rows that may be learned from; at most
    ``train_documents`` of them (smallest id hashes) are used.  NULL text
    counts as empty and, like it, gets the score of no n-gram at all.  NULL or
    other labels than 0 and 1 are not learned from, of labels that repeat an
    id the greatest counts; without both labels every score is 0.5.  Repeated
    rows are scored each; an empty table gives no rows; other columns are
    ignored.
    """
    model = fit(docs, labels, learn, label_col, id_col, text_col, train_documents)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in slices(batches):
            for a, b, data, bounds in chunks(batch.column(1).to_pylist()):
                values = own.scores(features(data, bounds)) if own else np.full(b - a, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(values)],
                                                 names=["doc_id", "score"])

    return _plain(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
