"""Toxicity classifier: bidirectional gated recurrent network with attention pooling.

A word enters as a learned vector of its hash (word input) joined with learned
vectors of its byte trigrams (mean) and of its longer byte n-grams (sum), both
taken with marks for the word's ends (character inputs).  Windows of WINDOW
words that overlap by WINDOW - STRIDE cover every text whole.  Forward and
backward gated recurrent units read a window, attention weighs their states,
and a logistic unit scores the sum.  A document's probability comes from the
greatest and the mean logit of all its windows, by a logistic fit on documents
kept out of training.

Labels belong to documents, not windows: training picks of each document the
windows that look most toxic - first by class log odds, later by the network
itself - and of documents that are not toxic a random one besides.  The
network is trained in numpy on a bounded sample.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import slices
from perfwatch.llm.nbsvm import _plain, labelled_sample, logistic_fit
from perfwatch.llm.order_minhash import chunks, hashed_spans, word_spans

TOXIC_DOCUMENTS = 1800     # bounds of the labelled sample
OTHER_DOCUMENTS = 3200
WINDOW = 128
STRIDE = 96
WORD_PLACES = 1 << 17
CHAR_PLACES = 1 << 13
WORD_SIZE = 8
CHAR_SIZE = 6
LONG = 6                   # bytes of the longer n-grams
LONG_PLACES = 1 << 16
LONG_SIZE = 4
STATE = 8
ROUNDS = 2                 # choices of training windows
EPOCHS = 2                 # passes over them
BATCH = 192
RATE = 0.02
LEADS = 2                  # most suspicious windows of a document that are learned from
CALIBRATION_SHARE = 0.2

_GAP = np.ones(256, dtype=bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of texts laid end to end, each distinct word once: word places,
    trigram places, and for every word of the texts its number."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        data = _LOWER[data]
        start, end = word_spans(data, bounds, _GAP) if len(data) else (np.zeros(0, np.int64),) * 2
        self.first = np.searchsorted(start, bounds)
        hashes = hashed_spans(data, start, end) if len(start) else np.zeros(0, np.uint64)
        self.distinct, at, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.place = (self.distinct >> np.uint64(64 - 17)).astype(np.int64)
        a, size = start[at], (end - start)[at]
        # "<word>": one trigram per byte
        owner = np.repeat(np.arange(len(a)), size)
        self.trigram_first = np.concatenate([[0], np.cumsum(size)])
        inside = np.arange(self.trigram_first[-1]) - self.trigram_first[owner]
        here = a[owner] + inside
        wide = data.astype(np.int64)
        before = np.where(inside > 0, wide[here - 1], 60) if len(here) else here
        after = np.where(inside < size[owner] - 1, wide[np.minimum(here + 1, len(wide) - 1)], 62) if len(here) else here
        code = (before << 16 | (wide[here] if len(here) else here) << 8 | after).astype(np.uint64)
        self.trigram = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)).astype(np.int64)
        # n-grams of LONG bytes of "<word>"; a shorter word is one n-gram
        grams = np.maximum(1, size + 3 - LONG)
        self.long_first = np.concatenate([[0], np.cumsum(grams)])
        owner = np.repeat(np.arange(len(a)), grams)
        at = np.arange(self.long_first[-1]) - self.long_first[owner]
        code = np.zeros(len(owner), np.uint64)
        for j in range(LONG if len(owner) else 0):
            place = at + j
            byte = wide[np.clip(a[owner] + place - 1, 0, len(wide) - 1)]
            byte = np.where(place == 0, 60, np.where(place <= size[owner], byte, np.where(place == size[owner] + 1, 62, 0)))
            code = code << np.uint64(8) | byte.astype(np.uint64)
        code ^= code >> np.uint64(23)
        self.long = ((code * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - 16)).astype(np.int64)

    @classmethod
    def of_texts(cls, texts: list[bytes]) -> Words:
        """The same for many texts, a block of them at a time: only the distinct
        words are laid end to end."""
        hashes, counts, known, kept = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], np.zeros(0, np.uint64), []
        for _, _, data, bounds in chunks(texts):
            data = _LOWER[data]
            start, end = word_spans(data, bounds, _GAP) if len(data) else (np.zeros(0, np.int64),) * 2
            found = hashed_spans(data, start, end) if len(start) else np.zeros(0, np.uint64)
            hashes.append(found)
            counts.append(np.diff(np.searchsorted(start, bounds)))
            distinct, at = np.unique(found, return_index=True)
            fresh = ~np.isin(distinct, known)
            known = np.union1d(known, distinct)
            whole = data.tobytes()
            kept += [whole[a:b] for a, b in zip(start[at[fresh]].tolist(), end[at[fresh]].tolist(), strict=True)]
        line = b" ".join(kept)
        words = cls(np.frombuffer(line, np.uint8), np.array([0, len(line)]))
        words.first = np.cumsum(np.concatenate(counts))
        words.number = np.searchsorted(words.distinct, np.concatenate(hashes))
        return words

    def inputs(self, p: dict[str, np.ndarray], used: np.ndarray):
        """Input vectors of the distinct words ``used``; with them trigrams,
        their owners and number, and the longer n-grams and their owners."""
        size, longs = np.diff(self.trigram_first)[used], np.diff(self.long_first)[used]
        owner, long_owner = np.repeat(np.arange(len(size)), size), np.repeat(np.arange(len(longs)), longs)
        trigram = self.trigram[_ranges(self.trigram_first[:-1][used], size)]
        long = self.long[_ranges(self.long_first[:-1][used], longs)]
        chars, wide = np.zeros((len(size), CHAR_SIZE), np.float32), np.zeros((len(size), LONG_SIZE), np.float32)
        if len(size):
            chars = np.add.reduceat(p["char"][trigram], np.cumsum(size) - size, axis=0) / size[:, None].astype(np.float32)
            wide = np.add.reduceat(p["long"][long], np.cumsum(longs) - longs, axis=0)
        table = np.concatenate([p["word"][self.place[used]], chars, wide], axis=1)
        return table, (trigram, owner, size), (long, long_owner)

    def table(self, p: dict[str, np.ndarray], block: int = 1 << 15) -> np.ndarray:
        """Input vectors of all distinct words."""
        every = np.arange(len(self.place))
        return np.concatenate([self.inputs(p, every[i:i + block])[0] for i in range(0, max(1, len(every)), block)])


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word index and presence (windows x WINDOW), and the text of each window."""
    size = np.diff(first)
    count = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    index = ((first[text] + nth * STRIDE)[:, None] + np.arange(WINDOW)).astype(np.int32)
    present = index < first[text + 1][:, None]
    return np.where(present, index, 0), present, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Network:
    def __init__(self, seed: int = 17):
        rng = np.random.default_rng(seed)

        def init(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        size = WORD_SIZE + CHAR_SIZE + LONG_SIZE
        self.p = {"word": init(WORD_PLACES, WORD_SIZE, scale=0.05), "char": init(CHAR_PLACES, CHAR_SIZE, scale=0.1),
                  "long": init(LONG_PLACES, LONG_SIZE, scale=0.02),
                  "look": init(2 * STATE, scale=0.1), "out": init(2 * STATE, scale=0.3), "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.p["x" + side] = init(size, 3 * STATE, scale=0.3)
            self.p["h" + side] = init(STATE, 3 * STATE, scale=0.3)
            self.p["c" + side] = np.zeros(3 * STATE, np.float32)
        self.slopes, self.offset = np.array([1.0, 0.0]), 0.0

    def _read(self, side: str, gates: np.ndarray, present: np.ndarray, keep: list | None):
        """States (time, windows, STATE) of one direction; ``gates``: input part per time step."""
        steps = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
        weight, h = self.p["h" + side], np.zeros((present.shape[0], STATE), np.float32)
        states = np.empty((WINDOW, present.shape[0], STATE), np.float32)
        for t in steps:
            x, on = gates(t), present[:, t, None]
            inner = h @ weight
            zr = _sigmoid(x[:, :2 * STATE] + inner[:, :2 * STATE])
            z, r = zr[:, :STATE], zr[:, STATE:]
            n = np.tanh(x[:, 2 * STATE:] + r * inner[:, 2 * STATE:])
            new = np.where(on, n + z * (h - n), h)
            if keep is not None:
                keep.append((t, h, z, r, n, inner[:, 2 * STATE:]))
            states[t] = h = new
        return states

    def forward(self, table: np.ndarray, number: np.ndarray, present: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logits of windows; ``table``: input vectors of distinct words, ``number``: windows x WINDOW."""
        kept: dict[str, list] = {"f": [], "b": []}
        states = []
        for side in ("f", "b"):
            gate_table = table @ self.p["x" + side] + self.p["c" + side]
            states.append(self._read(side, lambda t, g=gate_table: g[number[:, t]], present,
                                     kept[side] if tape is not None else None))
        h = np.concatenate(states, axis=2)                           # time, windows, 2 * STATE
        look = np.where(present.T, h @ self.p["look"], -1e9)
        look = np.exp(look - look.max(axis=0))
        share = look / look.sum(axis=0)
        pooled = np.einsum("tw,tws->ws", share, h)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        if tape is not None:
            tape |= {"kept": kept, "h": h, "share": share, "pooled": pooled, "table": table, "number": number,
                     "present": present}
        return logit

    def gradients(self, tape: dict, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the loss whose derivative by each logit is ``slope``;
        those of the input vectors come under "table"."""
        h, share, number, present, table = (tape[k] for k in ("h", "share", "number", "present", "table"))
        grad = {"bias": np.array([slope.sum()], np.float32), "out": slope @ tape["pooled"]}
        pooled = slope[:, None] * self.p["out"]
        by_share = np.einsum("tws,ws->tw", h, pooled)
        by_look = share * (by_share - (share * by_share).sum(axis=0))
        grad["look"] = np.einsum("tw,tws->s", by_look, h)
        by_h = share[:, :, None] * pooled + by_look[:, :, None] * self.p["look"]
        by_table = np.zeros_like(table)
        for k, side in enumerate(("f", "b")):
            outer = by_h[:, :, k * STATE:(k + 1) * STATE]
            weight, gate_grad = self.p["h" + side], np.zeros((len(table), 3 * STATE), np.float32)
            by_weight, carry = np.zeros_like(weight), np.zeros((len(slope), STATE), np.float32)
            for t, before, z, r, n, inner_n in reversed(tape["kept"][side]):
                total = outer[t] + carry
                on = present[:, t, None]
                moved = np.where(on, total, 0.0)
                d_n = moved * (1 - z) * (1 - n * n)
                d_z = moved * (before - n) * z * (1 - z)
                d_r = d_n * inner_n * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_n], axis=1)
                d_inner = np.concatenate([d_z, d_r, d_n * r], axis=1)
                by_weight += before.T @ d_inner
                carry = np.where(on, moved * z + d_inner @ weight.T, total)
                np.add.at(gate_grad, number[:, t], d_x)
            grad["h" + side] = by_weight
            grad["x" + side] = table.T @ gate_grad
            grad["c" + side] = gate_grad.sum(axis=0)
            by_table += gate_grad @ self.p["x" + side].T
        grad["table"] = by_table
        return grad

    def logits(self, words: Words, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Logit and text of every window of the texts."""
        index, present, text = windows(words.first)
        table = words.table(self.p)
        out = [self.forward(table, words.number[index[i:i + block]], present[i:i + block])
               for i in range(0, len(text), block)]
        return np.concatenate(out) if out else np.zeros(0), text

    def text_logits(self, words: Words) -> np.ndarray:
        """Greatest and mean logit of the windows of each text; without words both are 0."""
        logit, text = self.logits(words)
        count = np.bincount(text, minlength=len(words.first) - 1)
        best = np.full(len(count), -np.inf)
        np.maximum.at(best, text, logit)
        mean = np.bincount(text, weights=logit, minlength=len(count)) / np.maximum(count, 1)
        return np.stack([np.where(count > 0, best, 0.0), mean], axis=1)

    def scores(self, words: Words) -> np.ndarray:
        value = np.clip(self.text_logits(words) @ self.slopes + self.offset, -35, 35)
        return 1.0 / (1.0 + np.exp(-value))


class _Steps:
    """Adam."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.params, self.t = params, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, name: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        m, v = self.m[name], self.v[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.999 * v[rows] + 0.001 * grad * grad
        scale = RATE * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        self.params[name][rows] -= scale * m[rows] / (np.sqrt(v[rows]) + 1e-6)


def log_odds(holds, labels: np.ndarray, learn: np.ndarray, places: int, block: int = 256) -> np.ndarray:
    """Log odds, by class, of the share of the documents to learn from that
    hold each place; ``holds(a, b)``: texts and places of texts a to b."""
    counts = np.zeros((2, places))
    for a in range(0, len(labels), block):
        text, place = holds(a, min(a + block, len(labels)))
        held = np.unique(text * places + place)
        held = held[learn[held // places]]
        for label in (0, 1):
            counts[label] += np.bincount(held[labels[held // places] == label] % places, minlength=places)
    known = labels[learn]
    odds = np.log((counts[1] + 0.5) / (known.sum() + 1.0)) - np.log((counts[0] + 0.5) / ((known == 0).sum() + 1.0))
    return np.where(counts.sum(axis=0) >= 5, np.clip(odds, -2, 4), 0.0)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 23) -> Network:
    rng = np.random.default_rng(seed)
    network = Network()
    words = Words.of_texts(texts)
    index, present, text = windows(words.first)
    if not len(text):
        return network
    learn = rng.random(len(texts)) >= CALIBRATION_SHARE
    # one coordinate of words and longer n-grams starts from the log odds of the training documents
    longs = np.diff(words.long_first)

    def held_words(a: int, b: int):
        return (np.repeat(np.arange(a, b), np.diff(words.first[a:b + 1])),
                words.place[words.number[words.first[a]:words.first[b]]])

    def held_grams(a: int, b: int):
        owner = np.repeat(np.arange(a, b), np.diff(words.first[a:b + 1]))
        held = np.unique(owner * len(longs) + words.number[words.first[a]:words.first[b]])
        number = held % len(longs)
        return np.repeat(held // len(longs), longs[number]), words.long[_ranges(words.long_first[:-1][number], longs[number])]

    odds = log_odds(held_words, labels, learn, WORD_PLACES)
    long_odds = log_odds(held_grams, labels, learn, LONG_PLACES)
    network.p["word"][:, 0] = odds / 2
    network.p["long"][:, 0] = long_odds / 4
    most = np.maximum.reduceat(long_odds[words.long], words.long_first[:-1])
    word_odds = np.maximum(np.maximum(odds[words.place], most), 0.0)
    suspicion = np.concatenate([np.where(present[i:i + 2048], word_odds[words.number[index[i:i + 2048]]], 0.0).sum(axis=1)
                                for i in range(0, len(index), 2048)])
    steps = _Steps(network.p)
    for turn in range(ROUNDS):
        if turn:
            suspicion = network.logits(words)[0]
        order = np.lexsort((-suspicion, text))
        place = np.arange(len(order)) - np.searchsorted(text, text[order])
        lead = order[learn[text[order]] & (place < LEADS)]
        others = np.flatnonzero(learn[text] & (labels[text] == 0))
        chance = rng.choice(others, size=min(len(others), len(lead)), replace=False) if len(others) else others
        chosen = np.concatenate([lead, chance])
        weight = np.where(labels[text[chosen]] > 0, max(1.0, (labels[text[chosen]] == 0).sum()
                                                       / max(1, (labels[text[chosen]] > 0).sum())) ** 0.5, 1.0)
        for _ in range(EPOCHS):
            shuffled = rng.permutation(len(chosen))
            for i in range(0, len(chosen), BATCH):
                rows = shuffled[i:i + BATCH]
                _learn(network, steps, words, index[chosen[rows]], present[chosen[rows]],
                       labels[text[chosen[rows]]], weight[rows])
    held = np.flatnonzero(~learn & (np.diff(words.first) > 0))
    if len(np.unique(labels[held])) == 2:
        network.slopes, network.offset = logistic_fit(network.text_logits(words)[held], labels[held])
    return network


def _learn(network: Network, steps: _Steps, words: Words, index: np.ndarray, present: np.ndarray, labels: np.ndarray,
           weight: np.ndarray) -> None:
    used, number = np.unique(words.number[index], return_inverse=True)
    number = number.reshape(index.shape)
    table, (trigram, owner, size), (long, long_owner) = words.inputs(network.p, used)
    tape: dict = {}
    logit = network.forward(table, number, present, tape)
    slope = ((_sigmoid(logit) - labels) * weight / weight.sum()).astype(np.float32)
    grad = network.gradients(tape, slope)
    by_table = grad.pop("table")
    steps.t += 1
    for name, value in grad.items():
        steps.step(name, value)
    place, at = np.unique(words.place[used], return_inverse=True)
    by_word = np.zeros((len(place), WORD_SIZE), np.float32)
    np.add.at(by_word, at, by_table[:, :WORD_SIZE])
    steps.step("word", by_word, place)
    place, at = np.unique(trigram, return_inverse=True)
    by_char = np.zeros((len(place), CHAR_SIZE), np.float32)
    np.add.at(by_char, at, (by_table[:, WORD_SIZE:WORD_SIZE + CHAR_SIZE] / size[:, None])[owner])
    steps.step("char", by_char, place)
    place, at = np.unique(long, return_inverse=True)
    by_long = np.zeros((len(place), LONG_SIZE), np.float32)
    np.add.at(by_long, at, by_table[:, WORD_SIZE + CHAR_SIZE:][long_owner])
    steps.step("long", by_long, place)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", toxic_documents: int = TOXIC_DOCUMENTS,
                   other_documents: int = OTHER_DOCUMENTS) -> DataFrame:
    """One row per input row: doc_id and score, the probability of label 1.

    ``learn`` marks the label rows that may be learned from; of each label at
    most ``toxic_documents`` and ``other_documents`` (smallest id hashes) are
    used.  NULL texts and texts without a word score 0.  NULL or other labels
    than 0 and 1 are not learned from; without both labels every score is 0.
    Repeated rows are scored each; an empty table gives no rows; other columns
    are ignored.
    """
    toxic = F.col(label_col).cast("int")
    sample = labelled_sample(labels, learn & (toxic == 1), id_col, label_col, toxic_documents).unionByName(
        labelled_sample(labels, learn & (toxic == 0), id_col, label_col, other_documents)
    ).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = sorted(_plain(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
                  .toLocalIterator(), key=lambda r: (r["doc_id"], r["text"]))
    answers = np.array([r["label"] for r in rows], dtype=np.int64)
    network = train([bytes(r["text"]) for r in rows], answers) if len(np.unique(answers)) == 2 else None
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in slices(batches):
            for a, b, data, bounds in chunks(batch.column(1).to_pylist()):
                words = Words(data, bounds)
                values = own.scores(words) if own else np.zeros(b - a)
                values = np.where(np.diff(words.first) > 0, values, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(values)],
                                                 names=["doc_id", "score"])

    return _plain(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
