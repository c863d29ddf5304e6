"""Plain one-process versions of the operators, for tables of a few rows."""
from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

SF_DIR = "/root/testdata/sf0.001"

MESSY = [  # doc_id, text: NULLs, empties, ties, repeats, odd spacing, long and tiny texts
    (1, "the cat sat on the mat and the dog lay by the door in the old house"),
    (2, "the cat sat on the mat and the dog lay by the door in the old house"),
    (2, "the cat sat on the mat and the dog lay by the door in the old house"),
    (3, None), (4, ""), (5, "   \n\t "), (6, "1234 !!"), (7, "x"),
    (8, "Größe  und Maß \n Straße über Äpfel"), (9, "word " * 3000), (None, "a row without an id"),
    (None, None), (10, "don't  stop <|endoftext|> now\n\n"), (11, "z" * 5000), (2, "another text under a used id"),
]


def removed_repeats(rows, length: int = 100):
    """(id, bytes, removed, runs, sha256 of the rest), by looking up every window."""
    first, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        marks = np.zeros(len(data) + 1, int)
        for at in range(len(data) - length + 1):
            window = data[at:at + length]
            if first.setdefault(window, (doc, at)) != (doc, at):
                marks[at] += 1
                marks[at + length] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def longest_common(a: list, b: list) -> int:
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def near_classes(rows, least: float = 0.8) -> dict:
    """Smallest id of each id's class; every pair that shares a shingle is aligned."""
    ids, words = [r[0] for r in rows], [(r[1] or "").split() for r in rows]
    shingles = [Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in words]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or (shingles[i] & shingles[j] and longest_common(words[i], words[j])
                                            >= least * max(len(words[i]), len(words[j]))):
                top[root(i)] = root(j)
    least_id: dict = {}
    for i, doc in enumerate(ids):
        least_id[root(i)] = min(least_id.get(root(i), doc), doc)
    return {doc: least_id[root(i)] for i, doc in enumerate(ids)}


def best_products(vectors: dict, query, k: int):
    scores = sorted(((-float(np.dot(vectors[query], v)), i) for i, v in vectors.items() if i != query))
    return [(i, -s) for s, i in scores[:k]]


def all_segmentations(word: bytes, prob: dict) -> float:
    if not word:
        return 1.0
    return sum(prob[word[:n]] * all_segmentations(word[n:], prob) for n in range(1, len(word) + 1) if word[:n] in prob)
