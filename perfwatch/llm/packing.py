"""Packing documents into fixed windows of tokens.

Bounded-space online packing.  Every partition keeps a fixed number of open
windows.  A document's full windows are cut off and emitted at once; what is
left goes to the open window it fits best.  If none fits, the fullest is
closed and a new one opened.  The windows still open when a partition ends
are merged: those of a few neighbouring partitions are filled up against each
other in one task, cutting pieces where needed, so every such group ends with
at most one window that is not full.
"""
from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, slices

WINDOW = 2048
OPEN_WINDOWS = 32
MERGE_PARTITIONS = 8
CACHE_ENTRIES = 250_000
END_ID = 1

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                   ("part", pa.int64()), ("closed", pa.bool_())])
PIECE_DDL = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
             "part long, closed boolean")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Byte of each printable stand-in that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
class TokenIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary and its merge order come from the given file; the merges
    run in the faster of the two installed libraries, which gives the same ids
    (tested).  A token of this vocabulary never reaches past a single space
    that stands between two characters that are not white space, so such
    stretches are encoded once and remembered, in a bounded cache that lives
    as long as the worker; texts with any other spacing are encoded whole.

    ``added_tokens``: the string of an added token ('<|endoftext|>') in a text
    becomes that token's id, as the file's tokenizer has it; otherwise it is
    encoded like any other text.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES, added_tokens: bool = False):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        byte_of = _byte_of()
        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        special = {t.content for t in added.values()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab().items()
                 if token not in special}
        self.encode = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.entries, self.known = entries, {}
        self.added, self.cuts = {}, None
        if added_tokens and added:
            if odd := [t.content for t in added.values() if t.lstrip or t.rstrip or t.single_word]:
                raise ValueError(f"added tokens that depend on their surroundings: {odd}")
            self.added = {t.content: struct.pack("<I", i) for i, t in added.items()}
            self.cuts = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")

    def whole(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.cuts and self.cuts.search(text):
            return b"".join(self.added.get(part) or self.between(part) for part in self.cuts.split(text) if part)
        return self.between(text)

    def between(self, text: str) -> bytes:
        words = text.split(" ")
        # white space next to a cutting space may join it in one token
        if "" in words or list(map(str.strip, words)) != words:
            return self.whole(text)
        known, first = self.known, words[0]
        words[0] = words[-1]
        found = list(map(known.get, words))
        if None in found:
            if len(known) > self.entries:
                known.clear()
            for word, ids in zip(words, found, strict=True):
                if ids is None and word not in known:
                    known[word] = self.whole(" " + word)
            found = [known[w] if w in known else self.whole(" " + w) for w in words]
        found[0] = self.whole(first)
        return b"".join(found)


def _packed(batches: Iterator[pa.RecordBatch], path: str, window: int, open_windows: int,
            added_tokens: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    ids_of, serial = TokenIds(path, added_tokens=added_tokens), part << 33
    out: list[tuple] = []
    opened: list[list] = []  # [free, pieces]

    def emit(pieces: list[tuple], closed: bool) -> None:
        nonlocal serial
        offset = 0
        for doc, start, ids, tokens in pieces:
            out.append((doc, start, len(ids) // 4, ids, tokens, serial, offset, part, closed))
            offset += len(ids) // 4
        serial += 1

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, type=field.type) for column, field in zip(zip(*out, strict=True), PIECE, strict=True)],
            schema=PIECE)
        out.clear()
        return batch

    end = struct.pack("<I", END_ID)
    for batch in slices(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = ids_of(text or "") + end
            tokens, start = len(ids) // 4, 0
            while tokens - start >= window:
                emit([(doc, start, ids[4 * start:4 * (start + window)], tokens)], True)
                start += window
            rest = tokens - start
            if rest:
                piece = (doc, start, ids[4 * start:], tokens)
                best = min((w for w in opened if w[0] >= rest), key=lambda w: w[0], default=None)
                if best is None:
                    if len(opened) == open_windows:
                        fullest = min(opened, key=lambda w: w[0])
                        opened.remove(fullest)
                        emit(fullest[1], True)
                    opened.append(best := [window, []])
                best[0] -= rest
                best[1].append(piece)
                if best[0] == 0:
                    opened.remove(best)
                    emit(best[1], True)
            if len(out) >= 4000:
                yield flush()
    for _, pieces in opened:
        emit(pieces, False)
    if out:
        yield flush()


def _merged(pieces, window: int):
    """Fill the open windows of one group of partitions against each other."""
    import pandas as pd

    pieces = pieces.sort_values(["sequence_id", "offset"], kind="stable")
    out, offset, serial = [], 0, None
    spare = iter(pieces["sequence_id"].unique())
    for doc, start, ids, tokens, part in zip(pieces["doc_id"], pieces["start"], pieces["ids"], pieces["doc_tokens"],
                                             pieces["part"], strict=True):
        at = 0
        while at < len(ids):
            if offset == 0:
                serial = next(spare)   # full windows use up no more numbers than there were open ones
            taken = ids[at:at + 4 * (window - offset)]
            out.append((doc, start + at // 4, len(taken) // 4, taken, tokens, serial, offset, part, True))
            at += len(taken)
            offset = (offset + len(taken) // 4) % window
    frame = pd.DataFrame(out, columns=PIECE.names)
    return frame.astype({"doc_id": "Int64"})


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   open_windows: int = OPEN_WINDOWS, vocabulary: str | None = None,
                   added_tokens: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every token of every document, its end token included, lies in exactly
    one piece.  NULL and empty texts consist of the end token.  NULL ids stay
    NULL; repeated rows are packed as often as they occur; an empty table
    gives no pieces.  Other columns are ignored.  ``added_tokens``: strings of
    added tokens in a text become their ids (see TokenIds).
    """
    path = vocabulary or vocabulary_path()
    pieces = cut(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(lambda batches: _packed(batches, path, window, open_windows, added_tokens), PIECE_DDL)
    )
    rest = (
        pieces.filter("NOT closed").withColumn("crew", F.floor(F.col("part") / MERGE_PARTITIONS))
        .groupBy("crew").applyInPandas(lambda frame: _merged(frame.drop(columns="crew"), window), PIECE_DDL)
    )
    return pieces.filter("closed").unionByName(rest).drop("part", "closed")
