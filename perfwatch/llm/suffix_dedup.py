"""Removal of repeated byte strings by a distributed suffix sort.

Every byte that lies in a string of MATCH bytes which also starts earlier
(smaller id, or same document and earlier start) is removed.

1. *Anchors.*  The ANCHOR-byte string with the smallest hash inside a window
   of MATCH bytes depends on the window's bytes alone, so equal windows name
   equal anchors.  Neighbouring windows with one anchor form a stretch.
   Counting anchors over the whole corpus (hashes only, copies of a stretch
   collapsed in the task that meets them) tells which stretches repeat whole,
   and which share their anchor with a different stretch.
2. *Suffix runs.*  Only the latter need sorting.  Their suffixes, from the
   anchor on, are sorted per task, front-coded (common-prefix length plus the
   rest) and exchanged by key range, splitters coming from a bounded sample.
3. *Merge.*  Each range merges its runs with a loser tree that keeps every
   head's common prefix with the last output and compares only behind it.
   The merged order and its common prefixes, refined by the bytes left of the
   anchor, decide exactly which windows have an earlier equal.

An anchor that very many different stretches share is not gathered: the
windows around it are sorted as suffixes of their own, which any range
boundary may divide, and copies inside one run are settled in that run.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import cut, fanout

MATCH = 100
ANCHOR = 50
SPREAD = MATCH - ANCHOR           # largest distance from a window's start to its anchor
SEGMENT = 1 << 19                 # bytes hashed in one vectorised pass
FLUSH_RUNS = 1 << 18              # stretches kept in a task before they are dealt out
TASK_MANY = 256                   # different stretches of one anchor in one task that make it frequent
GROUP_MANY = 20_000               # and in all tasks
SAMPLE_KEYS = 1 << 16             # bound of the splitter sample
NO_ID = -(2**63)

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))

COUNT, COVERED, CANDIDATE = 0, 1, 2
ROWS_DDL = "bucket long, kind int, body binary"
STRETCH = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("windows", "<i4"), ("twice", "?"),
                    ("frequent", "?")])
SPAN = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("end", "<i4")])
HEAD = np.dtype([("doc", "<i8"), ("key", "<i8"), ("bucket", "<i8"), ("at", "<i4"), ("low", "i1"), ("high", "i1"),
                 ("whole", "i1")])


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], dtype="<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(body: bytes, *dtypes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    sizes, at, out = np.frombuffer(raw, "<i8", len(dtypes)), 8 * len(dtypes), []
    for size, dtype in zip(sizes.tolist(), dtypes, strict=True):
        out.append(np.frombuffer(raw, dtype, size // np.dtype(dtype).itemsize, at))
        at += size
    return out


def _prefix_hashes(data: np.ndarray):
    n = len(data)
    power, inverse = np.full(n + 1, _BASE), np.full(n + 1, _BACK)
    power[0] = inverse[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * inverse[:n], out=sums[1:])
    return sums, power


def _anchor_hashes(sums: np.ndarray, power: np.ndarray) -> np.ndarray:
    h = (sums[ANCHOR:] - sums[:-ANCHOR]) * power[:len(sums) - ANCHOR]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _least(h: np.ndarray) -> np.ndarray:
    """Smallest anchor hash of the window that starts at each position."""
    m, reach = h, 1
    while 2 * reach <= SPREAD + 1:
        m, reach = np.minimum(m[:-reach], m[reach:]), 2 * reach
    rest = SPREAD + 1 - reach
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def stretches(data: np.ndarray, bounds: np.ndarray):
    """Stretches of the texts laid end to end in ``data``: text number, start,
    windows, anchor hash, content hash, and whether the anchor occurs twice."""
    if len(data) < MATCH:
        return None
    sums, power = _prefix_hashes(data)
    hashes = _anchor_hashes(sums, power)
    least = _least(hashes)
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(least)]
    opens = np.ones(len(least), dtype=bool)
    opens[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    opens &= np.arange(len(least)) + MATCH <= bounds[1:][text]
    start = np.flatnonzero(opens)
    if not len(start):
        return None
    last = bounds[1:][text[start]] - MATCH + 1
    windows = np.minimum(np.append(start[1:], len(least)), last) - start
    content = (sums[start + windows - 1 + MATCH] - sums[start]) * power[start]
    content ^= content >> np.uint64(31)
    content += windows.astype(np.uint64) * _BASE
    # a window that starts with its anchor is the last to name it, unless the anchor comes again
    led = np.concatenate([[0], np.cumsum(hashes[:len(least)] == least)])
    twice = led[start + windows - 1] > led[start]
    return text[start], start - bounds[:-1][text[start]], windows, least[start], content, twice


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Texts of a batch in pieces of about SEGMENT bytes: bytes, bounds, (row, offset) of each
    piece.  Longer texts are cut into overlapping pieces that share no window."""
    column = batch.column(2)
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    held, size, place = [], 0, []
    for row in range(len(column)):
        low, high = offsets[row], offsets[row + 1]
        for at in range(0, max(0, high - low - MATCH + 1), SEGMENT):
            piece = data[low + at:min(high, low + at + SEGMENT + MATCH - 1)]
            if held and size + len(piece) > SEGMENT:
                yield np.concatenate(held), np.cumsum([0] + [len(p) for p in held]), place
                held, size, place = [], 0, []
            held.append(piece)
            place.append((row, at))
            size += len(piece)
    if held:
        yield np.concatenate(held), np.cumsum([0] + [len(p) for p in held]), place


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, kind, body = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()),
                                       pa.array(body, pa.binary())], names=["bucket", "kind", "body"])


def _by_bucket(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    return [(int(bucket[order[a]]), kind, _pack(*[c[order[a:b]] for c in columns]))
            for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _firsts(*keys: np.ndarray) -> np.ndarray:
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return first


def _settle(anchor, content, stretch, bucket):
    """Sort stretches by anchor, content and place; copies of an earlier
    stretch are covered.  Returns the kept ones (sorted) and the covered spans."""
    order = np.lexsort((stretch["start"], stretch["doc"], content, anchor))
    anchor, content, stretch, bucket = anchor[order], content[order], stretch[order], bucket[order]
    first = _firsts(anchor, content)
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    # a repeated input row is the same document: it does not come before itself
    copy = ~first & ((stretch["doc"] != stretch["doc"][head]) | (stretch["start"] != stretch["start"][head]))
    spans = np.empty(int(copy.sum()), SPAN)
    for name in ("doc", "key", "start"):
        spans[name] = stretch[name][copy]
    spans["end"] = stretch["start"][copy] + stretch["windows"][copy] - 1 + MATCH
    return (anchor[~copy], content[~copy], stretch[~copy], bucket[~copy]), (spans, bucket[copy])


def _deal(parts: list, buckets: int, task_many: int) -> list[tuple[int, int, bytes]]:
    """Rows of one flush: counts by anchor, covered spans and frequent candidates by document."""
    anchor, content, stretch, bucket = (np.concatenate(column) for column in zip(*parts, strict=True))
    kept, (spans, span_bucket) = _settle(anchor, content, stretch, bucket)
    anchor, content, stretch, bucket = kept
    group = np.cumsum(_firsts(anchor)) - 1
    many = np.bincount(group)[group] > task_many
    rows = _by_bucket(buckets + span_bucket, COVERED, spans) if len(spans) else []
    if many.any():
        own = stretch[many].copy()
        own["frequent"] = 1
        rows += _by_bucket(buckets + bucket[many], CANDIDATE, own)
        marker = many & _firsts(anchor)
        stretch = stretch.copy()
        stretch["windows"][marker] = 0      # says only: frequent
        keep = ~many | marker
        anchor, content, stretch, bucket = anchor[keep], content[keep], stretch[keep], bucket[keep]
    # back in text order, where the place columns compress to almost nothing
    order = np.lexsort((stretch["start"], stretch["key"], stretch["doc"]))
    owner = ((anchor[order] * _BASE >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    s = stretch[order]
    fields = [anchor[order], content[order], s["doc"], s["key"], s["start"], s["windows"], s["twice"],
              bucket[order].astype("<i4")]
    return rows + _by_bucket(owner, COUNT, *[np.ascontiguousarray(f) for f in fields])


def _anchor_rows(batches: Iterator[pa.RecordBatch], buckets: int, task_many: int) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, keys, owner = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
        for data, bounds, place in _segments(batch):
            found = stretches(data, bounds)
            if found is None:
                continue
            text, start, windows, anchor, content, twice = found
            row, shift = np.array([p[0] for p in place])[text], np.array([p[1] for p in place])[text]
            stretch = np.zeros(len(start), STRETCH)
            stretch["doc"], stretch["key"], stretch["start"], stretch["windows"] = ids[row], keys[row], start + shift, windows
            stretch["twice"] = twice
            parts.append((anchor, content, stretch, owner[row].astype(np.int64)))
            held += len(start)
            if held >= FLUSH_RUNS:
                yield _rows(_deal(parts, buckets, task_many))
                parts, held = [], 0
    if parts:
        yield _rows(_deal(parts, buckets, task_many))


def _count_group(frame: pd.DataFrame, buckets: int, group_many: int) -> pd.DataFrame:
    """One group of anchors: which stretches are covered whole, which must be sorted."""
    if frame["kind"].iloc[0] != COUNT:
        return frame.assign(bucket=frame["bucket"] - buckets)
    loaded = [_unpack(b, "<u8", "<u8", "<i8", "<i8", "<i4", "<i4", "?", "<i4") for b in frame["body"]]
    anchor, content, doc, key, start, windows, twice, bucket = (np.concatenate(c) for c in zip(*loaded, strict=True))
    del loaded
    marked = np.unique(anchor[windows == 0])
    real = windows > 0
    stretch = np.zeros(int(real.sum()), STRETCH)
    for name, column in (("doc", doc), ("key", key), ("start", start), ("windows", windows), ("twice", twice)):
        stretch[name] = column[real]
    kept, (spans, span_bucket) = _settle(anchor[real], content[real], stretch, bucket[real].astype(np.int64))
    anchor, content, stretch, bucket = kept
    rows = _by_bucket(span_bucket, COVERED, spans) if len(spans) else []
    if len(anchor):
        group = np.cumsum(_firsts(anchor)) - 1
        size = np.bincount(group, weights=_firsts(anchor, content))[group]
        frequent = np.isin(anchor, marked) | (size > group_many)
        open_ = (size > 1) | stretch["twice"] | frequent
        if open_.any():
            stretch["frequent"] = frequent
            rows += _by_bucket(bucket[open_], CANDIDATE, stretch[open_])
    return pd.DataFrame(rows, columns=["bucket", "kind", "body"])


def _spans_of(bodies) -> np.ndarray:
    return np.concatenate([_unpack(b, SPAN)[0] for b in bodies] or [np.empty(0, SPAN)])


def _heads(data: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places of one document's stretches: place, and the least and
    greatest distance of the windows that name it.  Frequent anchors: each
    window by itself."""
    least = _anchor_hashes(*_prefix_hashes(data))
    places, lows, highs = [], [], []
    for start, windows, frequent in zip(stretch["start"].tolist(), stretch["windows"].tolist(),
                                        stretch["frequent"].tolist(), strict=True):
        if frequent:
            places.append(np.arange(start, start + windows))
            lows.append(np.full(windows, -1))
            highs.append(np.zeros(windows))
            continue
        reach = least[start:start + windows + SPREAD]
        at = start + np.flatnonzero(reach == reach.min())
        # a window names the first anchor at or after its start
        from_ = np.maximum(start, np.append([start], at[:-1] + 1))
        to = np.minimum(start + windows - 1, at)
        good = from_ <= to
        places.append(at[good])
        lows.append(at[good] - to[good])
        highs.append(at[good] - from_[good])
    return tuple(np.concatenate(c).astype(np.int64) for c in (places, lows, highs))


def _front_code(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix with the row before, and the remaining bytes."""
    shared = np.zeros(len(text), dtype=np.uint8)
    if len(text) > 1:
        differ = text[1:] != text[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), MATCH)
    return shared, text[np.arange(MATCH) >= shared[:, None]]


def _decode(shared: np.ndarray, rest: np.ndarray) -> np.ndarray:
    own = np.arange(MATCH) >= shared[:, None]
    text = np.zeros((len(shared), MATCH), dtype=np.uint8)
    text[own] = rest
    source = np.maximum.accumulate(np.where(own, np.arange(len(shared))[:, None], 0), axis=0)
    return text[source, np.arange(MATCH)]


def _suffix_run(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The sorted, front-coded suffixes of one document bucket."""
    out = pd.DataFrame([], columns=["bucket", "kind", "body"])
    if not len(rows) or not len(docs):
        return out
    stretch = np.concatenate([_unpack(b, STRETCH)[0] for b in rows["body"]])
    stretch = stretch[np.lexsort((stretch["start"], stretch["key"], stretch["doc"]))]
    edges = np.flatnonzero(_firsts(stretch["doc"], stretch["key"])).tolist() + [len(stretch)]
    texts = dict(zip(zip(docs["doc"], docs["key"], strict=True), docs["text"], strict=True))
    heads, suffixes, lefts = [], [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        doc, key = int(stretch["doc"][a]), int(stretch["key"][a])
        data = np.frombuffer(texts[doc, key], np.uint8)
        at, low, high = _heads(data, stretch[a:b])
        head = np.zeros(len(at), HEAD)
        head["doc"], head["key"], head["bucket"], head["at"] = doc, key, rows["bucket"].iloc[0], at
        head["low"], head["high"], head["whole"] = np.maximum(low, 0), high, low < 0
        # no byte of UTF-8 is 255: one more leaves 0 for "past the end"
        around = np.concatenate([np.zeros(SPREAD, np.uint8), data + np.uint8(1), np.zeros(MATCH, np.uint8)])
        suffixes.append(around[at[:, None] + SPREAD + np.arange(MATCH)])
        lefts.append(around[at[:, None] + SPREAD - 1 - np.arange(SPREAD)])
        heads.append(head)
    head, text, left = np.concatenate(heads), np.concatenate(suffixes), np.concatenate(lefts)
    order = np.argsort(text.view(f"S{MATCH}").ravel(), kind="stable") if len(text) else []
    head, text, left = head[order], np.ascontiguousarray(text[order]), left[order]
    # windows sorted by themselves: copies inside the run are settled here
    whole = head["whole"] == 1
    found = []
    if whole.any():
        n, at = np.flatnonzero(whole), head[whole]
        same = np.zeros(len(n), dtype=np.int64)
        same[1:] = np.cumsum((text[n[1:]] != text[n[:-1]]).any(axis=1))
        by_place = np.lexsort((at["at"], at["doc"], same))
        n, at, same = n[by_place], at[by_place], same[by_place]
        first = _firsts(same)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(n)), 0))
        copy = ~first & ((at["doc"] != at["doc"][lead]) | (at["at"] != at["at"][lead]))
        spans = _window_spans(at[copy], at["at"][copy].astype(np.int64), at["at"][copy].astype(np.int64))
        found += [(int(rows["bucket"].iloc[0]), COVERED, _pack(spans))] if copy.any() else []
        keep = np.ones(len(head), dtype=bool)
        keep[n[copy]] = False
        head, text, left = head[keep], text[keep], left[keep]
    shared, rest = _front_code(text)
    found.append((int(rows["bucket"].iloc[0]), CANDIDATE, _pack(head, shared, rest, left)))
    return pd.DataFrame(found, columns=["bucket", "kind", "body"])


def _load_run(body: bytes):
    head, shared, rest, left = _unpack(body, HEAD, np.uint8, np.uint8, np.uint8)
    return head, _decode(shared, rest), left.reshape(len(head), SPREAD)


def _range_keys(head: np.ndarray, text: np.ndarray) -> np.ndarray:
    """What decides the range: the anchor, so that its suffixes stay together;
    all bytes for a window that is sorted by itself."""
    key = text.copy()
    key[head["whole"] == 0, ANCHOR:] = 0
    return key.view(f"S{MATCH}").ravel()


def _sample_keys(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column("body").to_pylist():
            head, text, _ = _load_run(body)
            keys = _range_keys(head, text)[step // 2::step].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["sample"])


def _cut_runs(batches: Iterator[pa.RecordBatch], splitters: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The part of each run that belongs to each key range, front-coded anew."""
    edges = np.array(splitters, dtype=f"S{MATCH}")
    for batch in batches:
        rows = []
        for body in batch.column("body").to_pylist():
            head, text, left = _load_run(body)
            if not len(head):
                continue
            target = np.searchsorted(edges, _range_keys(head, text), side="right")
            for t in np.unique(target).tolist():
                part = target == t
                shared, rest = _front_code(text[part])
                rows.append((t, CANDIDATE, _pack(head[part], shared, rest, left[part])))
        yield _rows(rows)


def loser_tree_merge(runs: list[list[bytes]], prefixes: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of MATCH-byte strings.  ``prefixes``: common prefix of
    each string with the one before it in its run.  Returns run, index and
    common prefix with the output before.

    Every head knows its common prefix with the last output.  Of two heads
    the one with the longer prefix comes first, unseen; only at equal lengths
    are bytes read, and only behind that length.
    """
    width = 1 << max(0, (len(runs) - 1).bit_length())
    head = [r[0] if r else None for r in runs] + [None] * (width - len(runs))
    known, index = [0] * width, [0] * width

    def beats(a: int, b: int) -> bool:
        x, y = head[a], head[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        at = known[a]
        while at < MATCH and x[at:at + 16] == y[at:at + 16]:
            at += 16
        if at >= MATCH:
            known[b] = MATCH
            return True
        p, q = x[at:at + 16], y[at:at + 16]
        apart = int.from_bytes(p, "big") ^ int.from_bytes(q, "big")
        at += len(p) - (apart.bit_length() + 7) // 8
        if p < q:
            known[b] = at
            return True
        known[a] = at
        return False

    losers = [0] * width
    winners = list(range(width))
    level = width
    while level > 1:
        half = []
        for i in range(0, level, 2):
            a, b = winners[i], winners[i + 1]
            won, lost = (a, b) if beats(a, b) else (b, a)
            losers[(level + i) // 2] = lost
            half.append(won)
        winners, level = half, level // 2
    best = winners[0]
    out_run, out_index, out_prefix = [], [], []
    while head[best] is not None:
        run, at = best, index[best]
        out_run.append(run)
        out_index.append(at)
        out_prefix.append(known[run])
        at += 1
        index[run] = at
        if at < len(runs[run]):
            head[run], known[run] = runs[run][at], prefixes[run][at]
        else:
            head[run] = None
        node = (width + run) // 2
        while node:
            rival = losers[node]
            if not beats(best, rival):
                losers[node], best = best, rival
            node //= 2
    return out_run, out_index, out_prefix


def _window_spans(head: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    spans = np.empty(len(head), SPAN)
    spans["doc"], spans["key"], spans["start"], spans["end"] = head["doc"], head["key"], first, last + MATCH
    return spans


def covered_windows(head: np.ndarray, left: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Sorted suffixes -> boolean (suffix x distance): the window that starts
    that far left of the anchor has an equal one that starts earlier.

    At distance d windows are equal if the d bytes left of the anchor are and
    the suffixes share MATCH - d bytes, that is, lie in one interval of the
    common-prefix array.
    """
    place = np.lexsort((head["at"], head["doc"]))
    rank = np.empty(len(head), dtype=np.int64)
    rank[place] = np.cumsum(_firsts(head["doc"][place], head["at"][place]))
    kind = np.zeros(len(head), dtype=np.int64)
    out = np.zeros((len(head), SPREAD + 1), dtype=bool)
    for d in range(SPREAD + 1):
        if d:
            _, kind = np.unique(kind * 256 + left[:, d - 1], return_inverse=True)
        rows = np.flatnonzero((head["low"] <= d) & (d <= head["high"]))
        if not len(rows):
            continue
        interval = np.cumsum(prefix < MATCH - d)[rows]
        same = kind[rows]
        order = np.lexsort((rank[rows], same, interval))
        first = _firsts(interval[order], same[order])
        lead = rank[rows][order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        out[rows[order], d] = rank[rows][order] > lead
    return out


def _merge_range(frame: pd.DataFrame) -> pd.DataFrame:
    loaded = [_unpack(b, HEAD, np.uint8, np.uint8, np.uint8) for b in frame["body"]]
    runs, prefixes = [], []
    for _, shared, rest, _ in loaded:
        flat = _decode(shared, rest).tobytes()
        runs.append([flat[i:i + MATCH] for i in range(0, len(flat), MATCH)])
        prefixes.append(shared.tolist())
    run, index, prefix = loser_tree_merge(runs, prefixes)
    base = np.cumsum([0] + [len(r) for r in runs])
    order = base[run] + np.array(index, dtype=np.int64)
    head = np.concatenate([x[0] for x in loaded])[order]
    left = np.concatenate([x[3].reshape(-1, SPREAD) for x in loaded])[order]
    prefix = np.array(prefix, dtype=np.int64)
    # suffixes that share their anchor with no other repeat nothing
    shares = prefix >= MATCH - SPREAD
    shares[:-1] |= shares[1:].copy()
    head, left, prefix = head[shares], left[shares], prefix[shares]
    if not len(head):
        return pd.DataFrame([], columns=["bucket", "kind", "body"])
    hit = np.pad(covered_windows(head, left, prefix), ((0, 0), (1, 1)))
    row, near = np.nonzero(hit[:, 1:-1] & ~hit[:, :-2])
    _, far = np.nonzero(hit[:, 1:-1] & ~hit[:, 2:])
    spans = _window_spans(head[row], head["at"][row] - far, head["at"][row] - near)
    return pd.DataFrame(_by_bucket(head["bucket"][row], COVERED, spans) if len(spans) else [],
                        columns=["bucket", "kind", "body"])


def _kept(docs: pa.Table, rows: pa.Table, carry: list[str]) -> pa.Table:
    spans = _spans_of(rows.column("body").to_pylist())
    spans = spans[np.lexsort((spans["start"], spans["key"], spans["doc"]))]
    edges = np.flatnonzero(_firsts(spans["doc"], spans["key"])).tolist() + [len(spans)] if len(spans) else [0]
    of = {(int(spans["doc"][a]), int(spans["key"][a])): (a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)}
    sizes, kept, starts, ends = [], [], [], []
    for doc, key, text in zip(*(docs.column(c).to_pylist() for c in ("doc", "key", "text")), strict=True):
        a, b = of.get((doc, key), (0, 0))
        low, high = spans["start"][a:b].astype(np.int64), np.maximum.accumulate(spans["end"][a:b]).astype(np.int64)
        if b > a:
            opens = np.append([True], low[1:] > high[:-1])
            low, high = low[opens], high[np.append(np.flatnonzero(opens)[1:] - 1, b - a - 1)]
        keep = zip([0, *high.tolist()], [*low.tolist(), len(text)], strict=True)
        sizes.append(len(text))
        kept.append(b"".join([text[x:y] for x, y in keep]) if b > a else text)
        starts.append(low.tolist())
        ends.append(high.tolist())
    own = [pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(starts, pa.list_(pa.int64())),
           pa.array(ends, pa.list_(pa.int64()))]
    return pa.table([docs.column(c) for c in carry] + own, names=[*carry, "n_bytes", "kept", "span_starts", "span_ends"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                 task_many: int = TASK_MANY, group_many: int = GROUP_MANY) -> DataFrame:
    """One row per input row: the id, the ``carry`` columns, n_bytes, kept
    (remaining bytes), span_starts and span_ends (maximal removed runs).
    ``task_many`` and ``group_many`` choose how an anchor is worked on, never
    the result.

    * NULL text is empty; a NULL id comes before all others.
    * Texts under MATCH bytes are never touched; any length is processed whole.
    * Rows that repeat both id and text are one document and get equal
      results; rows that repeat the id only are different documents, neither
      earlier than the other where their strings start at one offset.
    * An empty table gives no rows; columns not named are ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * fanout(spark)
    wanted = [id_col, *[c for c in carry if c != id_col]]
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        F.struct(*[F.col(c) for c in wanted]).alias("carried"),
    ).withColumn("key", F.xxhash64("text")).withColumn("bucket", F.pmod(F.xxhash64("doc", "key"), F.lit(buckets)))

    counted = cut(
        source.select("doc", "key", "text", "bucket").mapInArrow(lambda it: _anchor_rows(it, buckets, task_many), ROWS_DDL)
        .groupBy("bucket").applyInPandas(lambda frame: _count_group(frame, buckets, group_many), ROWS_DDL))
    candidates = counted.filter(F.col("kind") == CANDIDATE)
    runs = cut(
        source.select("doc", "key", "text", "bucket").groupBy("bucket")
        .cogroup(candidates.groupBy("bucket")).applyInPandas(_suffix_run, ROWS_DDL))
    suffix_runs = runs.filter(F.col("kind") == CANDIDATE)
    ranges = fanout(spark)
    size = suffix_runs.agg(F.sum(F.length("body"))).first()[0] or 0
    step = max(16, size // 20 // SAMPLE_KEYS)     # a suffix takes over 20 bytes of a run
    keys = sorted(r[0] for r in suffix_runs.mapInArrow(lambda it: _sample_keys(it, step), "sample binary").collect())
    splitters = sorted({bytes(keys[len(keys) * i // ranges]) for i in range(1, ranges)}) if keys else []
    merged = (
        suffix_runs.mapInArrow(lambda it: _cut_runs(it, splitters), ROWS_DDL)
        .groupBy("bucket").applyInPandas(_merge_range, ROWS_DDL))
    covered = counted.filter(F.col("kind") == COVERED).unionByName(
        runs.filter(F.col("kind") == COVERED)).unionByName(merged)

    names = [f"c{i}" for i in range(len(wanted))]
    kinds = dict(docs.select(*wanted).dtypes)
    schema = ", ".join([f"{n} {kinds[c]}" for n, c in zip(names, wanted, strict=True)]
                       + ["n_bytes long, kept binary, span_starts array<long>, span_ends array<long>"])
    held = source.select("doc", "key", "text", "bucket",
                         *[F.col("carried")[c].alias(n) for n, c in zip(names, wanted, strict=True)])
    kept = held.groupBy("bucket").cogroup(covered.groupBy("bucket")).applyInArrow(
        lambda d, r: _kept(d, r, names), schema)
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, wanted, strict=True)], "n_bytes", "kept", "span_starts",
                       "span_ends")
