"""Near-duplicate classes by Order MinHash.

A text is a sequence of three-word shingles; equal shingles are told apart by
their occurrence number.  Each of BANDS hash functions picks the TUPLE
smallest labelled shingles and keeps them in text order, so that a band
agrees only if the picked shingles are shared *and* equally ordered.  Texts
of fewer than SHORT_WORDS words, of which few shingles survive an edit, have
SHORT_BANDS further bands, each of one two-word shingle.  Texts whose lengths
allow it and that agree in any band are candidates.

Candidates are verified by a banded alignment of their words: similarity is
the number of aligned equal words over the length of the longer text, and the
band is as wide as the threshold allows, so it loses nothing.  Before it,
pairs whose word counts alone rule the similarity out are left; that loses
nothing either.  Measured on planted pairs of similarity 0.8: single words
changed at random places agree in no band in 0.5 % of pairs, every fifth word
changed in 4 %.

Equal texts are collapsed first.  Each remaining text is first compared with
two leaders of each of its buckets; only buckets that then still hold texts
of different classes are compared across, in blocks of bounded size.  Every
candidate pair is thus verified or known to lie in one class.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import Tables, slices
from perfwatch.llm.suffix_dedup import _prefix_hashes

SHINGLE_WORDS = 3
SIMILARITY = 0.8
BANDS = 48
TUPLE = 2
SHORT_WORDS = 40        # texts of fewer words have the short bands as well
SHORT_SHINGLE = 2
SHORT_BANDS = 32
COUNT_CELLS = 256       # cells of the word counts that pairs are held against first
BLOCK = 2048            # rows of one block of a bucket
CHUNK_BYTES = 1 << 19
NO_ID = -(2**63)

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ODD = np.uint64(0x94D049BB133111EB)
_SEEDS = np.random.default_rng(97).integers(1, 2**63, BANDS, dtype=np.uint64)
_SHORT_SEEDS = np.random.default_rng(89).integers(1, 2**63, SHORT_BANDS, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(32)
    x *= _ODD
    x ^= x >> np.uint64(29)
    return x


def word_spans(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end; ``gap`` marks the bytes between words."""
    word = ~gap[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    start = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])))
    end = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False))) + 1
    return start, end


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and each text's first index."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    start, end = word_spans(data, bounds)
    return hashed_spans(data, start, end), np.searchsorted(start, bounds)


def hashed_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums, power = _prefix_hashes(data)
    words = (sums[end] - sums[start]) * power[start]
    words ^= words >> np.uint64(31)
    return _mixed(words + (end - start).astype(np.uint64))


def labelled_shingles(words: np.ndarray, first: np.ndarray, length: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled shingles in text order, and each
    text's first index.  A text of fewer than ``length`` words is one
    shingle; one without a word has none."""
    texts = len(first) - 1
    count = np.diff(first)
    shingles = np.where(count >= length, count - length + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(shingles)])
    owner = np.repeat(np.arange(texts), shingles)
    at = first[owner] + np.arange(begin[-1]) - begin[owner]
    value = np.zeros(len(at), dtype=np.uint64)
    for j in range(length):
        there = at + j < first[owner + 1]
        value = value * _ODD + np.where(there, words[np.minimum(at + j, len(words) - 1)], np.uint64(0))
    value = _mixed(value)
    order = np.lexsort((value, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (value[order][1:] != value[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    occurrence = np.arange(len(order)) - np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    label = np.empty(len(order), dtype=np.uint64)
    label[order] = occurrence.astype(np.uint64)
    return _mixed(value + label * np.uint64(0x9E3779B97F4A7C15)), begin


def sketches(labelled: np.ndarray, begin: np.ndarray, seeds: np.ndarray = _SEEDS, picks: int = TUPLE) -> np.ndarray:
    """(texts x seeds) band keys; texts without a shingle have zeros."""
    size = np.diff(begin)
    out = np.zeros((len(size), len(seeds)), dtype=np.uint64)
    some = np.flatnonzero(size)
    if not len(some):
        return out
    owner = np.repeat(np.arange(len(size)), size)
    # all but a few values are too large to be among the smallest: look at about 10 per text
    limit = np.where(size > 20, (10.0 / np.maximum(size, 1)) * 2.0**64, 2.0**64 - 4096).astype(np.uint64)
    limit_of = limit[owner]
    for band, seed in enumerate(seeds):
        value = _mixed(labelled ^ seed)
        small = np.flatnonzero(value <= limit_of)
        order = small[np.lexsort((value[small], owner[small]))]
        head = np.searchsorted(owner[order], np.arange(len(size)))
        found = np.diff(np.append(head, len(order)))
        need = np.minimum(size, picks)
        picked = np.full((len(size), picks), -1, dtype=np.int64)
        for j in range(picks):
            have = (found > j) & (j < need)
            picked[have, j] = order[head[have] + j]
        for text in np.flatnonzero(found < need):
            own = np.arange(begin[text], begin[text + 1])
            best = own[np.argsort(value[own], kind="stable")[:picks]]
            picked[text] = -1
            picked[text, :len(best)] = best
        picked.sort(axis=1)     # back to text order
        key = np.full(len(size), seed, dtype=np.uint64)
        for j in range(picks):
            key = _mixed(key + np.where(picked[:, j] >= 0, labelled[picked[:, j]], np.uint64(1)))
        out[some, band] = key[some]
    return out


def band_keys(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Each text's band keys; those of the short bands come last, where it has them."""
    keys = list(sketches(*labelled_shingles(words, first)))
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < SHORT_WORDS))
    if len(short):
        own = np.concatenate([words[first[t]:first[t + 1]] for t in short])
        labelled, begin = labelled_shingles(own, np.concatenate([[0], np.cumsum(count[short])]), SHORT_SHINGLE)
        for t, more in zip(short.tolist(), sketches(labelled, begin, _SHORT_SEEDS, 1), strict=True):
            keys[t] = np.concatenate([keys[t], more])
    return keys


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts of about CHUNK_BYTES: first, end, bytes, bounds."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK_BYTES or i == len(texts) - 1:
            part = texts[first:i + 1]
            yield first, i + 1, np.frombuffer(b"".join(part), np.uint8), np.cumsum([0] + [len(t) for t in part])
            first, held = i + 1, 0


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column(3).to_pylist()
        for a, b, data, bounds in chunks(texts):
            words, first = word_hashes(data, bounds)
            keys = band_keys(words, first)
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(k) for k in keys]), pa.int32()),
                                             pa.array(np.concatenate(keys).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in range(3)] + [pa.array(np.diff(first), pa.int64()), bands],
                names=["doc", "t1", "t2", "words", "bands"])


def _sequence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for a, b, data, bounds in chunks(batch.column(1).to_pylist()):
            words, first = word_hashes(data, bounds)
            short = words.astype("<u4")      # pairs are compared, not the corpus: 32 bits tell words apart
            bodies = [short[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in (0, 2, 3)] + [pa.array(bodies, pa.binary())],
                names=["node", "words", "bands", "sequence"])


def word_counts(words: np.ndarray) -> np.ndarray:
    """How many words fall into each of COUNT_CELLS cells: the sum of the lesser
    counts of two texts is at least the number of words any alignment can match."""
    return np.bincount(words % COUNT_CELLS, minlength=COUNT_CELLS).astype(np.int32)


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Equal words in the best order-keeping alignment over the longer length;
    0.0 where it cannot reach ``least``.

    With m matches required, a matched pair lies at most max(|a|, |b|) - m off
    the diagonal: the band.  One row of the alignment table is one whole
    number, a bit per word of ``a``, so a row costs a few additions.
    """
    longer = max(len(a), len(b))
    need = int(np.ceil(least * longer - 1e-9))
    if min(len(a), len(b)) < need:
        return 0.0
    same = a[:min(len(a), len(b))] == b[:min(len(a), len(b))]
    head = len(same) if same.all() else int(same.argmin())
    rest = min(len(a), len(b)) - head
    tail = 0
    if rest:
        same = a[len(a) - rest:][::-1] == b[len(b) - rest:][::-1]
        tail = rest if same.all() else int(same.argmin())
    left, right = a[head:len(a) - tail].tolist(), b[head:len(b) - tail].tolist()
    band = longer - need
    if not left or not right:
        return (head + tail) / longer if head + tail >= need else 0.0
    if np.minimum(word_counts(a), word_counts(b)).sum() < need:
        return 0.0
    places: dict[int, int] = {}
    for i, word in enumerate(left):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(left)) - 1
    window = (1 << 2 * band + 1) - 1
    row = full
    for j, word in enumerate(right):
        match = places.get(word)
        if match:
            shift = j - band
            match &= window << shift if shift >= 0 else window >> -shift
            step = row & match
            if step:
                row = (row + step | row - step) & full
    matched = head + tail + len(left) - row.bit_count()
    return matched / longer if matched >= need else 0.0


def _verify(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
        rows = [(x, y) for x, y, s, t in zip(a, b, left, right, strict=True)
                if aligned_similarity(np.frombuffer(s, "<u4"), np.frombuffer(t, "<u4"), least) >= least]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                          pa.array([r[1] for r in rows], pa.int64())], names=["a", "b"])


def _cross_links(table: pa.Table, least: float) -> pa.Table:
    """Classes (by their roots) that one block pair of a bucket links: verified
    pairs of texts of different classes whose lengths and word counts allow
    the similarity.  A pair is looked at only in the least band it shares, and
    no more once links found before have joined its classes.  ``bands`` are
    those a text shares at all."""
    node, group, side, words = (table.column(c).to_numpy() for c in ("node", "root", "side", "words"))
    here = table.column("band")[0].as_py()
    earlier = [{key for key in keys if key < here} for keys in table.column("bands").to_pylist()]
    texts = [np.frombuffer(s, "<u4") for s in table.column("sequence").to_pylist()]
    counts = np.array([word_counts(t) for t in texts])
    square = side.min() == side.max()
    left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    a, b = [], []
    for i in left.tolist():
        need = least * np.maximum(words[right], words[i]) - 1e-9
        fit = (group[right] != group[i]) & (np.minimum(words[right], words[i]) >= need)
        if square:
            fit &= node[right] > node[i]
        others = right[fit]
        others = others[np.minimum(counts[others], counts[i]).sum(axis=1) >= need[fit]]
        for j in others.tolist():
            x, y = root(int(group[i])), root(int(group[j]))
            if x != y and earlier[i].isdisjoint(earlier[j]) and aligned_similarity(texts[i], texts[j], least) >= least:
                above[max(x, y)] = min(x, y)
                a.append(int(group[i]))
                b.append(int(group[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def components(edges: DataFrame, tables: Tables | None = None, name: str = "components") -> DataFrame:
    """(node, root) of every node with an edge; root: the smallest node of its
    component.  Large-star and small-star steps in turn.  Each step is a
    compressed table, removed when the next is written: its reader has tasks
    by bytes, not by the shuffle width, so that rounds of few rows leave few
    shuffle files.  Only two numbers a round reach the driver."""
    tables = tables or Tables(edges.sparkSession, "components")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = tables.cut(edges, f"{name}-0")
    state, done = None, 0
    while True:
        # a node's greater neighbours go to the least of the node and its neighbours
        least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        large = tables.cut(edges.join(least, F.col("b") == F.col("node"), "left").select("a", F.coalesce("m", "b").alias("b")),
                           f"{name}-large")
        # a node and its lesser neighbours go to the least of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        edges = tables.cut(small, f"{name}-{done + 1}")
        tables.drop(f"{name}-{done}", f"{name}-large")
        done += 1
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    roots = edges.select("b").distinct()
    found = tables.cut(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))), name)
    tables.drop(f"{name}-{done}")
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, class_id (smallest id of its class),
    class_rows (rows in the class), kept (true for exactly one row of a class)
    and text_key (hash of the text).

    * Classes are the components of the verified links, copies included.
    * NULL text counts as empty; texts without a word are like each other only
      if they are equal.  A NULL id sorts first and is returned as NULL.
    * Of repeated rows exactly one can be kept.  An empty table gives no
      rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                         F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(3)).alias("t2"), text.alias("text"))
    tables = Tables(docs.sparkSession, "near")
    sketches = tables.cut(source.mapInArrow(_sketch_rows, "doc long, t1 long, t2 long, words long, bands array<long>")
                          .withColumn("row", F.monotonically_increasing_id()), "sketches")
    rows = tables.cut(sketches.select("doc", "t1", "t2", "row", "words"), "rows")
    # equal texts: the row of the smallest id stands for all
    nodes = tables.cut(
        rows.groupBy("t1", "t2").agg(F.min(F.struct("doc", "row")).alias("lead"), F.count("*").alias("copies"),
                                     F.first("words").alias("words"))
        .select("t1", "t2", F.col("lead.doc").alias("doc"), F.col("lead.row").alias("node"), "copies", "words"), "nodes")
    worded = nodes.filter("words > 0")
    keyed = sketches.select(F.col("row").alias("node"), "bands").join(worded.select("node"), "node", "left_semi").select(
        "node", F.explode("bands").alias("band"))
    leads = keyed.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    shared = tables.cut(keyed.join(leads, "band").select("band", "node", "low", "high"), "shared")
    tables.drop("sketches")
    near = shared.select("node", F.explode(F.array("low", "high")).alias("lead")).filter("node <> lead").select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()

    # from here on a text's bands are those that it shares with another
    wanted = worded.join(shared.groupBy("node").agg(F.collect_list("band").alias("bands")), "node").select(
        "doc", "t1", "t2", "node", "words", "bands")
    sequences = tables.cut(
        source.join(wanted, ["doc", "t1", "t2"]).select("node", "text", "words", "bands").mapInArrow(
            _sequence_rows, "node long, words long, bands array<long>, sequence binary").dropDuplicates(["node"]), "sequences")

    def verified(pairs: DataFrame) -> DataFrame:
        left = sequences.select(F.col("node").alias("a"), F.col("sequence").alias("left"))
        right = sequences.select(F.col("node").alias("b"), F.col("sequence").alias("right"))
        of_a, of_b = (sequences.select(F.col("node").alias(n), F.col("words").alias(f"words_{n}")) for n in "ab")
        fits = F.least("words_a", "words_b") >= F.lit(similarity) * F.greatest("words_a", "words_b") - F.lit(1e-9)
        # lengths first: sequences travel only with pairs that may be similar
        pairs = pairs.join(of_a, "a").join(of_b, "b").filter(fits).select("a", "b")
        return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(
            lambda batches: _verify(batches, similarity), "a long, b long")

    classes = components(verified(near), tables, "classes")
    # buckets that still hold more than one class, in blocks of at most BLOCK rows
    placed = shared.select("band", "node").join(classes, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")
                                       ).filter("low <> high").select("band", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    blocks = (
        placed.join(mixed, "band")
        .withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("band", "node", "root", F.col("own").alias("side"), F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j")))
    more = (
        blocks.join(sequences, "node").groupBy("band", "i", "j")
        .applyInArrow(lambda table: _cross_links(table, similarity), "a long, b long"))
    # these links are between classes: only classes are joined anew
    joined = components(more, tables, "joined").select(F.col("node").alias("root"), F.col("root").alias("into"))
    tables.drop("shared", "sequences")

    rooted = (
        nodes.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node")).join(joined, "root", "left")
        .select("t1", "t2", "doc", "node", "copies", F.coalesce("into", "root").alias("root")))
    named = rooted.groupBy("root").agg(F.min(F.struct("doc", "node")).alias("lead"), F.sum("copies").alias("class_rows"))
    member = rooted.join(named, "root").select("t1", "t2", F.col("lead.doc").alias("class_doc"),
                                               F.col("lead.node").alias("class_row"), "class_rows")

    def shown(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column))

    return rows.select("doc", "row", "t1", "t2").join(member, ["t1", "t2"]).select(
        shown("doc").alias("doc_id"), shown("class_doc").alias("class_id"), "class_rows",
        (F.col("row") == F.col("class_row")).alias("kept"), F.col("t1").alias("text_key"))
