"""Spelling variants, grouped through a trie of letter-group counts.

Words (runs of Latin letters, A-Z in lower case) are counted over all texts.
Two frequent words are near if one inserted, deleted or replaced letter turns
one into the other; a word's form is its near word of the largest count, if
that is large enough, and its root is where the forms lead.

Letters fall into ``LEVELS`` groups by code point.  A word's counts per group
are its path in the trie.  One edit changes them by a surplus of one, a deficit
of one, or one of each, so a depth-first search follows the word's own path
and spends that budget of one each; the words at the leaves it reaches are
verified.  Every pair is met once: a word looks for shorter words, and for
words of its length whose counts come later in the trie's order.

Spark descends the first levels: index rows take their own child, searching
rows every child their budget allows (11 rows a word for three levels).  Nodes
of more than ``NODE_WORDS`` words descend further, level by level, so no task
holds a trie beyond that size unless its words agree in all counts.  Leaves
are looked up by equal halves of words, so words are not compared all against
all.  Counting words combines in the map tasks; a frequent word is no hot key.

Defined cases: NULL and empty texts have no words; a missing id is the empty
text where letters are deleted; a word without near words has n_near 0 and is
its own root; equal counts are told apart by code-point order; rows that
repeat count each.  No words give an empty result.
"""
from __future__ import annotations

from operator import ne

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.llm._common import cut

LETTERS = "a-zÀ-ÿ"
LEVELS = 13
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST_LEVELS = 3
NODE_WORDS = 20_000
LEAF_WORDS = 4


#: code points modulo 13 in the order of the trie's levels: those of e, a, i, o, t and s, which tell most, come first
RESIDUES = (10, 6, 1, 7, 12, 11, 3, 0, 8, 9, 2, 4, 5)


def level_of(letter: str) -> int:
    """The group of a letter."""
    return RESIDUES.index(ord(letter) % LEVELS)


ALL_LETTERS = [*LOWER, *map(chr, range(0xC0, 0x100))]
GROUP_LETTERS = ["".join(x for x in ALL_LETTERS if level_of(x) == level) for level in range(LEVELS)]
BYTE_LEVELS = bytes(level_of(chr(b)) if chr(b) in ALL_LETTERS else 255 for b in range(256))   # Latin-1 byte: group


def occurrences(df: DataFrame, id_col: str, text_col: str, delete_one_in: int | None, least_chars: int) -> DataFrame:
    """(word): every run of letters of at least ``least_chars``; of one in
    ``delete_one_in``, by a checksum of id and run, one letter is deleted."""
    folded = F.translate(text_col, UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(folded, F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0)))
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), run.alias("word"))
    if delete_one_in is not None:
        runs = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary")))
        at = (F.col("_h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("word", F.when(F.col("_h") % delete_one_in == 0, shorter).otherwise(F.col("word")))
    return runs.filter(F.length("word") >= least_chars).select("word")


def is_near(word: str, other: str) -> bool:
    """Whether exactly one edit parts ``word`` from ``other``, which is as long or one shorter."""
    half = len(other) // 2
    longer = len(word) - len(other)
    if word[:half] == other[:half]:
        a, b = word[half:], other[half:]
    elif word[half + longer:] == other[half:]:
        a, b = word[:half + longer], other[:half]
    else:
        return False
    if not longer:
        return sum(map(ne, a, b)) == 1
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1:] == b[at:]


class Leaf:
    """Words at the end of a path, in large leaves found by their halves."""

    def __init__(self, words: list[str]):
        self.words, self.firsts, self.lasts = words, None, None

    def candidates(self, word: str) -> list[str]:
        if len(self.words) <= LEAF_WORDS:
            return self.words
        half = len(self.words[0]) // 2   # all words of a node are equally long
        if self.firsts is None:
            self.firsts, self.lasts = {}, {}
            for w in self.words:
                self.firsts.setdefault(w[:half], []).append(w)
                self.lasts.setdefault(w[half:], []).append(w)
        first = word[:half]
        last = word[half + len(word) - len(self.words[0]):]
        return [*self.firsts.get(first, ()), *(w for w in self.lasts.get(last, ()) if w[:half] != first)]


class Counts:
    """A word's counts per level, each computed when a search comes to it."""

    def __init__(self, word: str):
        self.levels, self.known = word.encode("latin-1").translate(BYTE_LEVELS), {}

    def __getitem__(self, level: int) -> int:
        if level not in self.known:
            self.known[level] = self.levels.count(level)
        return self.known[level]

    def path(self) -> tuple:
        return tuple(self[level] for level in range(LEVELS))


def build(words: list[str], level: int):
    """The trie below ``level``: a dict from count to child, or a Leaf."""
    if len(words) <= LEAF_WORDS or level == LEVELS:
        return Leaf(words)
    below: dict[int, list[str]] = {}
    for word in words:
        below.setdefault(word.encode("latin-1").translate(BYTE_LEVELS).count(level), []).append(word)
    return {count: build(part, level + 1) for count, part in below.items()}


def search(node, level: int, word: str, counts: Counts, surplus: int, deficit: int, undecided: bool, found: list) -> None:
    """Append the words near ``word`` below ``node``.  ``undecided``: the path
    is the word's own so far, so only later paths are its business."""
    if isinstance(node, Leaf):
        for other in node.candidates(word):
            if is_near(word, other) and (not undecided or (counts.path(), word) < (Counts(other).path(), other)):
                found.append(other)
        return
    count = counts[level]
    below = node.get(count)
    if below is not None:
        search(below, level + 1, word, counts, surplus, deficit, undecided, found)
    if surplus:
        below = node.get(count + 1)
        if below is not None:
            search(below, level + 1, word, counts, 0, deficit, False, found)
    if deficit and not undecided:
        below = node.get(count - 1)
        if below is not None:
            search(below, level + 1, word, counts, surplus, 0, False, found)


def _search_node(rows: pa.Table) -> pa.Table:
    """Pairs of near words of one node of the trie's upper part."""
    words, ns = rows.column("word").to_pylist(), rows.column("n").to_pylist()
    states = list(zip(rows.column("indexed").to_pylist(), rows.column("surplus").to_pylist(),
                      rows.column("deficit").to_pylist(), rows.column("undecided").to_pylist()))
    level = rows.column("level")[0].as_py()
    held = {word: n for word, n, state in zip(words, ns, states) if state[0]}
    out = ([], [], [], [])
    if held:
        trie = build(list(held), level)
        for word, n, (indexed, surplus, deficit, undecided) in zip(words, ns, states):
            if indexed:
                continue
            found: list[str] = []
            search(trie, level, word, Counts(word), surplus, deficit, undecided, found)
            for other in found:
                for column, value in zip(out, (word, n, other, held[other])):
                    column.append(value)
    return pa.table(out, schema=pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())]))


def _level_count(level: int) -> Column:
    return F.length("word") - F.length(F.translate("word", GROUP_LETTERS[level], ""))


def _descend(rows: DataFrame, level: int, where: Column | None = None) -> DataFrame:
    """Rows one level further down (only those that ``where`` holds for)."""
    count = _level_count(level)

    def child(at: Column, allowed: Column, **spent: Column) -> Column:
        state = {"surplus": F.col("surplus"), "deficit": F.col("deficit"), "undecided": F.col("undecided")} | spent
        return F.when(allowed, F.struct(F.concat_ws(",", "node", at).alias("node"), *[v.alias(k) for k, v in state.items()],
                                        F.lit(level + 1).alias("level")))

    below = F.array(
        child(count, F.lit(True)),
        child(count + 1, F.col("surplus") > 0, surplus=F.lit(0), undecided=F.lit(False)),
        child(count - 1, (F.col("deficit") > 0) & ~F.col("undecided") & (count > 0), deficit=F.lit(0)))
    if where is not None:
        stays = F.struct("node", "surplus", "deficit", "undecided", "level")
        below = F.when(where, below).otherwise(F.array(stays))
    return rows.withColumn("_below", F.explode(F.array_compact(below))).select("word", "n", "indexed", "_below.*")


def near_pairs(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words of ``words`` (word, n), once."""
    def start(indexed, change, surplus, deficit, undecided):
        return F.struct(F.lit(indexed).alias("indexed"), (F.length("word") + change).cast("string").alias("node"),
                        F.lit(surplus).alias("surplus"), F.lit(deficit).alias("deficit"), F.lit(undecided).alias("undecided"))

    roles = F.array(start(True, 0, 0, 0, False),     # to be found
                    start(False, 0, 1, 1, True),     # looks for words as long
                    start(False, -1, 0, 1, False))   # looks for words one shorter
    rows = words.select("word", "n", F.inline(roles))
    for level in range(FIRST_LEVELS):
        rows = _descend(rows, level)
    for level in range(FIRST_LEVELS, LEVELS):
        held = rows.filter("indexed").groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
        large = cut(held.filter(F.col("_n") > node_words).select(F.col("node").alias("_large")))
        if large.isEmpty():
            break
        # at most one node per node_words words of the vocabulary
        rows = _descend(rows.join(F.broadcast(large), F.col("node") == F.col("_large"), "left"), level,
                        F.col("_large").isNotNull())
    return rows.groupBy("node").applyInArrow(_search_node, "a string, a_n long, b string, b_n long")


def follow(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) lead in the end.  Every
    round doubles the steps; counts grow along a link, so there are few."""
    reached = cut(links.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("_at"), F.col("root").alias("_beyond"))
        reached = cut(reached.join(further, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_beyond", "root").alias("root"), F.col("_beyond").isNotNull().alias("_moved")))
        if reached.filter("_moved").isEmpty():
            return reached.drop("_moved")


def group_variants(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least_count: int = 5,
                   ratio: int = 5, delete_one_in: int | None = None, node_words: int = NODE_WORDS) -> DataFrame:
    """One row per word found ``least_count`` times or more: word, form, root,
    n, n_near, form_n.  ``delete_one_in`` plants misspellings (None: none).
    ``ratio`` is above 1, so that forms lead to ever larger counts."""
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = cut(occurrences(df, id_col, text_col, delete_one_in, least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= least_count))
    pairs = near_pairs(words, node_words)
    none = F.lit(None)
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), none.cast("long").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), none.cast("long").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))))
    own = words.select("word", "n", none.cast("string").alias("near"), none.cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))))
    told = own.unionAll(sides).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("_best"))
    has_form = -F.col("_best.n") >= ratio * F.col("n")
    told = cut(told.select("word", "n", "n_near", F.when(has_form, F.col("_best.word")).alias("form"),
                           F.when(has_form, -F.col("_best.n")).alias("form_n")))
    roots = follow(told.filter("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle(delete_one_in: int = 199, least_chars: int = 6, least_count: int = 5, ratio: int = 5) -> str:
    """DuckDB SQL: near words share what is left when one letter is taken out."""
    return f"""
WITH RECURSIVE steps(n, byte, r) AS (
    SELECT 0, i, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT n + 1, byte, CASE WHEN r & 1 = 1 THEN xor(3988292384, r >> 1) ELSE r >> 1 END FROM steps WHERE n < 8),
crc_table AS (SELECT list(r ORDER BY byte) AS entries FROM steps WHERE n = 8),
runs AS (
    SELECT doc_id, w, count(*) AS times, hex(encode(doc_id || ':' || w)) AS x
    FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS w FROM documents)
    WHERE length(w) >= {least_chars} GROUP BY doc_id, w),
hashed AS (
    SELECT w, times, xor(4294967295, list_reduce(
        list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
    FROM runs, crc_table),
words AS (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT CASE WHEN h % {delete_one_in} = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, times
        FROM hashed)
    WHERE length(word) >= {least_chars} GROUP BY word HAVING sum(times) >= {least_count}),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS top_n,
           first(other ORDER BY other_n DESC, encode(other)) AS top FROM near GROUP BY word),
told AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN top_n >= {ratio} * words.n THEN top END AS form, CASE WHEN top_n >= {ratio} * words.n THEN top_n END AS form_n
    FROM words LEFT JOIN best ON words.word = best.word),
chain AS (
    SELECT word, word AS at, form AS next FROM told
    UNION ALL
    SELECT chain.word, chain.next, told.form FROM chain JOIN told ON chain.next = told.word)
SELECT told.word, told.form, chain.at AS root, told.n, told.n_near::BIGINT AS n_near, told.form_n::BIGINT AS form_n
FROM told JOIN chain ON told.word = chain.word AND chain.next IS NULL
"""
