"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by at
most two: a replacement takes one letter and adds another, an insertion adds
one. So the neighbours of a word lie in a small box around its count vector,
one box among words of its own length and one among words a letter longer. A
k-d tree per length splits the words; a search goes down only into nodes whose
box is in reach (letters that the query lacks, letters that it has too many),
and what is left is compared letter by letter.

Spark deals the work: the top of each tree, fitted on a bounded sample of the
words, cuts the words of a length into cells; every word is a point of one
cell and a query of the cells in its reach. Cells with many points or queries
are dealt out in blocks, and each block has a tree of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import ship, written

#: The letters of a word, after A-Z became a-z.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Words that the tops of all trees are fitted on (a bound; every word is a point and a query).
SAMPLE_WORDS = 1 << 16
#: Words that a cell should hold, and the most points and queries of a block.
CELL_WORDS, BLOCK_POINTS, BLOCK_QUERIES = 1 << 13, 1 << 14, 1 << 16
#: Queries that one numpy step searches for, and the points of a leaf.
STEP_QUERIES, LEAF = 1 << 10, 8

_COLUMN = np.zeros(256, np.int64)
_COLUMN[97:123] = np.arange(26)
_COLUMN[0xC0:0x100] = 26 + np.arange(64)
_WIDTH = 90


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters (all are Latin-1)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n, size = codes.shape
    at = np.arange(n)[:, None] * _WIDTH + _COLUMN[codes]
    kind = np.int8 if size < 127 else np.int32
    return np.bincount(at.ravel(), minlength=n * _WIDTH).reshape(n, _WIDTH).astype(kind)


class KdTree:
    """K-d tree over count vectors; each node splits its widest-spread letter at the median.

    A node's box bounds its own vectors (``closed``) or is the part of space
    that its splits leave (for vectors that come later).
    """

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, closed: bool = True):
        self.order = np.arange(len(vectors))
        kind = vectors.dtype
        box = (np.zeros(_WIDTH, kind), np.full(_WIDTH, np.iinfo(kind).max, kind))
        self.split: list[tuple[int, int]] = []
        spans, low, high, children = [(0, len(vectors))], [box[0]], [box[1]], [(-1, -1)]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = spans[node]
            mine = vectors[self.order[lo:hi]]
            if closed and hi > lo:
                low[node], high[node] = mine.min(0), mine.max(0)
            if hi - lo <= leaf:
                continue
            dim = int(mine.var(0).argmax())
            values = mine[:, dim]
            most = int(values.max())
            if most == int(values.min()):
                continue                                                 # equal vectors
            at = min(int(np.median(values)), most - 1)
            below = values <= at
            part = self.order[lo:hi]
            self.order[lo:hi] = np.concatenate([part[below], part[~below]])
            mid = lo + int(below.sum())
            left_high, right_low = high[node].copy(), low[node].copy()
            left_high[dim], right_low[dim] = at, at + 1
            children[node] = (len(spans), len(spans) + 1)
            self.split.append((node, dim * (1 << 32) + at))
            spans += [(lo, mid), (mid, hi)]
            low += [low[node], right_low]
            high += [left_high, high[node]]
            children += [(-1, -1), (-1, -1)]
            todo += [len(spans) - 2, len(spans) - 1]
        self.span, self.child = np.array(spans), np.array(children)
        self.low, self.high = np.array(low), np.array(high)
        self.dim, self.at = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
        for node, coded in self.split:
            self.dim[node], self.at[node] = coded >> 32, coded & 0xFFFFFFFF

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf whose part of space holds each vector."""
        node = np.zeros(len(vectors), np.int64)
        inner = np.flatnonzero(self.child[node, 0] >= 0)
        while len(inner):
            right = vectors[inner, self.dim[node[inner]]] > self.at[node[inner]]
            node[inner] = self.child[node[inner], right.astype(np.int64)]
            inner = inner[self.child[node[inner], 0] >= 0]
        return node

    def leaves_in_reach(self, queries: np.ndarray, more: int, fewer: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs: the leaf's box holds a vector with at most ``more``
        letters added to the query's and at most ``fewer`` taken away."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found_q, found = [], []
        while len(q):
            mine = queries[q]
            near = ((np.maximum(self.low[node], mine) - mine).sum(1, dtype=np.int64) <= more)
            near &= (mine - np.minimum(self.high[node], mine)).sum(1, dtype=np.int64) <= fewer
            q, node = q[near], node[near]
            at_leaf = self.child[node, 0] < 0
            found_q.append(q[at_leaf])
            found.append(node[at_leaf])
            q, node = np.repeat(q[~at_leaf], 2), self.child[node[~at_leaf]].ravel()
        return np.concatenate(found_q), np.concatenate(found)

    def points_in_reach(self, vectors: np.ndarray, queries: np.ndarray, more: int, fewer: int):
        """(query, point) pairs whose vectors differ by exactly ``more`` added and ``fewer`` taken letters."""
        q, leaf = self.leaves_in_reach(queries, more, fewer)
        size = self.span[leaf, 1] - self.span[leaf, 0]
        q = np.repeat(q, size)
        p = self.order[np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.span[leaf, 0], size)]
        kept_q, kept_p = [], []
        for lo in range(0, len(q), 1 << 18):
            a, b = queries[q[lo:lo + (1 << 18)]], vectors[p[lo:lo + (1 << 18)]]
            both = np.minimum(a, b)
            same = ((b - both).sum(1, dtype=np.int64) == more) & ((a - both).sum(1, dtype=np.int64) == fewer)
            kept_q.append(q[lo:lo + (1 << 18)][same])
            kept_p.append(p[lo:lo + (1 << 18)][same])
        return (np.concatenate(kept_q), np.concatenate(kept_p)) if kept_q else (q, p)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each longer row of ``b`` is that of ``a`` with one letter more."""
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


def near_words(points: list[str], queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) index pairs one edit apart; queries are all of the points' length, or all a letter shorter."""
    if not points or not queries:
        return
    longer = len(points[0]) - len(queries[0])
    p_codes, q_codes = letters(points), letters(queries)
    vectors = letter_counts(p_codes)
    tree = KdTree(vectors)
    verify, fewer = (one_inserted, 0) if longer else (one_replaced, 1)
    for lo in range(0, len(queries), STEP_QUERIES):
        part = q_codes[lo:lo + STEP_QUERIES]
        q, p = tree.points_in_reach(vectors, letter_counts(part).astype(vectors.dtype), 1, fewer)
        for at in range(0, len(q), 1 << 16):
            a, b = q[at:at + (1 << 16)], p[at:at + (1 << 16)]
            right = verify(part[a], p_codes[b])
            yield lo + a[right], b[right]


# -- the corpus --------------------------------------------------------------

def corpus_words(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = 7, least_count: int = 2,
                 every: int = 31) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lower-cased, at least
    ``least_length`` long and ``least_count`` times in all.

    With h the crc32 of ``<key>:<run>``, runs where ``every`` divides h lose
    the letter at h % length first (0 leaves all as they are). A null key is an
    empty one.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1))).alias("run"))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    word: Column = F.col("low")
    if every:
        size = F.char_length("low")
        at = F.pmod(F.col("h"), size).cast("int")
        cut = F.concat(F.substring(F.col("low"), F.lit(1), at), F.substring(F.col("low"), at + 2, size))
        word = F.when(F.col("h") % every == 0, cut).otherwise(word)
    hashed = runs.select("k", low.alias("low")).withColumn("h", F.crc32(F.concat("k", F.lit(":"), "low").cast("binary")))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= least_length)
                  .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def _tops(words: DataFrame) -> dict[int, KdTree]:
    """The top of the tree of each length with more words than a cell, fitted on a sample."""
    sizes = {r["size"]: r["n"] for r in words.groupBy(F.char_length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    large = {s for s, n in sizes.items() if n > CELL_WORDS}
    if not large:
        return {}
    share = min(1.0, SAMPLE_WORDS / sum(sizes[s] for s in large))
    chosen = words.where(F.char_length("word").isin(list(large))
                         & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
    sample: dict[int, list[str]] = {}
    for r in chosen.select("word").collect():
        sample.setdefault(len(r["word"]), []).append(r["word"])
    # a cell with under 16 words of the sample would be split at random
    return {s: KdTree(letter_counts(letters(sorted(w))), max(16, int(CELL_WORDS * share)), closed=False) for s, w in sample.items()}


_DEALT = "size int, cell int, query boolean, word string, n long"


def _dealt(batches: Iterator[pa.RecordBatch], tops: dict[int, KdTree]) -> Iterator[pa.RecordBatch]:
    """Each word as a point of its cell and as a query of the cells in its reach."""
    for batch in batches:
        words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
        sizes = np.array([len(w) for w in words], np.int64)
        for size in np.unique(sizes):
            mine = np.flatnonzero(sizes == size)
            for lo in range(0, len(mine), STEP_QUERIES):
                at = mine[lo:lo + STEP_QUERIES]
                vectors = letter_counts(letters(list(words[at])))
                rows = [(size, _cells(tops.get(int(size)), vectors), None, False)]
                for longer, fewer in ((0, 1), (1, 0)):
                    tree = tops.get(int(size) + longer)
                    if tree is None:
                        rows.append((size + longer, np.zeros(len(at), np.int64), None, True))
                    else:
                        q, cell = tree.leaves_in_reach(vectors.astype(tree.low.dtype), 1, fewer)
                        rows.append((size + longer, cell, q, True))
                for of, cell, which, query in rows:
                    which = at if which is None else at[which]
                    k = len(which)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, of, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(k, query)),
                         pa.array(list(words[which]), pa.string()), pa.array(n[which])], names=["size", "cell", "query", "word", "n"])


def _cells(tree: KdTree | None, vectors: np.ndarray) -> np.ndarray:
    return np.zeros(len(vectors), np.int64) if tree is None else tree.leaf_of(vectors)


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    size = int(block["size"].iat[0])
    words, n, asked = block["word"].to_numpy(object), block["n"].to_numpy(), block["query"].to_numpy()
    length = np.array([len(w) for w in words])
    points = np.flatnonzero(~asked)
    out = [np.zeros((2, 0), np.int64)]
    for of in (size, size - 1):
        queries = np.flatnonzero(asked & (length == of))
        for q, p in near_words(list(words[points]), list(words[queries])):
            pair = np.stack([queries[q], points[p]])
            out += [pair] if of == size else [pair, pair[::-1]]
    a, b = np.concatenate(out, axis=1)
    return pd.DataFrame({"word": words[a], "near": words[b], "near_n": n[b]})


def near_pairs(words: DataFrame) -> DataFrame:
    """All ordered pairs of words one edit apart: word, near, near_n. ``words``: distinct word, n."""
    ship(words.sparkSession)
    tops = _tops(words)
    dealt = written(words.select("word", "n").mapInArrow(lambda b: _dealt(b, tops), _DEALT), "spelling-dealt")
    held = dealt.groupBy("size", "cell").agg(F.count_if(~F.col("query")).alias("p"), F.count_if("query").alias("q")).where("p > 0 and q > 0")
    held = held.select("size", "cell", F.ceil(F.col("p") / BLOCK_POINTS).alias("pb"), F.ceil(F.col("q") / BLOCK_QUERIES).alias("qb"))
    own = F.xxhash64("word", "query")
    placed = dealt.join(held, ["size", "cell"])
    points = placed.where(~F.col("query")).withColumn("i", F.pmod(own, "pb")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)))
    queries = placed.where("query").withColumn("j", F.pmod(own, "qb")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pb") - 1)))
    columns = ["size", "cell", "i", "j", "query", "word", "n"]
    blocks = points.select(*columns).unionByName(queries.select(*columns))
    return blocks.groupBy("size", "cell", "i", "j").applyInPandas(_block_pairs, "word string, near string, near_n long")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """Forms of words: word, form, root, n, n_near, form_n.

    ``words`` has distinct ``word`` and its count ``n``. ``form`` is the near
    word of largest n (ties: smallest in code-point order) if that n is at
    least ``times`` the word's own, else null; ``root`` follows forms to the
    last one (the word itself if it has none); ``n_near`` counts near words.
    No words, no rows.
    """
    words = written(words.select("word", "n"), "spelling-words")
    best = (near_pairs(words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b")))
    strong = -F.col("b.less") >= F.col("n") * times
    formed = written(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("b.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("b.less")).alias("form_n")), "spelling-forms")
    # each round doubles the way; counts grow tenfold a step, so the way is short
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        roots = written(roots, "spelling-roots")
        if roots.where("moved").isEmpty():
            break
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.drop("moved").join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
    return (formed.join(roots.select("word", "root"), "word", "left")
                  .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = 7, least_count: int = 2,
                      every: int = 31, times: int = 10) -> DataFrame:
    """``variants`` of the words of a corpus (``corpus_words``).

    Null texts have no words, a null key is an empty one, repeated rows count
    again, an empty table gives no rows, and other columns are not read.
    """
    return variants(corpus_words(docs, text, key, least_length, least_count, every), times)
