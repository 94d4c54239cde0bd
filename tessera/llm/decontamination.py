"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are sequences of words: lower-cased runs of letters, digits and
non-ASCII characters, so case, punctuation and line breaks make no edit. The CGK random walk reads a
sequence symbol by symbol, writing the symbol it stands on and then staying or
moving on by a random bit of (step, symbol); sequences at a small edit
distance stay in step for most of the walk, so their embeddings agree in most
places. Each repetition draws one walk and samples two places of the
embedding, scaled to the item's size; windows of a document that agree with
an item there are candidates. Each item size has its own repetitions, added
until the target part of many copies of its items, with the greatest allowed
number of edits, is found. A size that misses it in ``MOST_REPEATS`` walks is
searched without loss instead, as are sizes that allow no edits: an item within
``k`` edits holds one of ``k + 1`` segments unchanged, so stretches that share
a segment are its candidates.

Every word position of every document starts a window of each item size. A
window that has too few words of the benchmark's vocabulary to lie within the
allowed distance is passed over beforehand, which loses nothing. Candidates
are verified exactly: the edit distance in words between the item and the
best stretch of the document there must be at most ``edits`` times the item's
words.

The benchmark is the query set: its keys go to the tasks in blocks of at most
``BLOCK_ITEMS`` items (a bounded broadcast), and documents are read once a
block without any shuffle.

Edge cases: items without words never match; items of under four words match
within zero edits; null and empty texts have no windows; very long texts are
searched whole; repeated rows each give their rows; equal items all match; an
empty table on either side gives an empty result; only key and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import STEP_BYTES, as_row, from_row, mixed, ship, span_hashes, text_steps, word_spans, written

#: Allowed edits as a part of the item's words.
EDITS = 0.2
RECALL = 0.98
SAMPLES = 2
MOST_REPEATS = 64
#: Edited copies by which a size's repetitions are judged, at least.
COPIES = 400
BLOCK_ITEMS = 20_000
_VOCABULARY_BITS, _KEY_BITS = 22, 20
_PAIR_BITS = 22
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _NOT_WORD[_a:_b] = False


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a piece of lower-cased text, and first word per text."""
    starts, ends, first = word_spans(data, offsets, _NOT_WORD)
    return span_hashes(data, starts, ends), first


def size_class(n):
    """Window size that stands for items of ``n`` words: ``n`` to the next lower multiple of four."""
    n = np.asarray(n)
    return np.where(n < 4, n, n // 4 * 4)


@lru_cache(None)
def _odd(rep: int, step: int) -> np.uint64:
    return mixed(np.array([rep * 8191 + step + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1)


@lru_cache(None)
def _places(rep: int, size: int) -> list[int]:
    """Sampled places of the embedding for windows of ``size`` words."""
    u = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) + np.uint64(rep * 131 + 77)).astype(float) / 2.0 ** 64
    return sorted(int(x * max(1, 1.6 * size)) for x in u)


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, rep: int,
              members: dict[int, np.ndarray], longest: np.ndarray) -> dict[int, np.ndarray]:
    """Keys of one walk: for each size the keys of its windows (``members``: indices into ``starts``).

    ``starts`` are sorted by falling ``longest`` size, so that late steps only
    walk the windows that still need them.
    """
    need = {s: _places(rep, s) for s in members}
    wanted = {t for places in need.values() for t in places}
    seen: dict[int, np.ndarray] = {}
    at = starts.copy()
    last = max(wanted, default=-1)
    for t in range(last + 1):
        live = int(np.searchsorted(-longest, -(t / 1.6), "right")) if t else len(starts)
        at = at[:live]
        inside = at < ends[:live]
        symbol = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        if t in wanted:
            seen[t] = symbol
        at = at + ((symbol + np.uint64(t)) * _odd(rep, t) >> np.uint64(63)).astype(np.int64)
    out = {}
    for s, idx in members.items():
        h = np.full(len(idx), np.uint64(s * 1009 + rep), np.uint64)
        for t in need[s]:
            h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + seen[t][idx])
        out[s] = h
    return out


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one."""
    return mixed(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word that has as many after it."""
    m = max(len(words) - n + 1, 0)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + words[j:j + m])
    return h


@dataclass
class Items:
    """Benchmark items as word arrays with the sorted keys of all repetitions."""

    ids: list
    words: list[np.ndarray]
    edits: float
    repeats: int = 0
    keys: np.ndarray | None = None
    owners: np.ndarray | None = None
    rounds: dict[int, int] = field(default_factory=dict)        # repetitions of each size; 0: by segments
    segments: dict[int, tuple] = field(default_factory=dict)    # by length: sorted hashes, owners, places in the item

    def __post_init__(self):
        self.sizes = size_class([len(w) for w in self.words]).astype(np.int64)
        self.allowed = np.array([int(self.edits * len(w)) if len(w) >= 4 else 0 for w in self.words], np.int64)
        self.slack = {int(s): int(self.allowed[self.sizes == s].max()) for s in np.unique(self.sizes)}
        self.half = np.maximum(2, np.array([len(w) for w in self.words], np.int64) // 2)
        self.vocabulary = np.zeros(1 << _VOCABULARY_BITS, bool)
        if self.words:
            self.vocabulary[np.concatenate(self.words) >> np.uint64(64 - _VOCABULARY_BITS)] = True
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        for w in self.words:
            self.pairs[pair_hashes(w) >> np.uint64(64 - _PAIR_BITS)] = True

    @staticmethod
    def _windows(texts: list[np.ndarray], sizes: np.ndarray):
        flat = np.concatenate(texts)
        stop = np.cumsum([len(t) for t in texts])
        start = stop - [len(t) for t in texts]
        order = np.argsort(-sizes, kind="stable")
        members = {int(s): np.flatnonzero(sizes[order] == s) for s in np.unique(sizes)}
        return flat, start[order], stop[order], members, sizes[order], order

    def _edited(self, rng) -> tuple[np.ndarray, list[np.ndarray]]:
        """Items and copies of them at the greatest allowed edits: at least ``COPIES`` of each size, one of each item."""
        pool = np.concatenate(self.words)
        owners, copies = [], []
        for s in np.unique(self.sizes):
            of = np.flatnonzero(self.sizes == s)
            for i in np.resize(of, max(COPIES, len(of))).tolist():
                w = list(self.words[i])
                for _ in range(self.allowed[i]):           # a word replaced, added or left out
                    at, kind = rng.integers(len(w)), rng.integers(3)
                    if kind == 0:
                        w[at] = pool[rng.integers(len(pool))]
                    elif kind == 1:
                        w.insert(at, pool[rng.integers(len(pool))])
                    elif len(w) > 1:
                        del w[at]
                owners.append(i)
                copies.append(np.array(w + list(pool[rng.integers(len(pool), size=16)]), np.uint64))
        return np.array(owners, np.int64), copies

    def indexed(self, recall: float = RECALL, seed: int = 3) -> "Items":
        """Add repetitions until edited copies of each size of items are found with ``recall``, or cut it in segments."""
        if not self.words:
            self.keys, self.owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return self
        of, copies = self._edited(np.random.default_rng(seed))
        own = self._windows(self.words, self.sizes)
        same = self._windows([self.words[i] for i in of], self.sizes[of])
        other = self._windows(copies, self.sizes[of])
        order = own[5]
        hit = np.zeros(len(of), bool)
        keys: dict[int, list] = {s: [] for s in own[3]}
        cut = {s for s in keys if not self.slack[s]}            # no edits: the whole item is one segment
        open_sizes = set(keys) - cut
        while open_sizes and self.repeats < MOST_REPEATS:
            walks = [walk_keys(x[0], x[1], x[2], self.repeats, {s: x[3][s] for s in open_sizes}, x[4])
                     for x in (own, same, other)]
            self.repeats += 1
            for s in sorted(open_sizes):
                keys[s].append(walks[0][s])
                idx = same[3][s]
                hit[idx] |= walks[1][s] == walks[2][s]
                if self.repeats >= 8 and hit[idx].mean() >= recall:
                    self.rounds[s] = self.repeats
                    open_sizes.discard(s)
        cut |= open_sizes
        for s in cut:
            self.rounds[s], keys[s] = 0, []
        owners = [np.tile(order[own[3][s]], len(k)) for s, k in keys.items()]
        keys, owners = np.concatenate([np.zeros(0, np.uint64), *(h for k in keys.values() for h in k)]), np.concatenate(owners)
        sort = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[sort], owners[sort]
        self.seen = np.zeros(1 << _KEY_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _KEY_BITS)] = True
        self._cut(np.flatnonzero(np.isin(self.sizes, list(cut))))
        return self

    def _cut(self, items: np.ndarray) -> None:
        """Segments of the items, one more than the edits allowed, by their length."""
        found: dict[int, list] = {}
        for i in items.tolist():
            n, parts = len(self.words[i]), int(self.allowed[i]) + 1
            ends = np.arange(parts + 1) * n // parts
            for lo, hi in zip(ends, ends[1:]):
                found.setdefault(int(hi - lo), []).append((i, lo))
        for n, places in found.items():
            h = grams(np.concatenate([self.words[i][lo:lo + n] for i, lo in places]), n)[::n]
            sort = np.argsort(h, kind="stable")
            owner, place = np.array(places, np.int64)[sort].T
            table = np.zeros(1 << _KEY_BITS, bool)
            table[h >> np.uint64(64 - _KEY_BITS)] = True
            self.segments[n] = h[sort], owner, place, table

    def _by_segments(self, words: np.ndarray, first: np.ndarray, row: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
        found = []
        for n, (hashes, owners, places, table) in self.segments.items():
            h = grams(words, n)
            near = np.flatnonzero(table[h >> np.uint64(64 - _KEY_BITS)])
            near = near[near + n <= stop[near]]
            a, b = np.searchsorted(hashes, h[near], "left"), np.searchsorted(hashes, h[near], "right")
            many = b - a
            if many.any():
                at = np.repeat(a - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                which, owner = np.repeat(near, many), owners[at]
                text = row[which]
                bucket = (which - first[text] - places[at]) // self.half[owner]
                found.append(np.unique(np.stack([owner, text, bucket], 1), axis=0))
        return found

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (item, text, bucket) candidates; a bucket is half an item of start positions."""
        if not len(words) or not self.words:
            return np.zeros((0, 3), np.int64)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        stop = first[row + 1]
        known = np.zeros(len(words) + 1, np.int64)
        np.cumsum(self.vocabulary[words >> np.uint64(64 - _VOCABULARY_BITS)], out=known[1:])
        # pairs of neighbours: a word replaced or added breaks two of the text's, one left out breaks one
        pair = np.zeros(len(words), bool)
        pair[:-1] = self.pairs[pair_hashes(words) >> np.uint64(64 - _PAIR_BITS)]
        pair[stop - 1] = False                                   # no pair across texts
        paired = np.zeros(len(words) + 1, np.int64)
        np.cumsum(pair, out=paired[1:])
        at = np.arange(len(words))
        longest = np.zeros(len(words), np.int64)
        held = {}
        for s, slack in self.slack.items():
            if not self.rounds[s]:
                continue
            end = np.minimum(at + s, stop)
            held[s] = (known[end] - known[:-1] >= s - slack) & (paired[np.maximum(end - 1, at)] - paired[:-1] >= s - 1 - 2 * slack)
            longest[held[s]] = np.maximum(longest[held[s]], s)
        live = np.flatnonzero(longest)
        live = live[np.argsort(-longest[live], kind="stable")]
        members = {s: np.flatnonzero(h[live]) for s, h in held.items()}
        members = {s: m for s, m in members.items() if len(m)}
        found = self._by_segments(words, first, row, stop)
        for rep in range(max((self.rounds[s] for s in members), default=0)):
            now = {s: m for s, m in members.items() if rep < self.rounds[s]}
            for s, h in walk_keys(words, live, stop[live], rep, now, longest[live]).items():
                near = np.flatnonzero(self.seen[h >> np.uint64(64 - _KEY_BITS)])      # few pass the bit table
                h = h[near]
                a, b = np.searchsorted(self.keys, h, "left"), np.searchsorted(self.keys, h, "right")
                many = b - a
                if many.any():
                    which = np.repeat(near, many)
                    owner = self.owners[np.repeat(a - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
                                        + np.arange(many.sum())]
                    start = live[members[s][which]]
                    text = row[start]
                    bucket = (start - first[text]) // self.half[owner]
                    found.append(np.unique(np.stack([owner, text, bucket], 1), axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def matches(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start word, words) of the best stretch of each text and item in reach."""
        found = self.candidates(words, first)
        best: dict[tuple[int, int], tuple[int, int, np.ndarray]] = {}
        for item in np.unique(found[:, 0]):
            query, most = self.words[item], int(self.allowed[item])
            rows = found[found[:, 0] == item]
            lo = rows[:, 2] * self.half[item] - most
            width = int(self.half[item]) + len(query) + 2 * most
            for part in range(0, len(rows), 4096):
                text, start = rows[part:part + 4096, 1], lo[part:part + 4096]
                at = first[text][:, None] + start[:, None] + np.arange(width)[None, :]
                inside = (at >= first[text][:, None]) & (at < first[text + 1][:, None])
                region = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
                distance, end = nearest(query, region)
                for i in np.flatnonzero(distance <= most):
                    key = (int(text[i]), int(item))
                    new = (int(distance[i]), int(start[i] + end[i]))
                    if key not in best or new < best[key]:
                        best[key] = new
        out = []
        for (text, item), (distance, end) in sorted(best.items()):
            stretch = words[max(first[text], first[text] + end - len(self.words[item]) - distance):first[text] + end]
            size = match_length(self.words[item], stretch, distance)
            out.append((text, item, distance, end - size, size))
        return out


def nearest(query: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of ``query`` to any stretch of each region row, and its first end."""
    n, width = region.shape
    step = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int64)
    for i, w in enumerate(query):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (region != w), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step          # a word more in the region
    end = row.argmin(1)
    return row[np.arange(n), end], end


def match_length(query: np.ndarray, stretch: np.ndarray, distance: int) -> int:
    """Words before the end of ``stretch`` that ``query`` matches at ``distance`` (the fewest)."""
    row = np.arange(len(stretch) + 1)
    back = stretch[::-1]
    for i, w in enumerate(query[::-1]):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (back != w), row[1:] + 1)
        row = np.minimum.accumulate(new - np.arange(len(row))) + np.arange(len(row))
    return int(np.flatnonzero(row == row.min())[0])


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", edits: float = EDITS, recall: float = RECALL,
               block: int = BLOCK_ITEMS) -> DataFrame:
    """Rows (key, item, distance, item_words, start_word, n_words): each document's best match of each item in reach."""
    from pyspark.sql.types import LongType, StructField, StructType

    ship(docs.sparkSession)
    queries = (benchmark.select(F.col(item).alias("id"), F.lower(F.col(item_text).cast("string")).alias("text"))
               .where(r"text rlike '[^\\x20\\x09-\\x0D]'"))
    queries = written(queries.withColumn("n", F.monotonically_increasing_id()), "benchmark")
    names = [key, item, "distance", "item_words", "start_word", "n_words"]
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField(item, benchmark.schema[item].dataType)]
                        + [StructField(n, LongType()) for n in names[2:]])
    spark = docs.sparkSession
    source = docs.select(F.col(key), F.lower(F.col(text).cast("string")).alias("__text"))
    out, last = None, -1
    while out is None or last is not None:
        rows = queries.where(F.col("n") > last).orderBy("n").limit(block).collect()      # at most ``block`` items
        if not rows and out is not None:
            break
        last = rows[-1]["n"] if len(rows) == block else None
        texts = pa.array([r["text"] for r in rows], pa.string())
        words = []
        for _, _, data, offsets in text_steps(texts):
            h, first = words_of(data, offsets)
            words += [h[a:b].copy() for a, b in zip(first, first[1:])]
        shared = spark.sparkContext.broadcast(Items([r["id"] for r in rows], words, edits).indexed(recall))
        found = source.mapInArrow(_search(shared, names, schema), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(shared, names, schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for lo, _, data, offsets in text_steps(batch.column(1), 4 * STEP_BYTES):
                got = items.matches(*words_of(data, offsets))
                columns = [batch.column(0).take(pa.array([lo + g[0] for g in got], pa.int64())),
                           pa.array([items.ids[g[1]] for g in got], arrow.field(1).type)]
                columns += [pa.array([f(g) for g in got], pa.int64()) for f in (
                    lambda g: g[2], lambda g: len(items.words[g[1]]), lambda g: g[3], lambda g: g[4])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def drop_leaking(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that hold a stretch within reach of a benchmark item.

    A repeated key with several texts goes only for the texts that leak.
    """
    marked = docs.select(F.struct(F.col(key).alias("k"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
                                  .alias("m")).alias("id"),
                         F.col(text).alias("text"))
    gone = find_leaks(marked, benchmark, "id", "text", **how).select("id.k", "id.m").distinct()
    rows = as_row(docs, k0=F.col(key), m0=F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return from_row(rows.join(gone, F.expr("k0 <=> k and m0 = m"), "left_anti"), docs.columns)
