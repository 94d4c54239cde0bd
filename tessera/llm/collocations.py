"""Phrase collocation mining with an FM-index per shard over word ids.

A shard is a run of about ``SHARD_TOKENS`` words of one language, made by one
task: its distinct words, their counts, and the text as word ids with a
separator between pieces. Words that are rare over the whole corpus cannot be
part of a phrase that is not; they become separators. Each shard is then
indexed twice, forwards and backwards, as a Burrows-Wheeler transform sorted
to the depth of the search (which is all that a depth-limited interval needs),
and a bidirectional interval search extends every word to the left, and every
pair and longer phrase to the right. A phrase's count is the size of its
interval; its right extensions are the rows it gives.

Every phrase of two to ``depth`` words is handed out with its count in the
shard, once, so that one sum across shards gives the counts of all lengths and
only frequent phrases are stored. The sum is by word ids that are unique per
language and word, so no hash stands for a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import ship, text_steps, word_spans, written

#: Words of a shard (a shard is handed on when it holds as many; the last text is never cut).
SHARD_TOKENS = 1 << 21
#: What ends a piece, and what else stands between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b"\x20\x09"

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[list(GAPS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SHARD = "shard long, lang string, n_words long, n_ids long, words array<string>, counts array<long>, ids binary"


# -- the index of one shard --------------------------------------------------

class ShardIndex:
    """Burrows-Wheeler transform of a circular symbol sequence (0 separates), sorted to ``depth`` symbols.

    Intervals of phrases of at most ``depth`` symbols, and one-symbol
    extensions within that depth, are those of the full transform.
    """

    def __init__(self, s: np.ndarray, depth: int, n_symbols: int):
        n = len(s)
        ahead = np.resize(s, n + depth).astype(np.int64)
        bits = max(int(n_symbols).bit_length(), 1)
        if bits * depth <= 63:
            key = ahead[:n].copy()
            for j in range(1, depth):
                key = (key << bits) | ahead[j:j + n]
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort([ahead[j:j + n] for j in reversed(range(depth))])
        self.n = n
        self.bwt = np.roll(s, 1)[order].astype(np.int64)                 # the symbol before each rotation
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=n_symbols))])
        rows = np.argsort(self.bwt, kind="stable")
        self._places = self.bwt[rows] * (n + 1) + rows                   # sorted: symbol, then row
        self._starts = np.concatenate([[0], np.cumsum(np.bincount(self.bwt, minlength=n_symbols))])

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each row."""
        return np.searchsorted(self._places, symbol * (self.n + 1) + row) - self._starts[symbol]


def _extended(index: ShardIndex, lo: np.ndarray, other: np.ndarray, size: np.ndarray, n_symbols: int):
    """All one-symbol extensions of intervals, on the side that ``index`` extends.

    Returns (interval, symbol, lo, other lo, size), separators included.
    """
    which = np.repeat(np.arange(len(lo)), size)
    row = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
    found, n = np.unique(which * n_symbols + index.bwt[row], return_counts=True)
    which, symbol = found // n_symbols, found % n_symbols
    before = np.cumsum(n) - n                                            # of smaller symbols in the same interval
    start = np.searchsorted(which, which)
    return which, symbol, index.first[symbol] + index.rank(symbol, lo[which]), other[which] + before - before[start], n


def phrase_rows(s: np.ndarray, depth: int, all_lengths: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(phrases as rows of ``depth`` symbols, 0 past the end; counts) of a sequence.

    Every place that begins two words or more counts for one row: its longest
    phrase of at most ``depth`` words before a separator. With ``all_lengths``
    it counts for every phrase of two words or more that begins there.
    """
    s = s if len(s) and s[0] == 0 else np.concatenate([[0], s])          # circular: one separator at least
    n_symbols = int(s.max()) + 1
    forward = ShardIndex(s, depth, n_symbols)
    words = np.arange(1, n_symbols)
    size = np.bincount(s, minlength=n_symbols)[1:]
    # single words, extended to the left: pairs
    which, symbol, lo, other, n = _extended(forward, forward.first[words], forward.first[words], size, n_symbols)
    del forward                                                          # one index at a time; single words begin alike in both
    backward = ShardIndex(s[::-1], depth, n_symbols)
    real = symbol > 0
    phrases = np.stack([symbol[real], words[which[real]]], axis=1).astype(np.int32)      # a shard's ids: below its tokens
    lo, other, n = lo[real], other[real], n[real]
    out, counts = [], []
    for length in range(2, depth):
        if all_lengths:
            out.append(phrases)
            counts.append(n)
        which, symbol, other, lo, m = _extended(backward, other, lo, n, n_symbols)    # to the right
        real = symbol > 0
        if not all_lengths:
            out.append(phrases[which[~real]])
            counts.append(m[~real])
        phrases = np.concatenate([phrases[which[real]], symbol[real, None].astype(np.int32)], axis=1)
        lo, other, n = lo[real], other[real], m[real]
    out.append(phrases)
    counts.append(n)
    return (np.concatenate([np.pad(p, ((0, 0), (0, depth - p.shape[1]))) for p in out]), np.concatenate(counts))


# -- shards of the corpus ----------------------------------------------------

def _words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words of a piece of texts, whether each begins a piece, and first word per text."""
    data = _LOWER[data]
    starts, ends, first = word_spans(data, offsets, _BETWEEN)
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_BREAK[data], out=breaks[1:])
    begins = np.ones(len(starts), bool)
    begins[1:] = breaks[starts[1:]] != breaks[ends[:-1]]
    begins[first[:-1][first[:-1] < len(starts)]] = True
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    chars = np.ascontiguousarray(data[~_BETWEEN[data]])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(chars)])
    return words, begins, first


def _shard_row(number: int, lang: str, parts: list) -> pa.RecordBatch:
    words = pa.chunked_array([w for w, _ in parts]).combine_chunks()
    begins = np.concatenate([b for _, b in parts])
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy()
    counts = np.bincount(ids, minlength=len(coded.dictionary))
    order = np.argsort(-counts, kind="stable")                           # frequent words get small ids: they compress
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    s = np.zeros(len(ids) + int(begins.sum()), "<i4")
    s[np.arange(len(ids)) + np.cumsum(begins)] = place[ids] + 1
    names = coded.dictionary.take(pa.array(order)).cast(pa.large_string()).cast(pa.string())
    ends = pa.array([0, len(order)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([lang]), pa.array([len(ids)]), pa.array([len(s)]), pa.ListArray.from_arrays(ends, names),
         pa.ListArray.from_arrays(ends, pa.array(counts[order])), pa.array([pa.compress(s.tobytes(), "zstd", asbytes=True)])],
        names=["shard", "lang", "n_words", "n_ids", "words", "counts", "ids"])


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    n_held, made, task = 0, 0, TaskContext.get().partitionId() << 32

    def flushed():
        nonlocal n_held, made
        for lang in sorted(held):
            yield _shard_row(task + made, lang, held[lang])
            made += 1
        held.clear()
        n_held = 0

    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        langs, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        for lo, hi, data, offsets in text_steps(batch.column(1)):
            words, begins, first = _words(data, offsets)
            if len(words) == 0:
                continue
            code = np.repeat(codes[lo:hi], np.diff(first))
            for c in np.unique(code):
                mine = code == c
                held.setdefault(langs[c], []).append((words.filter(pa.array(mine)), begins[mine]))
            n_held += len(words)
            if n_held >= most:
                yield from flushed()
    yield from flushed()


def _packed_columns(depth: int, bits: int) -> list[list[tuple[int, int]]]:
    """(word, shift) of the words in each long: as many ids of ``bits`` bits to a long as fit, first words highest."""
    per = max(1, 63 // bits)
    return [[(j, bits * (min(lo + per, depth) - 1 - j)) for j in range(lo, min(lo + per, depth))] for lo in range(0, depth, per)]


def _phrases(batches: Iterator[pa.RecordBatch], depth: int, columns: list) -> Iterator[pa.RecordBatch]:
    """Phrases of each shard with their counts: corpus ids, 0 past the end, packed in longs; n."""
    names = [f"k{i}" for i in range(len(columns))] + ["n"]
    for batch in batches:
        for i in range(batch.num_rows):
            at = batch.column(0).slice(i, 1).flatten().to_numpy()
            corpus_ids = batch.column(1).slice(i, 1).flatten().to_numpy()
            packed, size = batch.column(3)[i].as_py(), 4 * batch.column(2)[i].as_py()
            s = np.frombuffer(pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True), "<i4")
            local = np.zeros(int(s.max(initial=0)) + 1, np.int64)       # rare words: separators
            local[at + 1] = np.arange(1, len(at) + 1)
            rows, n = phrase_rows(local[s], depth, all_lengths=True)
            ids = np.concatenate([[0], corpus_ids])
            for lo in range(0, len(rows), 1 << 18):
                part = ids[rows[lo:lo + (1 << 18)]]
                packed = [sum(part[:, j] << shift for j, shift in words) for words in columns]
                yield pa.RecordBatch.from_arrays([pa.array(k) for k in packed] + [pa.array(n[lo:lo + (1 << 18)])], names=names)
        pa.default_memory_pool().release_unused()


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = 3, min_count: int = 10,
                  shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vocabulary, phrases, totals) of a corpus.

    vocabulary: ``id, lang, word, f`` of words with f >= ``min_count``;
    phrases: ``ids`` (1 to ``depth`` words), ``f`` with f >= ``min_count``;
    totals: ``lang, n``, all words of each language.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("t"))
    shards = written(rows.mapInArrow(lambda b: _shards(b, shard_tokens), _SHARD), "phrase-shards")
    seen = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "shard", "lang", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = seen.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    vocabulary = written(counted.withColumn("id", F.monotonically_increasing_id()), "phrase-words")
    # dense ids (place in the part, then part): small numbers shuffle as few bytes
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    parts, longest = vocabulary.select(F.coalesce(F.max(part), F.lit(0)) + 1, F.coalesce(F.max(place), F.lit(0)) + 1).first()
    vocabulary = vocabulary.withColumn("id", place * parts + part + 1)
    bits = int(parts * longest).bit_length()
    # a shard's frequent words: fewer than its tokens
    kept = (seen.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
                .groupBy("shard").agg(F.collect_list(F.struct("at", "id")).alias("m")))
    indexed = kept.join(shards.select("shard", "n_ids", "ids"), "shard").select("m.at", "m.id", "n_ids", "ids")
    packed = _packed_columns(depth, bits)
    columns = [f"k{i}" for i in range(len(packed))]
    grams = indexed.mapInArrow(lambda b: _phrases(b, depth, packed), ", ".join(f"{c} long" for c in [*columns, "n"]))
    # every phrase has its own rows in a shard, so one sum gives all counts and rare phrases are never stored
    grams = grams.groupBy(*columns).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    ids = [F.shiftright(c, shift).bitwiseAND((1 << bits) - 1) for c, words in zip(columns, packed) for _, shift in words]
    grams = grams.select(F.filter(F.array(*ids), lambda i: i != 0).alias("ids"), F.col("n").alias("f"))
    phrases = vocabulary.select(F.array("id").alias("ids"), "f").unionByName(grams)
    return vocabulary, written(phrases, "phrase-counts"), shards.groupBy("lang").agg(F.sum("n_words").alias("n"))


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = 3, min_count: int = 10,
                 contained_percent: int = 50, top: int = 2000, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score, words, k.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces
    and those at blanks and tabs into words. A phrase of 2 to ``depth`` words
    with a >= ``min_count`` occurrences is scored by its weakest cut:
    floor(1000000 a a / (l r)) over the cuts into l = f(first k words) and r =
    f(rest), the smallest k of equal scores. Phrases that occur inside a longer
    candidate with at least ``contained_percent`` of their count go. Order:
    score and a descending, phrase ascending (UTF-8 bytes), all exact.

    Null texts are empty, a null language is ``und``; repeated rows count again;
    an empty table gives no rows; other columns are not read.
    """
    vocabulary, phrases, totals = phrase_counts(docs, text, lang, depth, min_count, shard_tokens)
    counts = phrases.select(F.col("ids").alias("part"), F.col("f").alias("pf"))
    cuts = (phrases.where(F.size("ids") > 1).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
                   .withColumn("left", F.slice("ids", F.lit(1), F.col("k")))
                   .withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))))
    cuts = (cuts.join(counts.withColumnRenamed("part", "left").withColumnRenamed("pf", "l"), "left")
                .join(counts.withColumnRenamed("part", "right").withColumnRenamed("pf", "r"), "right"))
    wide = {c: f"cast({c} as decimal(16,0))" for c in "flr"}             # counts below 10**16: 38 digits hold the products
    score = F.expr("({f} * {f} * 1000000) div ({l} * {r})".format(**wide))
    scored = (cuts.withColumn("score", score).groupBy("ids", "f")
                  .agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    # what longer candidates hold of shorter ones
    inner = phrases.where(F.size("ids") > 2).select("f", "ids", F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("m"))
    inner = inner.select("f", "m", "ids", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("m") + 1)).alias("p"))
    longer = (inner.groupBy(F.slice("ids", F.col("p"), F.col("m")).alias("ids")).agg(F.max("f").alias("longer")))
    left = (scored.join(longer, "ids", "left")
                  .where(F.coalesce(F.col("longer") * 100 < F.col("f") * contained_percent, F.lit(True))))
    left = (left.select("ids", F.col("f").alias("a"), "best.*").join(vocabulary.select(F.col("id").alias("head"), "lang"),
                                                                     F.col("ids")[0] == F.col("head")).drop("head"))
    order = [F.desc("score"), F.desc("a")]
    w = Window.partitionBy("lang").orderBy(*order)
    first = left.withColumn("near", F.rank().over(w)).where(F.col("near") <= top).drop("near")    # ties at the end stay
    texts = (first.select("ids", F.posexplode("ids").alias("p", "id")).join(vocabulary.select("id", "word"), "id")
                  .groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("p", "word"))).alias("words"))   # depth words
                  .select("ids", F.col("words.word").alias("words")))
    named = first.join(texts, "ids").withColumn("phrase", F.concat_ws(" ", "words"))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")))
    return (ranked.where(F.col("rank") <= top).join(totals, "lang")
                  .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                          F.col("score").cast("long").alias("score"), "words", "k"))
