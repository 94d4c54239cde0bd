"""Suffix-array dedup of byte strings: repeated stretches of ``length`` bytes.

A text's stretches (all its substrings of ``length`` bytes) are bucketed by
content: the least hashed gram of ``gram`` bytes inside a stretch, leftmost of
ties, is the same wherever the stretch occurs, so equal stretches meet in one
bucket, whatever text they come from. Neighbouring stretches with the same
least gram travel as one segment. Only buckets that two texts share, or one
text meets twice, are looked at again: their segments are cut from the texts,
and each task builds the suffix order of its segments by prefix doubling (8,
16, ... bytes, then ``length``), in which equal stretches are neighbours. The
previous smaller position in suffix order is a stretch's earlier match, the
next one its later match (longest-previous-factor arrays, cut at
``length``); ``keep="first"`` removes stretches with an earlier match,
``keep="none"`` those with any other.

Equal texts are one text with a count. A bucket of more than ``hot_bytes``
is not brought to one task: its stretches are counted by their digest with a
partial aggregation, which is exact too.

Edge cases: null texts count as empty; texts shorter than ``length`` lose
nothing; very long texts are many segments; rows
equal in key and text are copies of each other (``keep="first"`` keeps them
alike); the first copy is the one with the least key (nulls first), then text
hash; only key and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import appended, mixed, powers, prefix_hashes, ship, text_steps, written

LENGTH = 200
GRAM = 80
#: Bytes of a bucket's segments that one task may hold.
HOT_BYTES = 32 << 20
#: Bytes that one suffix order is built over.
ORDER_BYTES = 1 << 21
_STEP = 1 << 19


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones (block prefix and suffix minima)."""
    n = len(values) - width + 1
    pad = -len(values) % width
    full = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(counts per text, hashes, first starts, last starts, repeated here) of a piece of text.

    Start positions are bytes from the text's begin; a segment holds all
    stretches that start from its first to its last start.
    """
    counts = np.zeros(len(offsets) - 1, np.int64)
    parts: list[tuple] = []
    if len(data) >= length:
        s = prefix_hashes(data)
        _, inverse = powers(len(data) + 1)
        n = len(data) - gram + 1
        h = mixed((s[gram:] - s[:-gram]) * inverse[:n])
        low = np.uint64(0xFFFFFFFF)
        least = sliding_min((h & ~low) | np.arange(n, dtype=np.uint64), length - gram + 1) & low
        for t in np.flatnonzero(np.diff(offsets) >= length):
            lo, hi = offsets[t], offsets[t + 1] - length + 1
            hashes = h[least[lo:hi].astype(np.int64)]
            move = np.flatnonzero(hashes[1:] != hashes[:-1]) + 1
            anchors = np.concatenate([[True], least[lo + 1:hi] != least[lo:hi - 1]])
            first = np.concatenate([[0], move])
            last = np.concatenate([move, [hi - lo]]) - 1
            own = hashes[first]
            many = np.add.reduceat(anchors, first, dtype=np.int64) > 1
            _, back, seen = np.unique(own, return_inverse=True, return_counts=True)
            counts[t] = len(first)
            parts.append((own.view(np.int64), first, last, many | (seen[back] > 1)))
    if not parts:
        return counts, *(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, bool))
    return counts, *(np.concatenate(x) for x in zip(*parts))


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts in suffix order cut at ``length`` bytes (ties by position), and their rank.

    Prefix doubling: ranks of 8-byte prefixes, then of twice as many, the
    last two overlapping so that they end at ``length``. Every start must
    have ``length`` bytes after it.
    """
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    size = 1
    key = wide[:n]
    while size < 8 and size * 2 <= length:             # exact big-endian numbers of 2, 4, 8 bytes
        moved = np.concatenate([key[size:], np.zeros(size, np.uint64)])
        key = (key << np.uint64(8 * size)) | moved
        size *= 2
    rank = np.unique(key, return_inverse=True)[1].astype(np.uint64)
    rank_at = None
    while size < length:
        step = min(size, length - size)
        where = starts if size + step == length else np.arange(n - step)
        pair = rank[where] * np.uint64(n + 1) + rank[where + step]
        got = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        size += step
        if where is starts:
            rank_at = got
        else:
            rank = np.concatenate([got, np.zeros(step, np.uint64)])
    if rank_at is None:                                 # the numbers above were long enough
        rank_at = rank[starts]
    order = np.argsort(rank_at, kind="stable")
    return order, rank_at


def removable(data: np.ndarray, starts: np.ndarray, length: int, keep: str) -> np.ndarray:
    """Which starts have an earlier (``first``) or any other (``none``) match of ``length`` bytes.

    ``starts`` rise with the position in the order of documents.
    """
    order, rank = suffix_order(data, starts, length)
    same = np.zeros(len(order) + 1, bool)               # same[i]: i and i-1 share length bytes, in suffix order
    same[1:-1] = rank[order[1:]] == rank[order[:-1]]
    out = np.zeros(len(order), bool)
    # Positions rise among equal prefixes: the neighbour before is the previous smaller position.
    out[order] = same[:-1] if keep == "first" else same[:-1] | same[1:]
    return out


def _runs(flags: np.ndarray) -> np.ndarray:
    """(first, last) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return np.stack([edge[::2], edge[1::2] - 1], 1)


def _bucket_spans(frame: pd.DataFrame, length: int, keep: str) -> pd.DataFrame:
    """(rid, a, b): runs of removable starts in the buckets of a frame sorted by bucket, key and start.

    Equal segments of a bucket are one segment with a count.
    """
    keys = list(zip(frame["hash"], frame["held"]))
    first_of: dict = {}
    which = np.array([first_of.setdefault(k, len(first_of)) for k in keys], np.int64)
    pick = np.unique(which, return_index=True)[1]
    many = np.bincount(which)
    held = frame["held"].to_numpy()[pick]
    data = np.frombuffer(b"".join(held), np.uint8)
    sizes = np.array([len(x) for x in held], np.int64)
    offset = np.concatenate([[0], np.cumsum(sizes)])
    counts = sizes - length + 1
    at = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(at[-1]) - np.repeat(at[:-1] - offset[:-1], counts)
    gone = removable(data, starts, length, keep)
    rid, s = frame["rid"].to_numpy(), frame["s"].to_numpy()
    seen = np.zeros(len(pick), bool)
    out = []
    for i, w in enumerate(which):
        flags = gone[at[w]:at[w + 1]]
        if many[w] > 1 and (keep == "none" or seen[w]):
            flags = np.ones_like(flags)
        seen[w] = True
        for a, b in _runs(flags):
            out.append((rid[i], s[i] + a, s[i] + b))
    return pd.DataFrame(out, columns=["rid", "a", "b"]).astype("int64")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, keep: str = "none", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, text_md5, n_bytes, text_sha256, spans, kept.

    ``spans`` are the removed byte ranges (start, end; maximal, rising);
    ``kept`` holds the remaining bytes where a part was removed, else null
    (nothing or everything removed).
    """
    if keep not in ("first", "none") or not 0 < gram <= length:
        raise ValueError("keep is 'first' or 'none', and gram from 1 to length")
    ship(docs.sparkSession)
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(key).alias("k"), F.md5(plain).alias("node"), plain.alias("__x"))

    def find(column):
        counts, parts = [], []
        for _, _, data, offsets in text_steps(column, _STEP):
            c, *rest = segments(data, offsets, length, gram)
            counts.append(c)
            parts.append(rest)
        at = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32) if counts else np.zeros(1, np.int32)
        cols = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        return [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(k.to_pandas_dtype()), k)) for x, k in zip(cols, kinds)]

    found = appended(base.withColumns({"n_bytes": F.octet_length("__x").cast("long"), "sha": F.sha2("__x", 256)}),
                     "__x", "h array<long>, s array<int>, e array<int>, twice array<boolean>", find, keep_text=False)
    rows = written(found.withColumn("rid", F.monotonically_increasing_id()), "segments")
    nodes = rows.groupBy("node").agg(F.min(F.struct("k", "rid")).alias("first"), F.count("*").alias("copies"))
    reps = written(nodes.select("node", F.col("first.k").alias("k"), F.col("first.rid").alias("rid"), "copies"), "texts")

    flat = rows.select("rid", F.xxhash64("node").alias("n"), F.explode(F.arrays_zip("h", "s", "e", "twice")).alias("x"))
    flat = flat.select("rid", "n", "x.*")
    shared = (flat.groupBy("h").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("twice").alias("twice"))
              .where("n0 <> n1 or twice").select("h"))
    near = flat.select("rid", "h", "s", "e").join(shared, "h").join(reps.select("rid"), "rid", "left_semi")
    near = written(near, "shared-segments")
    hot = near.groupBy("h").agg(F.sum(F.col("e") - F.col("s") + length).alias("n")).where(F.col("n") > hot_bytes).select("h")
    hot = written(hot.withColumn("hot", F.lit(True)), "hot-buckets")        # few by their size
    lists = (near.join(hot, "h", "left").groupBy("rid")
             .agg(F.collect_list(F.struct("h", "s", "e", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("list")))
    wanted = lists.join(reps, "rid")
    cand = base.join(wanted, (base.node == wanted.node) & base.k.eqNullSafe(wanted.k)).select(
        wanted.rid, wanted.k, wanted.node, "list", F.col("__x").alias("x"))
    if rows.groupBy("k", "node").agg(F.count("*").alias("c")).where("c > 1").limit(1).count():
        cand = cand.dropDuplicates(["rid"])
    cand = written(cand, "shared-texts")

    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.large_binary())
            flats = batch.column(2).flatten()
            at = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            h, s, e, is_hot = (flats.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            row, hold, n = [], [], 0

            def made(lo, hi):
                take = pa.array(row, pa.int64())
                return pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(h[lo:hi]), pa.array(s[lo:hi]),
                    pa.array(is_hot[lo:hi]), pa.array(hold, pa.binary())], names=["rid", "k", "hash", "s", "hot", "held"])

            begin = 0
            for i in range(batch.num_rows):
                x = texts[i].as_py()
                for j in range(at[i], at[i + 1]):
                    hold.append(x[s[j]:e[j] + length])
                    row.append(i)
                    n += len(hold[-1])
                    if n > 4 << 20:
                        yield made(begin, j + 1)
                        begin, row, hold, n = j + 1, [], [], 0
            if row:
                yield made(begin, begin + len(row))

    schema = f"rid long, k {kind}, hash long, s int, hot boolean, held binary"
    pieces = cand.select("rid", "k", "list", "x").mapInArrow(cut, schema)

    def order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            new = np.flatnonzero(frame["hash"].to_numpy()[1:] != frame["hash"].to_numpy()[:-1]) + 1
            sizes = np.cumsum(frame["held"].str.len().to_numpy())
            lo = 0
            for i, cutoff in enumerate(new):            # whole buckets, about ORDER_BYTES at a time
                nxt = new[i + 1] if i + 1 < len(new) else None
                if nxt is None or sizes[nxt - 1] - (sizes[lo - 1] if lo else 0) > ORDER_BYTES:
                    yield _bucket_spans(frame.iloc[lo:cutoff].reset_index(drop=True), length, keep)
                    lo = cutoff
            rest = frame.iloc[lo:]
        if rest is not None and len(rest):
            yield _bucket_spans(rest.reset_index(drop=True), length, keep)

    normal = (pieces.where("not hot").drop("hot").repartition("hash").sortWithinPartitions("hash", "k", "rid", "s")
              .mapInPandas(order, "rid long, a long, b long"))
    spans = normal
    if hot.limit(1).count():
        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    rid, k, s, x = (batch.column(c)[i].as_py() for c in range(4))
                    view = memoryview(x)
                    names = [hashlib.blake2b(view[j:j + length], digest_size=16).digest() for j in range(len(x) - length + 1)]
                    m = len(names)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([rid] * m, pa.int64()), batch.column(1).take(pa.array([i] * m, pa.int64())),
                        pa.array(range(s, s + m), pa.int64()), pa.array(names, pa.binary())], names=["rid", "k", "a", "name"])

        each = written(pieces.where("hot").select("rid", "k", "s", "held").mapInArrow(
            digests, f"rid long, k {kind}, a long, name binary"), "hot-stretches")
        least = each.groupBy("name").agg(F.min(F.struct("k", "rid", "a")).alias("first"), F.count("*").alias("n")).where("n > 1")
        later = each.join(least, "name")
        if keep == "first":
            later = later.where("not (rid = first.rid and a = first.a)")
        spans = spans.unionByName(later.select("rid", "a", F.col("a").alias("b")))

    by_text = spans.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    partial = cand.select("rid", "node", "x").join(by_text, "rid")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            lists, keeps = [], []
            for i in range(batch.num_rows):
                x = texts[i].as_py()
                runs = sorted((r["a"], r["b"] + length) for r in batch.column(2)[i].as_py())
                merged: list[list[int]] = []
                for a, b in runs:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                left, at = [], 0
                for a, b in merged:
                    left.append(x[at:a])
                    at = b
                lists.append([{"start": a, "end": b} for a, b in merged])
                keeps.append(b"".join([*left, x[at:]]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(keeps, pa.binary())], names=["node", "spans", "kept"])

    done = written(partial.select("node", "x", "runs").mapInArrow(
        finish, "node string, spans array<struct<start:long,end:long>>, kept binary"), "cut-texts")
    facts = reps.join(done, "node", "left").select("node", F.col("k").alias("first"), "copies", "spans", "kept")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    if keep == "first":
        whole = whole & ~F.col("k").eqNullSafe(F.col("first"))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    out = rows.select("k", "node", "n_bytes", "sha").join(facts, "node")
    return out.select(F.col("k").alias(key), F.col("node").alias("text_md5"), "n_bytes", F.col("sha").alias("text_sha256"),
                      F.when(whole, every).otherwise(F.coalesce("spans", empty)).alias("spans"),
                      F.when(~whole, F.col("kept")).alias("kept"))
