"""Packing: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenised, closed by an end id and cut into pieces of at most
one sequence. Full pieces are sequences of their own; the rest (shorter than
a sequence) is dealt into randomised groups of documents, and each group is
packed on its own by first-fit decreasing: pieces by falling length, each
into the first bin with room, which a tournament tree over the bins' free
room finds in O(log bins).

Groups are dealt by a hash of the piece's row position as written, so
neither repeated ids nor repeated texts make a large group; their number
grows with the pieces (``group_size`` pieces each on average), so memory in a
task stays the same at any size. Padding is what the last bins of each group
leave free: a part of about 1/``group_size`` of the bins.

Edge cases: a null or empty text is one piece with the end id alone; a very
long text is cut as often as needed; repeated rows are packed as rows of
their own (same key, other places); an empty table gives an empty result;
only key and text are read, so other columns never clash.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import ship, text_steps, written

CAPACITY = 2048
END_ID = 1
#: Pieces in a group on average.
GROUP_PIECES = 8192
#: Fixed value: how the byte-level vocabulary splits text before merging.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, ..."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids of a byte-level vocabulary file, by the faster of two libraries.

    ``tiktoken`` merges by rank and gives the ids of the same vocabulary; a
    text that holds the string of a special token goes to ``tokenizers``,
    which gives that token's id. A file of another kind goes to
    ``tokenizers`` altogether.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.fast = None
        if (spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                and spec.get("normalizer") is None):
            import tiktoken

            chars = byte_of_char()
            ranks = {bytes(chars[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One tokenizer per worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def tokenized_pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: key, start, length, ids_crc32, doc_tokens (and ids)."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            for lo, hi, _, _ in text_steps(batch.column(1)):
                rows, starts, lengths, crcs, totals, pieces = [], [], [], [], [], []
                for i in range(lo, hi):
                    ids = np.array(bpe.ids(batch.column(1)[i].as_py() or "") + [end_id], "<u4")
                    for at in range(0, len(ids), capacity):
                        piece = ids[at:at + capacity]
                        rows.append(i)
                        starts.append(at)
                        lengths.append(len(piece))
                        crcs.append(zlib.crc32(piece.tobytes()))
                        totals.append(len(ids))
                        if with_ids:
                            pieces.append(piece.astype(np.int64))
                columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals)]
                if with_ids:
                    columns.append(pa.array(pieces, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return docs.select(F.col(key), F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; the tournament tree keeps each subtree's most free room."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, at = int(lengths[i]), 1
        while at < leaves:                       # the first bin with room lies left whenever that side has it
            at *= 2
            if room[at] < size:
                at += 1
        bins[i], offsets[i] = at - leaves, capacity - room[at]
        room[at] -= size
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
    return bins, offsets


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, group_size: int = GROUP_PIECES,
         seed: int = 17) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns with ``length`` up to ``capacity``).

    The pieces are written once, so that a lost executor cannot deal them
    anew; a full piece is a sequence of its own.
    """
    ship(pieces.sparkSession)
    kept = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.where(F.col("length") < capacity).count() // group_size))
    part = kept.withColumn("__group", F.pmod(F.xxhash64(F.lit(seed), "__row"), F.lit(groups)))
    small = part.where(F.col("length") < capacity)
    full = part.where(F.col("length") >= capacity)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__row", ignore_index=True)     # ties in length: in the order of the rows
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"__row": frame["__row"], "sequence_id": frame["__group"] * (1 << 32) + 2 * bins,
                             "offset": offsets})

    placed = small.select("__row", "__group", "length").groupBy("__group").applyInPandas(
        run, "__row long, sequence_id long, offset long")
    carried = [F.col(c) for c in pieces.columns]
    joined = small.join(placed, "__row").select(*carried, "sequence_id", "offset")
    alone = full.select(*carried, (2 * F.col("__row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return joined.unionByName(alone)


def sequences(packed: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Padded sequences (sequence_id, ids, n_tokens) from packed pieces that carry ``ids``.

    Padded with ``end_id`` to ``capacity``, except where the content already
    ends at a power of two.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    made = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    pad = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - n)
    return made.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(end_id).cast("long"), pad)).alias("ids"),
                       n.cast("long").alias("n_tokens"))
