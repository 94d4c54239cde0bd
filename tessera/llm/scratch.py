"""Shared helpers: scratch tables in the cluster's folder, text buffers, hashes.

Scratch tables are Parquet under the folder that ``spark.checkpoint.dir``
names, so that a lost executor never loses them. Text helpers view an Arrow
string column as one byte buffer and work on it with numpy, in pieces of a
bounded number of bytes, so memory in a task follows the longest text and
not the batch.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``\\x20`` and ``\\x09-\\x0D``: the bytes between words in every contract.
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that one numpy step works on (a longer text is one step).
STEP_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application.

    Tasks import it; where the driver found it, or its working folder, says
    nothing about the executors.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _shipped or not os.path.isdir(package):       # a zip: already sent
        return
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"tessera-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder (local mode may make its own)."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    base = base or sc.getCheckpointDir()
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``written`` that is no longer read."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(column, m: int):
    """crc32 of a column as text, modulo ``m`` (null counts as empty)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(m)


# -- text buffers -----------------------------------------------------------

def text_steps(column, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) pieces of a string column.

    Nulls are empty texts. A piece has at most ``limit`` bytes unless it is
    one longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    array = column.cast(pa.large_binary()).fill_null(b"")
    if len(array) == 0:
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(array):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(array))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers (mod 2**64) of an odd number and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, STEP_BYTES + 2)
        made = []
        for p in (_P, _P_INV):
            a = np.full(n, p, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        if n > 4 * STEP_BYTES + 2:       # of a single longer text: not kept
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (spreads every input bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] the polynomial hash of bytes i..j-1, times P**i."""
    p, _ = powers(len(data) + 1)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:len(data)], out=s[1:])
    return s


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE):
    """Starts, ends and first-word index per text of the words in a piece."""
    word = ~space[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = word
    starts_at = word & ~before[:-1]
    ends_at = np.empty(len(data) + 1, bool)
    ends_at[:-1] = before[:-1] & ~word
    ends_at[-1] = before[-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[word[cut] & word[cut - 1]]           # a word never crosses texts
    starts_at[cut] = True
    ends_at[cut] = True
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    s = prefix_hashes(data)
    _, inverse = powers(len(data) + 1)
    return mixed((s[ends] - s[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """64-bit hash of each word, and the first-word index of each text."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int):
    """Hashes of the word ``n``-grams of each text, and first index per text.

    A text of 1 to n-1 words has one shingle: all its words.
    """
    counts = np.diff(first)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=at[1:])
    row = np.repeat(np.arange(len(made)), made)
    pos = np.arange(at[-1]) - at[row] + first[row]
    left = first[row + 1] - pos
    h = np.zeros(len(pos), np.uint64)
    for j in range(n):
        got = np.where(left > j, words[np.minimum(pos + j, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else h
        h = h * np.uint64(0xD6E8FEB86659FD93) + got + np.uint64(j + 1)
    return mixed(h), at


def appended(df: DataFrame, text: str, ddl: str, make, keep_text: bool = True) -> DataFrame:
    """``df`` with the columns of ``ddl`` that ``make(text array)`` returns, in order.

    A column of ``df`` with the name of a new column gives way to it, and
    the text column goes unless ``keep_text``.
    """
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    new = StructType.fromDDL(ddl)
    kept = [c for c in df.columns if c not in new.names and (keep_text or c != text)]
    out = StructType([df.schema[c] for c in kept] + new.fields)

    # A kept text travels once; columns travel by place, so that no name can clash with the text's.
    at = kept.index(text) if text in kept and df.schema[text].dataType.simpleString() == "string" else len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *make(batch.column(at))], names=out.names)
            pa.default_memory_pool().release_unused()        # a worker outlives its task

    placed = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    if at == len(kept):
        placed.append(F.col(text).cast("string").alias("t"))
    return df.select(*placed).mapInArrow(run, out)


def as_row(df: DataFrame, **work) -> DataFrame:
    """``df`` as one struct column ``row`` beside work columns, whose names then clash with none of its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in work.items()])


def from_row(df: DataFrame, columns: list[str], **changed) -> DataFrame:
    """The columns of ``row`` again, some replaced, further ones appended."""
    return df.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns],
                     *[v.alias(c) for c, v in changed.items() if c not in columns])
