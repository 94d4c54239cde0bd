"""Line dedup: a suffix array over line ids, by distributed prefix doubling.

Each text is a sequence of its lines with a word. Round 0 ranks the lines
that occur twice or more; round k ranks runs of ``2**k`` lines by the pair of
ranks of their halves, and drops positions whose run is unique. Ranks keep
order (range-partitioned sort of the distinct repeated pairs), so sorting
positions by rank is the suffix array of line sequences, cut where prefixes
become unique. Positions with the same run of L lines form an interval of
longest common prefix >= L; two overlapping power-of-two ranks name it.

A run counts as repeated from ``min_words`` words on. For every position the
shortest such run that starts there, and the shortest that ends there, are
looked up; these cover exactly the lines that any repeated run of
``min_words`` or more covers. The first copy (least key, then position)
stays, all later copies are deleted.

Everything is DataFrame functions. Rows between stages are one per line with
ids, never texts; counts are partially aggregated and rejoined, so a line
that a third of all texts share makes no large task.

Edge cases: null and empty texts have no lines and come back as they are (a
null as null); blank lines are never deleted; rows equal in key and text
count as one document and share its result; a null key sorts first; all
columns are kept, with ``n_lines`` and ``n_removed`` appended (columns so
called give way).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import as_row, from_row, written

#: A run of at least so many words that occurs twice is a copy.
MIN_WORDS = 10


def line_positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, t, pos, line, words, x, c): every line with a word; pos counts those, line counts all."""
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    marked = F.filter(F.transform(lines, lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
                      lambda r: r["s"].rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(F.col(key).alias("d"), F.xxhash64(F.col(text)).alias("t"), F.posexplode(marked).alias("pos", "r"))
    return rows.select("d", "t", "pos", F.col("r.i").alias("line"),
                       F.expr(r"regexp_count(r.s, '[^\\x20\\x09-\\x0D]+')").alias("words"),
                       F.xxhash64("r.s").alias("x"), F.crc32(F.col("r.s").cast("binary")).alias("c"))


def _ranks(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Order-keeping ranks of the values of ``by`` that occur twice or more."""
    repeated = rows.groupBy(*by).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    ordered = repeated.repartitionByRange(*by).sortWithinPartitions(*by)
    return written(ordered.withColumn(name, F.monotonically_increasing_id()), "line-ranks")


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Later copies as (d, t, pos, run): runs of ``run`` lines from ``pos`` on that occur earlier."""
    levels = max(0, int(math.log2(max(1, min_words))))          # a shortest run has at most min_words lines
    lines = written(line_positions(docs, key, text).distinct(), "lines")
    ranks = [_ranks(lines, ["x", "c"], "r0")]
    rows = lines.join(ranks[0], ["x", "c"]).select("d", "t", "pos", "words", "r0")
    seq = Window.partitionBy("d", "t").orderBy("pos")
    rows = rows.withColumn("island", F.col("pos") - F.row_number().over(seq))
    run = Window.partitionBy("d", "t", "island").orderBy("pos")
    for k in range(levels):
        half = 1 << k
        rows = rows.withColumn("__b", F.lead(f"r{k}", half).over(run))
        pairs = rows.where(f"r{k} is not null and __b is not null").select(F.col(f"r{k}").alias("__a"), "__b")
        ranks.append(_ranks(pairs, ["__a", "__b"], f"r{k + 1}"))
        rows = rows.join(ranks[-1].withColumnRenamed("__a", f"r{k}"), [f"r{k}", "__b"], "left").drop("__b")
    rows = written(rows, "line-suffixes")
    # The shortest run from each line on, and to each line, with min_words words.
    ahead = F.collect_list("words").over(run.rowsBetween(0, min_words - 1))
    behind = F.collect_list("words").over(run.rowsBetween(-(min_words - 1), 0))
    short = ("aggregate({a}, named_struct('s', 0L, 'n', 0), (z, w) -> if(z.s >= %d, z, "
             "named_struct('s', z.s + w, 'n', z.n + 1)))" % min_words)
    found = rows.withColumn("__f", ahead).withColumn("__g", F.reverse(behind))
    found = found.withColumn("__f", F.expr(short.format(a="__f"))).withColumn("__g", F.expr(short.format(a="__g")))
    names = [f"r{k}" for k in range(levels + 1)]
    spans = F.array_distinct(F.filter(F.array(
        F.when(F.col("__f.s") >= min_words, F.struct(F.col("pos").alias("p"), F.col("__f.n").alias("n"))),
        F.when(F.col("__g.s") >= min_words, F.struct((F.col("pos") - F.col("__g.n") + 1).alias("p"),
                                                     F.col("__g.n").alias("n")))), lambda s: s.isNotNull()))
    windows = found.select("d", "t", F.explode(spans).alias("s")).select("d", "t", F.col("s.p").alias("pos"),
                                                                        F.col("s.n").alias("run")).distinct()
    level = F.floor(F.log2("run")).cast("int")
    windows = windows.withColumn("k", level).withColumn("tail", F.expr("pos + run - cast(pow(2, k) as int)"))
    stacked = rows.select("d", "t", "pos", F.posexplode(F.array(*names)).alias("k", "r")).where("r is not null")
    same = ["d", "t"]
    a, b = windows.alias("w"), stacked.alias("a")
    named = a.join(b, F.expr("w.d <=> a.d and w.t <=> a.t and w.pos = a.pos and w.k = a.k")).select(
        "w.*", F.col("a.r").alias("ra"))
    named = named.alias("w").join(b, F.expr("w.d <=> a.d and w.t <=> a.t and w.tail = a.pos and w.k = a.k")).select(
        *[F.col(f"w.{c}") for c in [*same, "pos", "run", "ra"]], F.col("a.r").alias("rb"))
    named = written(named, "line-runs")
    firsts = written(named.groupBy("run", "ra", "rb").agg(
        F.min(F.struct("d", "t", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1"), "line-firsts")
    later = named.join(firsts, ["run", "ra", "rb"]).where(
        "not (d <=> first.d and t <=> first.t and pos <=> first.pos)").select("d", "t", "pos", "run")
    return written(later, "line-copies")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies cut out of ``text``, and n_lines, n_removed (lines with a word)."""
    copies = repeated_runs(docs, key, text, min_words)
    gone = (copies.select("d", "t", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("run") - 1)).alias("pos"))
            .distinct().groupBy("d", "t").agg(F.collect_list("pos").alias("gone")))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    x = as_row(docs, k=F.col(key), t0=F.col(text).cast("string"), h=F.xxhash64(F.col(text)))
    y = x.join(gone, F.expr("k <=> d and h <=> t"), "left")
    y = y.withColumn("lines", F.split("t0", "\n"))
    y = y.withColumn("full", F.expr(r"filter(sequence(0, size(lines) - 1), i -> rlike(lines[i], '[^\\x20\\x09-\\x0D]'))"))
    y = y.withColumn("kept", F.expr("array_except(sequence(0, size(lines) - 1), transform(gone, p -> full[p]))"))
    left = F.expr("array_join(transform(kept, i -> lines[i]), '\n')")
    return from_row(y, columns, **{
        text: F.when(F.col("gone").isNotNull(), left).otherwise(F.col("t0")),
        "n_lines": F.coalesce(F.when(F.col("lines").isNotNull(), F.size("full")), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long")})
