"""Time-series operators that stay safe when one key is huge.

A window ``PARTITION BY coin_id ORDER BY open_time`` sends every row of a
coin to one task; if one coin holds a third of all candles, that task holds
a third of the data. ``previous_value`` splits the series into time buckets
(a UTC day by default): the lag inside a bucket is a window over
``(key, bucket)``; the value carried into the first row of each bucket is
the last value of the previous non-empty bucket, taken from a per-bucket
aggregate (map-side combined) whose size is bounded by the number of
buckets, not by the number of rows. The result equals the plain lag.
``running`` carries a running aggregate over buckets in the same way, and
``moving_frame`` cuts a series into blocks of equally many rows, each with the
few rows before it that its frames reach back to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "__bucket"


def day_bucket(ts: str) -> Column:
    return F.to_date(F.col(ts))


def previous_value(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str,
                   bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = ``lag(value) OVER (PARTITION BY keys ORDER BY order)``.

    ``order`` must be unique within ``keys`` (true for a de-duplicated
    series), which makes the result deterministic.
    """
    keys = list(keys)
    b = bucket if bucket is not None else day_bucket(order)
    base = df.withColumn(_B, b)
    w_in = Window.partitionBy(*keys, _B).orderBy(order)
    x = (base.withColumn("__prev_in", F.lag(value).over(w_in))
          .withColumn("__first", F.row_number().over(w_in) == 1))
    # last value per bucket: partial aggregation, no hot task
    last = base.groupBy(*keys, _B).agg(F.max_by(value, order).alias("__last"))
    joined = _carried(x, last, keys, lambda w: F.lag("__last").over(w))
    return (joined.withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev_in")))
                  .drop(_B, "__prev_in", "__first", "__carry"))


def _carried(rows: DataFrame, per_bucket: DataFrame, keys: list[str], carry) -> DataFrame:
    """``rows`` with ``__carry``: ``carry(window over a series' buckets)`` of
    ``per_bucket``, which has one row per (key, bucket), i.e. is bounded by
    the time span of the series, not by its volume."""
    w = Window.partitionBy(*keys).orderBy(_B) if keys else Window.orderBy(_B)
    # null-safe: rows with a NULL key are a series like any other
    names = [f"__k{i}" for i in range(len(keys) + 1)]
    carried = per_bucket.select(*keys, _B, carry(w).alias("__carry")).toDF(*names, "__carry")
    same = [rows[k].eqNullSafe(carried[n]) for n, k in zip(names, [*keys, _B])]
    return rows.join(carried, same, "left").drop(*names)


# Aggregate of a bucket, and how that of the buckets before joins in.
_RUNNING = {"max": (F.max, F.greatest), "min": (F.min, F.least),
            "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)), "count": (F.count, lambda a, b: F.coalesce(a + b, a, b))}


def running(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, how: str = "max",
            bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = ``how(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``.

    ``how``: max, min, sum or count. Two levels: the running aggregate inside
    each bucket, and that of all earlier buckets from one row a bucket.
    NULL values are passed over, as the window does. ``order`` must be unique
    within ``keys``.
    """
    keys, (aggregate, joined) = list(keys), _RUNNING[how]
    base = df.withColumn(_B, bucket if bucket is not None else day_bucket(order))
    inside = aggregate(value).over(Window.partitionBy(*keys, _B).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    per_bucket = base.groupBy(*keys, _B).agg(aggregate(value).alias("__all"))
    over = F.max if how == "max" else F.min if how == "min" else F.sum
    x = _carried(base.withColumn("__in", inside), per_bucket, keys,
                 lambda w: over("__all").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return x.withColumn(out, joined(F.col("__in"), F.col("__carry"))).drop(_B, "__in", "__carry")


# Rows of a block of ``moving_frame``.
FRAME_BLOCK = 4096


def moving_frame(df: DataFrame, keys: Sequence[str], order: str, size: int, bucket: Column | None = None,
                 block: int = FRAME_BLOCK, **aggregates: Column) -> DataFrame:
    """Add each ``name=aggregate`` over the last ``size`` rows of the series
    (``PARTITION BY keys ORDER BY order ROWS size-1 PRECEDING``).

    Rows are numbered by ``running`` counts; ``block`` rows in a row make a
    window group of their own, with a copy of the ``size - 1`` rows before
    them. Every group has at most ``block + size - 1`` rows, however long one
    series is. ``order`` must be unique within ``keys``.
    """
    keys, block, at = list(keys), max(block, size), F.col("__at")
    numbered = running(df.withColumn("__one", F.lit(1)), keys, order, "__one", "__at", "count", bucket).drop("__one")
    own = F.floor((at - 1) / block)
    # the last rows of a block stand before the next one too
    groups = F.when((at - 1) % block >= block - (size - 1), F.array(own, own + 1)).otherwise(F.array(own))
    dealt = numbered.withColumn("__own", own).withColumn("__group", F.explode(groups))
    w = Window.partitionBy(*keys, "__group").orderBy("__at").rowsBetween(1 - size, 0)
    made = dealt.select("*", *[c.over(w).alias(n) for n, c in aggregates.items()])
    return made.where("__group = __own").drop("__at", "__own", "__group")


def resample_daily(ohlc: DataFrame, key: str = "coin_id", ts: str = "open_time") -> DataFrame:
    """4-hour candles -> daily candles (first open, max high, min low, last close).

    A plain grouped aggregate: partial aggregation before the shuffle keeps
    a hot coin cheap.
    """
    return (ohlc.groupBy(key, F.to_date(ts).alias("day"))
                .agg(F.min_by("open", ts).alias("open"), F.max("high").alias("high"),
                     F.min("low").alias("low"), F.max_by("close", ts).alias("close"),
                     F.count(F.lit(1)).alias("n_candles")))
