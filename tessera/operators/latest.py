"""Latest version per business key.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ingestion_time DESC) = 1``.
Spark plans this as a *partial* ``WindowGroupLimit`` before the shuffle and a
final one after it, so a hot key (one coin with a third of all documents)
sends at most one row per map partition through the Exchange. The window
is the only shuffle; callers should project typed, narrow columns (or keep
the raw payload and parse after the filter, which then parses only the
survivors).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _as_cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
              tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order`` (+ tie-break).

    ``order`` entries are Column expressions such as ``F.desc('ingestion_time')``.
    The tie-break makes equal timestamps (a replayed file) deterministic;
    without ties it changes nothing (E5). NULL keys form one group (E6).
    """
    w = Window.partitionBy(*keys).orderBy(*_as_cols(order), *_as_cols(tie_break))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
