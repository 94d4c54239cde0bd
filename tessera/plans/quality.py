"""Quarantine of bad documents.

Failures become values: instead of failing a view, a bad document is
reported with an ``error`` text. One narrow pass over the raw table; no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import cast_number, is_single_json_document, json_value

# Quarantine reasons.
MALFORMED = "malformed JSON document"
MISSING_ID = "missing id"
NOT_NUMERIC = "non-numeric price"


def bad_payloads(raw: DataFrame, key_path: str = "$.id", numeric_paths: tuple[str, ...] = ()) -> DataFrame:
    """Raw document rows that a strict view would fail on or mis-key.

    ``error`` is the first reason that applies: malformed text (not exactly
    one JSON document), no id (such rows would all fall into one NULL
    group, E6), or a member in ``numeric_paths`` that a strict cast
    rejects (E7).
    """
    p = F.col("payload")
    well_formed = is_single_json_document(p)
    key = json_value(p, key_path)
    reason = F.when(~well_formed, F.lit(MALFORMED)).when(key.isNull(), F.lit(MISSING_ID))
    for path in numeric_paths:
        t = json_value(p, path)
        reason = reason.when(t.isNotNull() & cast_number(t, "double").isNull(), F.lit(f"{NOT_NUMERIC} at {path}"))
    return (raw.select("ingestion_time", F.when(well_formed, key).alias("coin_id"), reason.alias("error"))
               .where(F.col("error").isNotNull()))
