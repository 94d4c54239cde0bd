"""tessera — a Spark-native market-snapshot lakehouse library.

Landed JSON API responses are shaped into strict, day-partitioned raw
tables; typed "latest version" views are derived from them; a catalogue
of analytic questions and a read-only ad hoc SQL surface run on top.
Everything is DataFrame / Spark SQL; no per-row Python on any data path.

Modules: ``functions.json`` (JSON/cast/time columns), ``sources`` (shape,
landing, load, ingest), ``operators`` (latest per key, series),
``plans`` (curated views, questions, quality, ad hoc SQL), ``streaming``
(incremental loads and snapshots), ``session`` (UTC, scratch, scale).
"""

__version__ = "0.1.0"
__all__ = ["functions", "operators", "plans", "session", "sources", "streaming"]
