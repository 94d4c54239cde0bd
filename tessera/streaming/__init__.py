"""Incremental (Structured Streaming) loads and materialised latest views."""
