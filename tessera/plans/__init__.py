"""Curated views, the question catalogue and read-only ad hoc SQL."""
