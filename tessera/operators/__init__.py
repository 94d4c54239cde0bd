"""Relational building blocks: latest-per-key and series operators."""
