"""Column functions (JSON, casts, time, formatting) built from Spark built-ins."""
