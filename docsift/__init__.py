"""docsift: document retrieval analytics as lazy Spark DataFrame plans.

Subpackages
-----------
sources    scans of landed pages, document bytes, whole texts, CSV, Parquet
functions  column expressions (whitespace rules, keys, hashing, vector text)
operators  listing extraction, chunking, embedding, keyed store, retrieval,
           answering
plans      query catalogue (Spark plans + DuckDB oracle SQL) and batch jobs
streaming  incremental, key-based re-load with Structured Streaming
"""

__all__ = ["session"]
