"""tidemark: event-stream behaviour analytics on Spark SQL and Structured Streaming.

Every operator is a function from DataFrame to DataFrame. Batch forms use joins, aggregations and
window functions; streaming forms live in :mod:`tidemark.streaming`.
"""

__version__ = "0.1.0"
