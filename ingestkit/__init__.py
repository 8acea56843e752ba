"""ingestkit: layered, audited ingestion on Spark DataFrames.

Every operator is a function from DataFrames (plus explicit arguments such as
``batch_id`` and ``run_ts``) to a DataFrame, so the same code serves batch and
Structured Streaming (inside ``foreachBatch``).
"""

__version__ = "0.1.0"
