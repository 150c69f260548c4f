"""Operators of a training-data pipeline over text documents, pages and vectors.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries.  Every operator takes and returns DataFrames and leaves
partitioning, shuffles and retries to Spark; where it works in Python, it does
so inside Arrow-batched tasks whose memory is bounded by the batch.
"""
