"""Operators of a training-data pipeline: deduplication, filtering, extraction, tokens.

One module per operator; ``queries`` binds them to the given tables and ``sql``
holds the DuckDB statements of those that SQL can express.  Nothing outside
this folder and ``corpus_pipeline.py`` imports it.
"""
