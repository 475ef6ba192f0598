"""Operators for large training-data pipelines, each a Spark job.

Nothing else in the library imports this subpackage; it may be deleted
together with ``tests/llm`` and ``corpus_pipeline.py``.
"""
