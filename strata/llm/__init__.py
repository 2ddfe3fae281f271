"""Operators of a large-scale training-data pipeline. Nothing outside this
subpackage, ``corpus_pipeline.py`` and ``tests/llm`` imports it."""
