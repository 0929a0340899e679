"""Training-data operators: scoring, de-duplication, extraction and encoding of text.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
