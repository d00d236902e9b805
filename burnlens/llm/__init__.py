"""Operators for large-scale training-data preparation (documents, pages).

Ten operators and their thin ``opN_<name>`` queries; see ``queries.py``.
Nothing outside this folder, tests/llm and corpus_pipeline.py imports it.
"""
