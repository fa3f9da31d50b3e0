"""Operators for large training-data pipelines (language ID, dedup, LM scoring, ...).

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
