"""Operators for large training-data pipelines: deduplication, quality, toxicity, tokenising, search, mixing.

Nothing outside this subpackage imports it; its queries are in ``queries``.
"""
