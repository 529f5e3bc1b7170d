"""Operators for preparing language-model training data: deduplication, filters, packing, token files.

Nothing else in the library imports this folder. ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the top of the repository chains five of them.
"""
