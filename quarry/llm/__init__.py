"""Operators for preparing language-model training data.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Words are,
throughout, maximal runs of characters other than space and U+0009 to U+000D.
"""
