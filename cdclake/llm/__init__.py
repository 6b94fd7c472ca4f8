"""Training-data operators: search, filters, near-duplicate joins, tokenisation and mixing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
