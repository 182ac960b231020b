"""Training-data operators: filters, deduplication, formatting and mixing over text tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
