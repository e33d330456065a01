"""Training-data operators: line and document de-duplication, language ID, tokenization, extraction, scans.

Nothing outside this package (and ``corpus_pipeline.py``) imports it, so it can be removed as a unit.
"""
