"""Training-data operators: dedup, decontamination, quality, language, packing, token files.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
