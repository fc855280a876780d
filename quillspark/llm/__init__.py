"""Operators of a training-data pipeline: near and substring duplicates, toxicity,
fingerprints, packing, token files, quality rules, mixing and URL filters.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
