"""Operators of a training-data pipeline: filters, scans, deduplication, mixing.

Every operator is a function over DataFrames with its own interface; the thin
``opN_*`` queries in :mod:`ledgerline.llm.catalog` apply them to whole tables.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
