"""Operators of a training-data pipeline: formatting, rules, packing, scoring,
deduplication, nearest neighbours and tokenisation.

Each operator has a module of its own with a general interface on DataFrames;
``queries`` applies them to the given tables.  Nothing outside this package
(and ``corpus_pipeline.py``) imports it.
"""
