"""Operators of a training-data pipeline: scoring, de-duplication, scanning,
sanitising, tokenising and sharding of document tables.

Every operator takes DataFrames and returns DataFrames; nothing else in the
library imports this package.  ``queries`` registers one ``opN_`` query per
operator, ``corpus_pipeline.py`` at the repository top chains five of them.
"""
