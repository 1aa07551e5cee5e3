"""Operators of a training-data pipeline: each takes documents and returns DataFrames.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
