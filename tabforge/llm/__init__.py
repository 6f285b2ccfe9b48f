"""Operators of a training-data pipeline on Spark DataFrames.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
