"""Operators for training corpora: cleaning, deduplication, scoring, formatting, tokenizing and packing.

One operator per module. Every operator takes and returns DataFrames; the queries that apply them to the
given tables are in ``registry``.
"""
