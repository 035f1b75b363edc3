"""Operators for preparing training data: dedup, tokens, packing, extraction, quality.

Nothing outside this folder imports it. Every operator takes and returns DataFrames.
"""
