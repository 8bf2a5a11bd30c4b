"""Operators for large-scale training-data pipelines, one module each.

Nothing outside this package imports it. Every operator takes DataFrames and
returns DataFrames; ``queries.py`` holds the thin registered queries.
"""
