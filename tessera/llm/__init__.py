"""Operators of a large-scale training-data pipeline.

Nothing outside this package imports it.  Every operator takes DataFrames and
column names and returns a DataFrame; the module :mod:`tessera.llm.queries`
registers one query per operator.
"""
