"""Operators of a training-data pipeline, and their registered queries (``llm.queries``).

Nothing outside this package imports it.
"""
