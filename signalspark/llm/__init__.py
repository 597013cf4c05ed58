"""Operators of a training-data pipeline: one module for each, its registered query at the end of the module.

Nothing outside this package imports it; ``__spark_entry__`` registers ``queries.QUERIES`` when it can be imported.
"""
