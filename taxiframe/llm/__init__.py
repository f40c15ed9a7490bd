"""Operators of a training-data pipeline over document tables.

Nothing else in the package imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` applies them to the ``documents`` table.
"""
