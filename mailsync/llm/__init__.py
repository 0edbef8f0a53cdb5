"""Operators of a large-scale training-data pipeline, on DataFrames of documents.

Nothing else in the package imports this subpackage; ``__spark_entry__.py`` adds its queries when
it is present. ``queries.py`` holds the registered queries and their SQL.
"""
