"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; ``registry`` lists the
queries that ``__spark_entry__`` adds when it is there.
"""
