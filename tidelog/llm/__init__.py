"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the package imports this one; ``registry`` lists its queries.
"""
