"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` registers them over the given tables.
Nothing outside this package imports it except the driver's entry file.
"""
