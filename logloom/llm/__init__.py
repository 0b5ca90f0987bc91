"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Every operator takes DataFrames, names its columns by parameters,
and ignores columns it is not told about, so extra columns with clashing names do no harm.
"""
