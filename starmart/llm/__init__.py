"""Operators of a training-data pipeline, one module each.

Nothing else in the package imports this subpackage. Every operator takes a DataFrame of
documents, names its columns by parameter and keeps what it was given: a result column
replaces an input column of the same name, all others pass through.
"""
