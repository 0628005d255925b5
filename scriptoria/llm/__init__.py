"""Operators of a training-data pipeline: thirteen corpus operators, each with a thin registered query.

Nothing outside this subpackage imports it.
"""
