"""Operators for building language-model training data.

Nothing outside this subpackage imports it. ``catalog`` registers one query for
each operator, and the pipeline over them.
"""
