"""Operators of a training-data pipeline: one module per operator.

Nothing else in the package imports this subpackage; its queries and their
SQL are in :mod:`triplex.llm.queries`.
"""
