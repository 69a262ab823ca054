"""Operators for preparing language-model training data, and their queries.

Nothing outside this package imports it. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` name what ``__spark_entry__`` registers.
"""
