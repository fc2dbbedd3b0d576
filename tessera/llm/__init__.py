"""Operators for preparing large-scale training data.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold the registered queries.
"""
