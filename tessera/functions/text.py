"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token delimiters are exactly space, tab, line feed,
# carriage return and form feed. Vertical tab is NOT a delimiter. The pattern
# is handed to the JVM regex engine as a Python string (never through a SQL
# literal, where '\f' would become the letter f).
TOKEN_DELIMITERS = " \t\n\r\f"
TOKEN_PATTERN = "[ \t\n\r\f]+"

# Whitespace splitting used for route-query lines (any run of \s).
WHITESPACE_PATTERN = r"\s+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """``array<string>`` of the non-empty tokens of ``text``.

    Case and punctuation are kept (``It`` and ``it.`` are distinct tokens).
    """
    return F.array_remove(F.split(_col(text), TOKEN_PATTERN), "")


def whitespace_fields(text) -> Column:
    """``array<string>`` of the non-empty ``\\s+``-separated fields."""
    return F.array_remove(F.split(F.trim(_col(text)), WHITESPACE_PATTERN), "")
