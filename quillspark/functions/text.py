"""Text expressions: strip, fold case, tokenize, prefix filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the word counts.
# Kept characters of the cleaned count: ASCII letters, digits and the space.
KEEP_CLASS = "A-Za-z0-9 "
# Token separators, written out (Java \s would also take the vertical tab).
WHITESPACE = "[ \\t\\r\\n\\f]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_chars(col) -> Column:
    """Delete every character outside ASCII letters, digits and space (one line)."""
    return F.regexp_replace(_c(col), f"[^{KEEP_CLASS}]", "")


def strip_chars_keep_lines(col) -> Column:
    """Per-line strip applied to a whole text: newlines survive as line breaks.

    Splitting the result on ``[ \\n]+`` gives exactly the words of stripping each line
    and splitting it on spaces, without exploding the text into lines first.
    """
    return F.regexp_replace(_c(col), f"[^{KEEP_CLASS}\\n]", "")


def fold_case(col) -> Column:
    return F.lower(_c(col))


def split_words(col, pattern: str = WHITESPACE) -> Column:
    """Array of non-empty tokens."""
    return F.filter(F.split(_c(col), pattern, -1), lambda w: w != F.lit(""))


def starts_with(col, prefix: str) -> Column:
    return _c(col).startswith(prefix)
