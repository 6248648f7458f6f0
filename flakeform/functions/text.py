"""Short codes derived from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Any run of white space (Unicode, plus the separators U+001C to U+001F), or a whole word of
# which the first character is kept.
_SPACE = r"\s\x1c-\x1f"
_WORD_OR_SPACE = rf"(?U)[{_SPACE}]+|([^{_SPACE}])[^{_SPACE}]*"


def initials(text: Column) -> Column:
    """First character of every whitespace-separated word, upper-cased.

    ``'  Health  service manager'`` gives ``'HSM'``; null gives null.
    """
    return F.upper(F.regexp_replace(text, _WORD_OR_SPACE, "$1"))


def reduced_code(code: Column, threshold: int) -> Column:
    """A code longer than ``threshold`` shrinks to its one character at that position."""
    return F.when(F.length(code) > threshold, F.substring(code, threshold, 1)).otherwise(code)


def text_length(text: Column) -> Column:
    """Length in characters, with null counted as 0."""
    return F.coalesce(F.length(text), F.lit(0))
