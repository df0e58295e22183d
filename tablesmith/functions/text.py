"""Features read out of text columns. All are native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: the word between a space and a dot.
TITLE_PATTERN = r" ([A-Za-z]+)\."


def word_before_dot(text: Column, missing: str | None = None) -> Column:
    """First word that follows a space and is closed by a dot.

    Spark returns '' when nothing matches; ``missing`` replaces that (null by default,
    pass '' for the variant that keeps an empty string).
    """
    found = F.regexp_extract(text, TITLE_PATTERN, 1)
    return found if missing == "" else F.when(found != "", found).otherwise(F.lit(missing))


def between(text: Column, start: str, end: str) -> Column:
    """Second ``start``-separated field, up to the first ``end``; null if absent."""
    tail = F.split_part(text, F.lit(start), F.lit(2))
    return F.when(text.contains(start), F.split_part(tail, F.lit(end), F.lit(1)))


def first_contained(text: Column, entries: Sequence[str]) -> Column:
    """The first entry of the ordered list that occurs anywhere in the text."""
    return F.coalesce(*[F.when(text.contains(entry), F.lit(entry)) for entry in entries])


def n_chars(text: Column) -> Column:
    return F.length(text)


def initial_or(text: Column, missing: str = "M") -> Column:
    """First character, or ``missing`` for null."""
    return F.coalesce(F.substring(text, 1, 1), F.lit(missing))
