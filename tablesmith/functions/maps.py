"""Category look-ups given as Python dicts; each compiles to one expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def lookup(column: Column, mapping: Mapping) -> Column:
    """Mapped value, null where the key is unknown.

    A literal map is folded once per plan and the column is evaluated once per row; keys
    are compared as text so that int and long columns take the same dict.
    """
    if not mapping:
        return F.lit(None)
    entries = [x for key, value in mapping.items() for x in (F.lit(key).cast("string"), F.lit(value))]
    return F.try_element_at(F.create_map(*entries), column.cast("string"))


def replace_values(column: Column, rules: Mapping[str, Iterable[str]]) -> Column:
    """Many-to-one replacement ``{new: [old, ...]}`` in one pass; other values stay."""
    return F.coalesce(lookup(column, {old: new for new, olds in rules.items() for old in olds}), column)


def ordinal_or_null(column: Column, mapping: Mapping[str, int], default: int | None = None) -> Column:
    """Ordinal code, unknown keys become ``default`` (null unless given)."""
    code = lookup(column, mapping).cast("int")
    return code if default is None else F.coalesce(code, F.lit(default))


def ordinal_or_keep(column: Column, mapping: Mapping[str, int]) -> Column:
    """Ordinal code as text, unknown keys are kept unchanged."""
    return F.coalesce(lookup(column, mapping).cast("string"), column.cast("string"))


def ordinal_strict(column: Column, mapping: Mapping[str, int]) -> Column:
    """Ordinal code as int; the job fails on an unknown non-numeric key (null stays null)."""
    return ordinal_or_keep(column, mapping).cast("int")


def equals_flag(column: Column, value) -> Column:
    """1 where equal, 0 everywhere else including null."""
    return F.when(column == F.lit(value), 1).otherwise(0)
