"""Null-safe access into nested records (arrays of structs, optional structs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_elem(arr) -> Column:
    """First element, NULL for a NULL or empty array (``get`` never raises)."""
    return F.get(_col(arr), 0)


def last_match(arr, field: str, value: str) -> Column:
    """Last element whose ``field`` equals ``value`` (a later duplicate wins); NULL if none."""
    return F.try_element_at(F.filter(_col(arr), lambda x: x[field] == F.lit(value)), F.lit(-1))


def strip_ref(ref, prefix: str) -> Column:
    """Reference id without its type prefix; a missing reference is '' (not NULL).

    Every occurrence of the prefix is removed, wherever it sits.
    """
    return F.replace(F.coalesce(_col(ref), F.lit("")), F.lit(prefix), F.lit(""))


def or_else(a, b) -> Column:
    """``a`` unless it is NULL or '', else ``b``."""
    return F.coalesce(F.nullif(_col(a), F.lit("")), _col(b))


def join_words(arr) -> Column:
    """Space-joined array; NULL when the array is NULL, empty or joins to ''."""
    return F.nullif(F.array_join(_col(arr), " "), F.lit(""))
