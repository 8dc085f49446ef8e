"""Conditions the reports share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardbook.functions.clock import _col, no_date


def present(col: Column | str) -> Column:
    """Neither NULL nor blank."""
    return _col(col).isNotNull() & (F.trim(_col(col)) != "")


def occupied(col: Column | str) -> Column:
    """An empty bed holds patient number 0."""
    return _col(col) > 0


def not_discharged(col: Column | str) -> Column:
    return _col(col) == no_date()


def dated(col: Column | str) -> Column:
    return _col(col) != no_date()


def starts_with_any(col: Column | str, prefixes: Iterable[str]) -> Column:
    """OR of prefix tests over a short fixed list (each one reaches the scan)."""
    return _any(_col(col).startswith(p) for p in prefixes)


def contains_any(col: Column | str, keywords: Iterable[str]) -> Column:
    return _any(_col(col).contains(k) for k in keywords)


def any_of(*conditions: Column) -> Column:
    """Branches joined by OR; each is a whole condition, so AND binds inside it."""
    return _any(conditions)


def _any(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return F.lit(False) if result is None else result
