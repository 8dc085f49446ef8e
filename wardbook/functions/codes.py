"""Code to label maps and bucket rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardbook.functions.clock import _col


def map_codes(col: Column | str, labels: Mapping, default: object = None) -> Column:
    """A short fixed map as one CASE; codes outside it give the default."""
    c = _col(col)
    result = None
    for code, label in labels.items():
        result = F.when(c == code, label) if result is None else result.when(c == code, label)
    return result.otherwise(F.lit(default))


def bucket(col: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule (text contained, bucket name) that holds, else the default."""
    c = _col(col)
    result = None
    for text, name in rules:
        hit = c.contains(text)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return F.lit(default) if result is None else result.otherwise(default)


def normalise(col: Column | str, replacements: Mapping[str, str]) -> Column:
    """Replace whole values, compared without the padding; others stay as they are."""
    c = _col(col)
    result = c
    for old, new in replacements.items():
        result = F.when(F.trim(c) == old, F.lit(new)).otherwise(result)
    return result
