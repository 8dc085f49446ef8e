"""Output contracts, ordering, sections and spacer rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contract(df: DataFrame, columns: Sequence[str | tuple[str, str | Column]]) -> DataFrame:
    """Select to an output contract: a name, or (output name, column or expression)."""
    out = []
    for item in columns:
        if isinstance(item, str):
            out.append(F.col(item))
        else:
            name, expr = item
            out.append((F.col(expr) if isinstance(expr, str) else expr).alias(name))
    return df.select(*out)


def nothing(dtype: str = "string") -> Column:
    """A constant NULL column."""
    return F.lit(None).cast(dtype)


def ordered(df: DataFrame, *keys: str, nulls: str = "last") -> DataFrame:
    """Sort by the keys and then every other column.

    The remaining columns make the order the same in each run and let a range
    partition cut through a key that most rows share. `nulls` follows the source:
    "last" for the clinical system, "first" for the scheduling system.
    """
    names = [*keys, *[c for c in df.columns if c not in keys]]
    place = F.asc_nulls_last if nulls == "last" else F.asc_nulls_first
    return df.orderBy(*[place(c) for c in names])


def sections(df: DataFrame, by: str, names: Sequence) -> dict[str, DataFrame]:
    """One filtered DataFrame per section name; the section column is dropped."""
    return {str(n): df.where(F.col(by) == n).drop(by) for n in names}


def spaced(df: DataFrame, blanks: int, line: str = "line") -> DataFrame:
    """Each row followed by `blanks` empty rows; `line` is 0 for the row itself.

    The order columns stay in `_sort` so a sink can keep the lines together.
    """
    whole = df.withColumn("_sort", F.struct(*df.columns))
    whole = whole.withColumn(line, F.explode(F.sequence(F.lit(0), F.lit(blanks))))
    return whole.select(
        *[F.when(F.col(line) == 0, F.col(c)).alias(c) for c in df.columns], line, "_sort"
    )
