"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardbook.functions.clock import _col


def dash(a: Column | str, b: Column | str) -> Column:
    """'a-b'; NULL when either part is NULL."""
    return F.concat(_col(a), F.lit("-"), _col(b))


def nth_part(col: Column | str, sep: str, n: int) -> Column:
    """The n-th part, counted from 1; '' beyond the last."""
    return F.split_part(_col(col), F.lit(sep), F.lit(n))


def zero_to_null(col: Column | str) -> Column:
    return F.nullif(_col(col), F.lit(0))


def top_code(col: Column | str, limit: int) -> Column:
    """Ages above the limit as 'limit+', compared as numbers (so 100 is above 90)."""
    c = _col(col)
    return F.when(c > limit, F.lit(f"{limit}+")).otherwise(c.cast("string"))


def whole_number_text(col: Column | str) -> Column:
    """A float as text without decimals; halves go to the even number."""
    return F.bround(_col(col), 0).cast("decimal(38,0)").cast("string")


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(F.trim(_col(col)), F.lit(""))


def to_long(col: Column | str) -> Column:
    """An id held as text; NULL when it is not a number."""
    return _col(col).try_cast("bigint")
