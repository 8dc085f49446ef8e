"""One row per key, lookups and run-length copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.operators.joins import Facts, Look, _names


def one_per_key(df: DataFrame, keys, order: Sequence[str], keep: str = "first") -> DataFrame:
    """The first or last row of each key in the order given.

    Ties are broken by the remaining columns, left to right, so the row is the
    same in every run; NULL sorts first; rows with a NULL key form one group.
    Each task ranks its own rows and sends on one per key (a window with a group limit), so
    a key with very many rows never meets in one place.
    """
    keys, order = _names(keys), _names(order)
    first = keep == "first"
    by = [c for c in dict.fromkeys([*order, *df.columns]) if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) if first else F.desc_nulls_last(c) for c in by or keys])
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).select(*df.columns)


_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def at_extreme(df: DataFrame, keys, column: str, keep: str = "first") -> DataFrame:
    """The rows of each key that have its first or last value of a fixed-width column (usually a business time).

    The value is found by a hash aggregation, without sorting, and the rows by a semi join, which Spark broadcasts where the keys are
    few. NULL is before all values; NULL keys form one group. Reads `df` twice, so it is for scans, not for joined frames.
    """
    keys = _names(keys)
    names = {c: f"_best_{i}" for i, c in enumerate([*keys, column])}
    if keep == "first":
        value = F.when(~F.bool_or(F.col(column).isNull()), F.min(column))
    else:
        value = F.max(column)
    best = df.groupBy(*[F.col(k).alias(names[k]) for k in keys]).agg(value.alias(names[column]))
    return df.join(best, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()], "left_semi")


def first_of_scan(df: DataFrame, keys, order: Sequence[str], keep: str = "first") -> DataFrame:
    """`one_per_key` of a scan: rows are cut to the first value of the leading column before only the ties are ranked."""
    lead = _names(order)[0]
    if lead not in _names(keys) and isinstance(df.schema[lead].dataType, _FIXED_WIDTH):
        df = at_extreme(df, keys, lead, keep)
    return one_per_key(df, keys, order, keep)


def single(other: DataFrame, key, values: Sequence[str], order: Sequence[str] = (), keep: str = "last") -> Look:
    """`values` of one row per key of a scan, to be looked up; `keep` says which row wins. The scan is cut to the asked-for keys first."""
    columns = [*dict.fromkeys([*_names(key), *order, *values])]

    def pick(rows: DataFrame) -> DataFrame:
        one = first_of_scan(rows, key, order, keep) if order else one_per_key(rows, key, order, keep)
        return one.select(*_names(key), *values)

    return Look(other.select(*columns), key, pick=pick)


def lookup(df: DataFrame, other: DataFrame, on, key, values: Sequence[str], order: Sequence[str] = (), keep: str = "last") -> DataFrame:
    """Bring `values` of one row per key into `df`."""
    return Facts(df).by(on, single(other, key, values, order, keep)).df


def copies(df: DataFrame, keys, name: str = "copies") -> DataFrame:
    """Rows per key, counted before the shuffle."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias(name))


COPIES_AT_ONCE = 10_000


def expand_copies(df: DataFrame, name: str = "copies", at_once: int = COPIES_AT_ONCE) -> DataFrame:
    """Write a run-length row out as many times as it counts.

    In two steps: a row becomes blocks of at most `at_once` copies, the blocks are dealt out, and each writes its own
    copies. So no row ever holds a long list, and the copies of one row are the work of many tasks.
    """
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(name) - 1) / at_once))
    rows = df.where(F.col(name) > 0).withColumn("_block", F.explode(blocks))
    left = F.least(F.lit(at_once).cast("bigint"), F.col(name) - F.col("_block") * at_once)
    rows = rows.withColumn("_left", left).hint("rebalance")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_left")))).drop("_block", "_left", "_copy", name)
