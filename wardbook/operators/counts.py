"""Counts. Groups are pre-aggregated by Spark before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.operators.joins import _names


def value_counts(df: DataFrame, col: str, weight: str | None = None, order: bool = True) -> DataFrame:
    """Rows per value, most frequent first. NULL is not counted.

    `weight` names a column that says how many rows each row stands for.
    """
    total = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(total.cast("bigint").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(col)) if order else counted


def group_size(df: DataFrame, keys) -> DataFrame:
    """Rows per key combination; rows with a NULL in any key are left out."""
    keys = _names(keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def non_null_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: the non-NULL values of each column, each row counted `weight` times."""
    names = [c for c in df.columns if c != weight]
    if weight is None:
        return df.agg(*[F.count(F.col(c)).alias(c) for c in names])
    counted = [F.sum(F.when(F.col(c).isNotNull(), F.col(weight))) for c in names]
    return df.agg(*[F.coalesce(n, F.lit(0)).cast("bigint").alias(c) for n, c in zip(counted, names)])


def count_where(condition: Column, weight: str | None = None) -> Column:
    """Aggregate: the rows a condition holds for, each counted `weight` times."""
    total = F.sum(F.when(condition, F.col(weight))) if weight else F.count_if(condition)
    return F.coalesce(total, F.lit(0)).cast("bigint")


def metric_table(df: DataFrame, metrics: Mapping[str, Column], weight: str | None = None) -> DataFrame:
    """(metric, value) rows: one count per condition, all worked out in one pass."""
    one = df.agg(*[count_where(m, weight).alias(f"m{i}") for i, m in enumerate(metrics.values())])
    return metric_rows(one, {f"m{i}": [name] for i, name in enumerate(metrics)})


def metric_rows(one_row: DataFrame, lines: Mapping[str, Sequence[str]]) -> DataFrame:
    """A row of counts as (metric, value) rows; `lines` says which metrics a count goes into."""
    pairs = [
        F.struct(F.lit(line).alias("metric"), F.col(c).cast("bigint").alias("value"))
        for c in one_row.columns
        for line in lines[c]
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def add_metrics(*parts: DataFrame) -> DataFrame:
    """One line per metric; a metric that several parts feed is their sum."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("metric").agg(F.sum("value").alias("value"))
