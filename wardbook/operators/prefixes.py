"""Matching a text column against a roster of prefixes.

A parameter list (strings) becomes one condition of `startswith`s, which reaches
the scan. A roster that is a table is an equi-join: the text is cut to each prefix
length the roster holds and joined on equality, so a long roster needs no nested
loop and the work grows with the rows, not with rows x roster. Texts outside the
range from the lowest to the highest prefix are left out at the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.predicates import contains_any, starts_with_any
from wardbook.operators.joins import Facts, Look

_CUT = "_cut"
# A roster of up to this many prefixes (of a name's width) is broadcast.
FEW_PREFIXES = 100_000


@dataclass(frozen=True)
class _Measure:
    """How many prefixes, their lengths (never more numbers than a name column is wide), the lowest and the highest."""

    size: int
    lengths: list[int]
    lowest: str | None
    highest: str | None

    def in_range(self, col: str) -> Column:
        """Whether a text may start with a prefix. A shorter prefix that starts the highest one reaches further than that."""
        end = _after(self.highest[: self.lengths[0]])
        return (F.col(col) >= self.lowest) & ((F.col(col) < end) if end else F.lit(True))


def _measured(roster: DataFrame, prefix: str) -> _Measure:
    seen = (
        roster.where(F.length(prefix) > 0)
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.sort_array(F.collect_set(F.length(prefix))).alias("lengths"),
            F.min(prefix).alias("lowest"),
            F.max(prefix).alias("highest"),
        )
        .first()
    )
    return _Measure(*seen)


def _after(prefix: str) -> str:
    """The first text after all that start with a prefix; empty if there is none."""
    while prefix:
        code = ord(prefix[-1]) + 1
        if code <= 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if 0xD800 <= code < 0xE000 else code)
        prefix = prefix[:-1]
    return ""


def _sized(roster: DataFrame, size: int) -> DataFrame:
    return F.broadcast(roster) if size <= FEW_PREFIXES else roster


def _cuts(df: DataFrame, col: str, lengths: Iterable[int]) -> DataFrame:
    text = F.col(col)
    cuts = F.array(*[F.when(F.length(text) >= n, F.substring(text, 1, n)) for n in lengths])
    return df.withColumn(_CUT, F.explode(F.array_compact(cuts)))


def prefix_join(df: DataFrame, roster: DataFrame | Sequence[str], col: str, prefix: str = "prefix", keep: str = "all") -> DataFrame:
    """Rows of `df` whose `col` starts with a roster prefix.

    keep="all": one row per matching prefix with the roster's columns added, so
    a text that two prefixes match comes twice. keep="exists": each row once.
    Prefixes are plain text: '%' and '_' stand for themselves.
    """
    if not isinstance(roster, DataFrame):
        return _listed(df, roster, col, prefix, keep)
    measure = _measured(roster, prefix)
    size, lengths = measure.size, measure.lengths
    if not size:
        empty = df.where(F.lit(False))
        if keep == "exists":
            return empty
        return empty.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in roster.schema.fields])
    cut = _cuts(df.where(measure.in_range(col)), col, lengths)
    if keep == "exists":
        # No prefix left in the roster starts another, so a row matches once at most.
        short = _shortest(roster.select(prefix).distinct(), prefix, size, lengths)
        return cut.join(_sized(short.select(F.col(prefix).alias(_CUT)), size), _CUT, "left_semi").drop(_CUT)
    table = roster.withColumn(_CUT, F.col(prefix))
    if size > FEW_PREFIXES:
        return Facts(cut).by(_CUT, Look(table, _CUT, "inner")).df.drop(_CUT)
    return cut.join(F.broadcast(table), _CUT, "inner").select(*df.columns, *roster.columns)


def _listed(df: DataFrame, prefixes: Sequence[str], col: str, prefix: str, keep: str) -> DataFrame:
    """The same for a list of strings, which is a condition and needs neither a count nor a join.

    As in a roster, a prefix that is listed twice matches twice, and an empty one matches nothing.
    """
    prefixes = [p for p in prefixes if p]
    found = df.where(starts_with_any(col, prefixes) if prefixes else F.lit(False))
    if keep == "exists":
        return found
    listed = F.array(*[F.lit(p) for p in prefixes]).cast("array<string>")
    return found.withColumn(prefix, F.explode(F.filter(listed, lambda p: F.startswith(F.col(col), p))))


def shortest_prefixes(roster: DataFrame, prefix: str = "prefix") -> DataFrame:
    """The prefixes that no other prefix in the roster starts."""
    measure = _measured(roster, prefix)
    return _shortest(roster, prefix, measure.size, measure.lengths)


def _shortest(roster: DataFrame, prefix: str, size: int, lengths: list[int]) -> DataFrame:
    if len(lengths) < 2:
        return roster
    longer = _cuts(roster, prefix, lengths).where(F.length(_CUT) < F.length(prefix))
    starts = _sized(roster.select(F.col(prefix).alias(_CUT)), size)
    covered = longer.join(starts, _CUT, "left_semi").select(prefix).distinct()
    return roster.join(_sized(covered, size), prefix, "left_anti")


def keyword_filter(df: DataFrame, keywords: Iterable[str], col: str) -> DataFrame:
    """Rows whose `col` contains any of a short list of keywords."""
    return df.where(contains_any(col, keywords))
