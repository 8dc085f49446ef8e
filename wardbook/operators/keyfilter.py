"""A filter of fixed size that tells most rows apart whose key is not asked for.

The keys are hashed to places of a bitmap (one row per 32,768 places, put together by Spark's bitmap aggregates). A table is cut by a
broadcast join on the bitmap's rows and a test of one bit, all in native expressions, so it never has to be shuffled for it. Every
asked-for row passes; of the others about one in sixteen does, more where the bitmap has reached its largest size. The join that
follows sorts those out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.operators.keep import keep_table

#: Places of the largest bitmap: 32 MB. Beyond a quarter as many keys it would let most rows pass.
MOST_PLACES = 1 << 28
MOST_KEYS = MOST_PLACES // 4
#: Places in a row of the bitmap, as `bitmap_bucket_number` has them.
_IN_ROW = 32_768


def _hashable(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[Column]]:
    """Types and columns that hash alike on both sides of an equi-join: whole numbers as long."""
    kinds, columns = [], []
    for name in names:
        kind = df.schema[name].dataType
        whole = isinstance(kind, T.IntegralType)
        kinds.append("bigint" if whole else kind.simpleString())
        columns.append(F.col(name).cast("long") if whole else F.col(name))
    return kinds, columns


class KeyFilter:
    """The keys `on` of a frame; `n_keys` is how many there are, counted before."""

    def __init__(self, keys: DataFrame, on: Sequence[str], n_keys: int):
        self.places = min(MOST_PLACES, max(1 << 18, 1 << (16 * n_keys - 1).bit_length()))
        self.kinds, columns = _hashable(keys, on)
        place = keys.select(*on).dropna().select(self._place(columns).alias("_place"))
        row = F.bitmap_bucket_number("_place").alias("_row")
        bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")
        # Eight bytes to a number, so that a bit is read without cutting a string.
        numbers = F.transform(F.sequence(F.lit(0), F.lit(_IN_ROW // 64 - 1)), lambda i: F.conv(F.hex(F.substring(F.col("_bits"), i * 8 + 1, F.lit(8))), 16, -10).cast("long"))
        self.bitmap = keep_table(place.groupBy(row).agg(bitmap).select(F.col("_row"), numbers.alias("_words")))

    def _place(self, columns: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.places)) + 1

    def cut(self, table: DataFrame, key: Sequence[str], also: Column | None = None) -> DataFrame:
        """The rows of `table` that may be asked for, and those that `also` holds for; all of them if the keys' types differ."""
        kinds, columns = _hashable(table, key)
        if kinds != self.kinds:
            return table
        place = self._place(columns)
        at = F.bitmap_bit_position(place)
        # The first of eight bytes is the highest of the number.
        bit = (7 - F.floor(at / 8) % 8) * 8 + at % 8
        row, words = (next(n for i in range(len(table.columns) + 1) if (n := f"{name}{i}") not in table.columns) for name in ("_row", "_words"))
        found = table.join(F.broadcast(self.bitmap.toDF(row, words)), F.bitmap_bucket_number(place) == F.col(row), "inner" if also is None else "left")
        asked = F.getbit(F.get(words, F.floor(at / 64).cast("int")), bit.cast("int")) == 1
        return found.where(asked if also is None else asked | also).select(*[F.col(f"`{c}`") for c in table.columns])
