"""A filter of fixed size that says of a key that it is absent, or may be there.

It only spares a join the rows that it could not use; what it lets pass is joined as before. With more keys than it has room
for it lets more pass, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter; 4 MB are broadcast, whatever the number of keys.
BITS = 1 << 25


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return mixed % np.uint64(bits), (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(11)) % np.uint64(bits)


class Bloom:
    """Made from one long column of a frame."""

    def __init__(self, keys: DataFrame, bits: int = BITS):
        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One row per 64-bit word that the task has set bits in."""
            held = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                for place in _places(batch.column(0).to_numpy(), bits):
                    np.bitwise_or.at(held, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
            some = np.flatnonzero(held)
            for at in range(0, len(some), 1 << 16):
                part = some[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[part].view(np.int64))], names=["word", "bits"])

        set_words = keys.mapInArrow(words, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        held = np.zeros(bits // 64, np.int64)
        held[set_words.column("word").to_numpy()] = set_words.column("bits").to_numpy()
        self.bits, self.shared = bits, keys.sparkSession.sparkContext.broadcast(held)

    def may_have(self, key: str) -> Column:
        shared, bits = self.shared, self.bits

        @F.arrow_udf("boolean")
        def passes(keys: pa.Array) -> pa.Array:
            held = shared.value.view(np.uint64)
            out = np.ones(len(keys), bool)
            for place in _places(keys.to_numpy(zero_copy_only=False), bits):
                out &= (held[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
            return pa.array(out)

        return passes(F.col(key))
