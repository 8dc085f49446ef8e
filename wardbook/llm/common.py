"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Python step holds at a time; texts can be long.
ROWS_AT_A_TIME = 256

_SPARK_TYPES = {
    pa.int64(): "bigint",
    pa.int32(): "int",
    pa.float64(): "double",
    pa.string(): "string",
    pa.bool_(): "boolean",
    pa.binary(): "binary",
    pa.list_(pa.int32()): "array<int>",
    pa.list_(pa.int64()): "array<bigint>",
    pa.list_(pa.list_(pa.int32())): "array<array<int>>",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column has it (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model learns labels from. A row without an id is in no fold, and so not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def map_texts(
    df: DataFrame,
    work: Callable[[], Callable[[list[bytes | None]], Sequence[Sequence]]],
    added: dict[str, pa.DataType],
    text: str = "text",
    drop_text: bool = False,
    rows: int = ROWS_AT_A_TIME,
) -> DataFrame:
    """`df` with columns made from its text, in one narrow pass and a few rows at a time.

    work() is called once per task; what it returns gets the UTF-8 bytes of some texts (None for null) and gives one
    list of values for each added column. Every other column passes as it is. Added names replace columns of that name.
    """
    kept = [f for f in df.schema.fields if f.name not in added and not (drop_text and f.name == text)]
    sent = list(dict.fromkeys([f.name for f in kept] + [text]))
    names = [f.name for f in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {_SPARK_TYPES[t]}" for n, t in added.items()])
    at = sent.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = work()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):  # never an empty part
                part = batch.slice(start, rows)
                found = values(part.column(at).cast(pa.binary()).to_pylist())
                arrays = [part.column(i) for i in range(len(names))]
                arrays += [column if isinstance(column, pa.Array) else pa.array(column, kind) for column, kind in zip(found, added.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *added])

    return df.select(*[F.col(f"`{c}`") for c in sent]).mapInArrow(run, schema)


def emit(kinds: dict[str, pa.DataType], rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(kinds, held)
            held = []
    if held:
        yield _batch(kinds, held)


def _batch(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def spark_schema(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"`{n}` {_SPARK_TYPES[t]}" for n, t in kinds.items())


_PLACES = 1 << 40


def hash_place(*keys: str) -> Column:
    """A number from 0 to 2^40 that depends on the keys alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(_PLACES))


def hash_limit(wanted: int, n: Column | int) -> Column:
    """The place below which about `wanted` of n rows lie, with some to spare."""
    return F.least(F.lit(1.0), F.lit(1.2 * wanted + 100) / F.lit(n) if isinstance(n, int) else F.lit(1.2 * wanted + 100) / n) * _PLACES


def bounded_ids(labelled: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` rows of a table, those with the lowest hashes of their keys: the same ones at any partitioning.

    A count comes first, so that only little more than `bound` rows ever leave their tasks.
    """
    n = labelled.count()
    if n <= bound:
        return labelled
    return labelled.filter(hash_place(key) < hash_limit(bound, n)).orderBy(hash_place(key), key).limit(bound)
