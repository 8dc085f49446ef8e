"""Table snapshots: read from a database once, tidied and kept as parquet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.sources import schemas


class Tables(Mapping):
    """Named tables, each made when first asked for."""

    def __init__(self, makers: Mapping):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self[name]
        except KeyError:
            raise AttributeError(name) from None

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def only(self, name: str, column: str, values: Sequence = (), prefixes: Sequence[str] = ()) -> DataFrame:
        """Rows of a table whose column is one of the values or starts with a prefix; the filter reaches the source."""
        maker = self._makers[name]
        if isinstance(maker, SourceTable):
            return maker.only(column, values, prefixes)
        return self[name].where(_listed(F.col(column), values, prefixes))

    def replaced(self, **tables: DataFrame) -> Tables:
        """The same tables but for those given, as the base that several sections share."""
        kept = {name: maker if isinstance(maker, SourceTable) else (lambda name=name: self[name]) for name, maker in self._makers.items()}
        return Tables({**kept, **{n: (lambda df=df: df) for n, df in tables.items()}})


def _listed(column: Column, values: Sequence, prefixes: Sequence[str]) -> Column:
    conditions = [column.isin(list(values))] if values else []
    conditions += [column.startswith(p) for p in prefixes]
    return reduce(Column.__or__, conditions, F.lit(False)) if conditions else F.lit(False)


@dataclass(frozen=True)
class SourceTable:
    """A table as the source has it, tidied when it is read.

    Trimming and casting stand between a report's filter and the source, so `only` also filters the column as it is: a padded
    value is the value itself or starts with the value and a blank. A source that ignores trailing blanks and one that does not
    both give at least the rows asked for, which are then compared tidied.
    """

    raw: DataFrame
    table: str

    def __call__(self) -> DataFrame:
        return tidy(self.raw, self.table)

    def only(self, column: str, values: Sequence = (), prefixes: Sequence[str] = ()) -> DataFrame:
        return tidy(self.raw.where(self._at_source(column, values, prefixes)), self.table).where(_listed(F.col(column), values, prefixes))

    def _at_source(self, column: str, values: Sequence, prefixes: Sequence[str]) -> Column:
        field = next(f for f in self.raw.schema.fields if _tidy_name(f.name) == column)
        name, kind = F.col(f"`{field.name}`"), schemas.schema(self.table)[column].dataType
        text = isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType))
        if column in schemas.padded(self.table) and text:
            # A prefix that ends in a blank may have lost it to the padding.
            return _listed(name, values, [f"{v} " for v in values] + [p.rstrip(" ") for p in prefixes])
        whole = isinstance(field.dataType, (T.IntegralType, T.DecimalType)) and isinstance(kind, T.IntegralType)
        if field.dataType == kind or whole and getattr(field.dataType, "scale", 0) == 0:
            return _listed(name, values, prefixes)
        return F.lit(True)


def jdbc_options(
    url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a parallel JDBC read: one range of the key per task."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
    }


def jdbc_tables(spark: SparkSession, options: Mapping[str, Mapping[str, str]]) -> Tables:
    """Tables read from a database, by the options of each (`jdbc_options`)."""

    def source(table: str) -> SourceTable:
        return SourceTable(spark.read.format("jdbc").options(**options[table]).load(), table)

    return Tables({table: source(table) for table in options})


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    return tidy(spark.read.format("jdbc").options(**options).load(), table)


def _tidy_name(name: str) -> str:
    return name.lower().replace("#", "_no")


def tidy(df: DataFrame, table: str | None = None) -> DataFrame:
    """Lower-case names, `pat#` as `pat_no`, and for a known table its types,
    with the padding of CHAR columns taken off."""
    df = df.toDF(*[_tidy_name(c) for c in df.columns])
    if table is None:
        return df
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(table)])
    return without_padding(typed, table)


def without_padding(df: DataFrame, table: str) -> DataFrame:
    """Take the trailing blanks off the table's CHAR columns."""
    padded = schemas.padded(table)
    return df.withColumns({c: F.rtrim(c) for c in padded}) if padded else df


def snapshot(df: DataFrame, directory: str, table: str) -> None:
    """Keep a tidied table as parquet, so that reports filter at the scan."""
    tidy(df, table).write.mode("overwrite").parquet(f"{directory}/{table}.parquet")


def load(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A snapshot, with its schema enforced."""
    return spark.read.schema(schemas.schema(table)).parquet(f"{directory}/{table}.parquet")


def load_all(spark: SparkSession, directory: str, tables: Iterable[str] = schemas.TABLES) -> Tables:
    return Tables({name: (lambda name=name: load(spark, directory, name)) for name in tables})
