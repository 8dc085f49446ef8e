"""Table probe: is each expected table there, readable and complete?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.sources import schemas

PROBE_ROWS = 5


def probe_tables(spark: SparkSession, directory: str, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per expected table: present, readable, rows read (5 at most), columns, missing columns.

    The first rows are read with all expected columns. A table that is not there, or whose files are broken, is a row that
    says so: files without a readable footer are told when the table is opened, broken pages by rows that the footers
    promise and that cannot be read.
    """
    parts = []
    for table, columns in expected.items():
        try:
            df = spark.read.option("ignoreCorruptFiles", "true").parquet(f"{directory}/{table}.parquet")
        except (PySparkException, Py4JJavaError) as error:
            absent = isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
            parts.append(_row(spark.range(1), table, not absent, F.lit(False), F.lit(0), 0, sorted(columns)))
            continue
        names = {c.lower(): c for c in df.columns}
        there = [names[c] for c in columns if c in names]
        # The hash needs every expected column, so each is read.
        seen = df.limit(PROBE_ROWS).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(F.lit(0), *there)).alias("_hash"))
        promised = df.select(F.lit(1)).limit(PROBE_ROWS).agg(F.count(F.lit(1)).alias("_promised"))
        both = seen.unionByName(promised, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("n", "_hash", "_promised")])
        readable = (F.col("n") == F.col("_promised")) & ((F.col("n") == 0) | F.col("_hash").isNotNull())
        parts.append(_row(both, table, True, readable, F.col("n"), len(df.columns), sorted(set(columns) - set(names))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def probe_snapshots(spark: SparkSession, directory: str) -> DataFrame:
    """The probe over all tables of the clinical and the orders source."""
    expected = {table: schemas.columns(table) for table in (*schemas.CLINICAL, *schemas.ORDERS)}
    return probe_tables(spark, directory, expected)


def _row(df: DataFrame, table: str, present: bool, readable: Column, seen: Column, n_columns: int, missing: list[str]) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(present).alias("present"),
        readable.alias("readable"),
        seen.cast("bigint").alias("rows_read"),
        (readable & (seen > 0) & F.lit(not missing)).alias("passed"),
        F.lit(n_columns).cast("bigint").alias("n_columns"),
        F.lit(",".join(missing)).alias("missing_columns"),
    )
