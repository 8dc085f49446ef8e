"""Rosters and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_roster(spark: SparkSession, path: str, column: str = "prefix") -> DataFrame:
    """One value per line; line ends and trailing blanks dropped, empty lines too."""
    value = F.rtrim(F.regexp_replace("value", r"\r$", ""))
    return spark.read.text(path).select(value.alias(column)).where(F.col(column) != "")


def roster(spark: SparkSession, values, column: str, dtype: str = "string") -> DataFrame:
    """A short parameter list as a one-column DataFrame."""
    return spark.createDataFrame([(v,) for v in values], f"{column} {dtype}")


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema=None) -> DataFrame:
    """A delimited file; blanks around names and values are dropped."""
    reader = spark.read.options(sep=sep, header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.toDF(*[c.strip() for c in df.columns])
