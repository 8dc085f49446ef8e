"""Where reports go. Every writer is a Spark write; nothing is collected."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.functions.text import whole_number_text


def dated(path: str, as_of: date) -> str:
    """A path with the day in its name."""
    return f"{path}-{as_of:%Y-%m-%d}"


def stamped(path: str, at: datetime) -> str:
    """A path with the feed's stamp: year, day, month, then the time."""
    return f"{path}{at:%Y%d%m%H%M%S}"


def _write_section(df: DataFrame, target: str, file_format: str, header: bool) -> None:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.csv(target, header=header)
    else:
        writer.parquet(target)


def write_report(report: Mapping[str, DataFrame], path: str, file_format: str = "parquet", header: bool = True) -> None:
    """Each section under `path/section=<name>`. The order of a sorted section is kept in its file names.

    All sections are written aside before the first one is put in place, so a section that fails leaves the report as it was. Sections
    are then moved one after the other; `publish_report` has no such moment.
    """
    spark = _session(report)
    staged = f"{path}/_staging/{uuid.uuid4().hex}"
    try:
        for name, df in report.items():
            _write_section(df, f"{staged}/section={name}", file_format, header)
        for name in report:
            target = _path(spark, f"{path}/section={name}")
            _files(spark, target).delete(target, True)
            _moved(spark, f"{staged}/section={name}", f"{path}/section={name}")
    finally:
        folder = _path(spark, f"{path}/_staging")
        _files(spark, folder).delete(folder, True)


def publish_report(report: Mapping[str, DataFrame], path: str, file_format: str = "parquet", header: bool = True, keep: int = 2) -> str:
    """A whole set of sections that readers see at once, or not at all; returns the run's name.

    Each run has a folder of its own under `path/runs`. When all sections are written, one small file under `path/manifests` names
    them; `published_sections` goes by the last manifest, so a reader never finds sections of two runs, and a run that fails is never
    seen. The last `keep` runs stay, for readers that have begun.
    """
    spark = _session(report)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, df in report.items():
        _write_section(df, f"{path}/runs/{run}/section={name}", file_format, header)
    aside, manifest = f"{path}/manifests/_{run}", f"{path}/manifests/{run}"
    out = _files(spark, _path(spark, path)).create(_path(spark, aside))
    out.write(bytearray(json.dumps({"run": run, "format": file_format, "header": header, "sections": list(report)}).encode()))
    out.close()
    _moved(spark, aside, manifest)
    for old in _manifests(spark, path)[:-keep]:
        # The manifest goes first: what has none is not looked for.
        for gone in (f"{path}/manifests/{old}", f"{path}/runs/{old}"):
            _files(spark, _path(spark, path)).delete(_path(spark, gone), True)
    return run


def published_sections(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections of the last published run; none if there is none."""
    runs = _manifests(spark, path)
    if not runs:
        return {}
    held = json.loads(spark.read.text(f"{path}/manifests/{runs[-1]}", wholetext=True).first()[0])
    reader = spark.read.option("header", held["header"])
    return {name: reader.format(held["format"]).load(f"{path}/runs/{held['run']}/section={name}") for name in held["sections"]}


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """Names of published runs, the oldest first."""
    folder = _path(spark, f"{path}/manifests")
    files = _files(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _session(report: Mapping[str, DataFrame]) -> SparkSession:
    return next((df.sparkSession for df in report.values()), None) or SparkSession.active()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path):
    """The file system of a path, whatever store it is in."""
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _moved(spark: SparkSession, source: str, target: str) -> None:
    here, there = _path(spark, source), _path(spark, target)
    if not _files(spark, here).rename(here, there):
        raise OSError(f"{source} cannot be moved to {target}")


def write_sections(df: DataFrame, path: str, by: str = "section") -> None:
    """One frame with a section column, in a single pass.

    Rebalancing gathers small sections into few files and splits a section that
    holds most of the rows over many tasks.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def write_audit(matched: DataFrame, unmatched: DataFrame, path: str) -> None:
    """The main output and, next to it, the rows that were left out of it."""
    unmatched.write.mode("overwrite").parquet(f"{path}/main")
    matched.write.mode("overwrite").parquet(f"{path}/audit")


def as_text(df: DataFrame, no_decimals: bool = False) -> DataFrame:
    """Values as a delimited file shows them: True/False, and floats without decimals if asked."""

    def show(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            c = F.when(c, "True").when(~c, "False")
        elif no_decimals and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = whole_number_text(c)
        return c.alias(field.name)

    return df.select(*[show(f) for f in df.schema.fields])


def rendered(df: DataFrame, no_decimals: bool = True) -> DataFrame:
    """Every value as the text that a delimited file holds; NULL is empty."""
    shown = as_text(df, no_decimals)
    return shown.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in shown.columns])


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, no_decimals: bool = False, names: Sequence[str] | None = None
) -> None:
    """A delimited file, optionally with other column names in its header."""
    out = as_text(df, no_decimals)
    if names is not None:
        out = out.toDF(*names)
    out.write.mode("overwrite").csv(path, sep=sep, header=header, emptyValue="", nullValue="")


def text_lines(df: DataFrame, title: Sequence[str], gaps: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A text report: title lines, then each row's columns joined by fixed runs of blanks.

    `gaps` holds the blanks after each column but the last. One `value` column,
    sorted; the title comes first because its rank is lower.
    """
    parts: list[Column] = []
    for i, name in enumerate(df.columns):
        parts.append(F.coalesce(F.col(name).cast("string"), F.lit("None")))
        if i < len(gaps):
            parts.append(F.lit(gaps[i]))
    body = df.select(
        F.lit(1).alias("rank"),
        F.lit(0).alias("line"),
        F.struct(*[F.col(c).cast("string") for c in [*order, *[c for c in df.columns if c not in order]]]).alias("place"),
        F.concat(*parts).alias("value"),
    )
    spark = df.sparkSession
    heads = spark.createDataFrame([(0, i, text) for i, text in enumerate(title)], "rank int, line int, value string")
    heads = heads.withColumn("place", F.lit(None).cast(body.schema["place"].dataType))
    return heads.unionByName(body).orderBy("rank", "line", "place", "value").select("value")


def write_text_report(df: DataFrame, title: Sequence[str], gaps: Sequence[str], order: Sequence[str], path: str) -> None:
    text_lines(df, title, gaps, order).write.mode("overwrite").text(path)


def summary_lines(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """(metric, value) rows as 'metric: value' lines in the order given."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric"))
    line = F.concat("metric", F.lit(": "), F.col("value").cast("string"))
    return metrics.orderBy(place, "metric").select(line.alias("value"))


def write_summary(metrics: DataFrame, order: Sequence[str], path: str) -> None:
    summary_lines(metrics, order).write.mode("overwrite").text(path)


def missing_orders_title(as_of: date) -> list[str]:
    # Fixed value: the head of the missing-order report.
    return [
        f"MISSING ADMIT ORDERS For {as_of:%Y-%m-%d}",
        "===============================================",
        "",
        "",
        "Nurse St      Room         Bed     Patient Name             Account Number",
        "",
    ]


# Fixed value: the blanks between the columns of that report.
MISSING_ORDERS_GAPS = [" " * 6, " " * 9, " " * 5, " " * 13]
